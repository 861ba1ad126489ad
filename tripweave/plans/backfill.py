"""Month-by-month backfill (C7: K2, K10, V1, V2).

One Spark job writes every month still to do under a run of its own,
``rides/run_id=<id>/month=YYYY-MM``, and both summaries of the written run next
to it (``summary``, ``pairs``).  Appending the months' ledger rows, one small file, is the
promotion: readers follow the ledger to the newest run of each month, so a month
changes all at once or not at all, other months stay as they are, and a month
that has no trips any more points at a run without rows.  The ledger also lets
a rerun skip finished months unless ``force``.

A trip belongs to the month of its pickup and must be dropped off before the end
of that month's calendar year, whatever other months the call names.  The trip
scan receives these ranges as an OR, so only the needed row groups are read.  A
minute never spans two months, so per-month summaries are exact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tripweave.functions.timecols import ts_literal
from tripweave.operators.checks import RideAudit, ValidationError, has_repeated_ids
from tripweave.operators.measures import minute_summary, pair_summary
from tripweave.plans import storage
from tripweave.plans.publish import new_run_id
from tripweave.plans.rides import build_rides

MONTHS_SCHEMA = StructType([
    StructField("month", StringType()),
    StructField("run_id", StringType()),
    StructField("row_count", LongType()),
    StructField("done_at", TimestampNTZType()),
])


def month_range(month: str) -> tuple[dt.datetime, dt.datetime]:
    lo = dt.datetime.strptime(month, "%Y-%m")
    hi = dt.datetime(lo.year + (lo.month == 12), lo.month % 12 + 1, 1)
    return lo, hi


def months_ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/_months"
    if not storage.exists(spark, path):
        return spark.createDataFrame([], MONTHS_SCHEMA)
    # one folder per run, so that two writers never share an output committer
    return spark.read.schema(MONTHS_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def current_months(spark: SparkSession, root: str) -> dict[str, tuple[str, int]]:
    """month -> (run_id, row_count) of its newest promoted run; a row per month."""
    newest = (months_ledger(spark, root).groupBy("month")
              .agg(F.max(F.struct("done_at", "run_id", "row_count")).alias("x")).select("month", "x.*"))
    return {r["month"]: (r["run_id"], r["row_count"]) for r in newest.collect()}


def completed_months(spark: SparkSession, root: str) -> set[str]:
    return set(current_months(spark, root))


def _in_months(df: DataFrame, months: Sequence[str]) -> Column:
    """Pickup in one of ``months``, drop-off in the same calendar year."""
    pickup, dropoff = (df.schema[c].dataType for c in ("pickup_datetime", "dropoff_datetime"))
    cond = None
    for m in months:
        lo, hi = month_range(m)
        year, after = dt.datetime(lo.year, 1, 1), dt.datetime(lo.year + 1, 1, 1)
        part = ((F.col("pickup_datetime") >= ts_literal(lo, pickup)) & (F.col("pickup_datetime") < ts_literal(hi, pickup))
                & (F.col("dropoff_datetime") >= ts_literal(year, dropoff))
                & (F.col("dropoff_datetime") < ts_literal(after, dropoff)))
        cond = part if cond is None else cond | part
    return cond


def backfill(spark: SparkSession, raw_trips: DataFrame, zones: DataFrame, observations: DataFrame,
             root: str, months: Iterable[str], *, mapping: str | dict = "hvfhv",
             force: bool = False, row_id: str | Column | None = None,
             tie_break: Sequence[str] = (), max_records_per_file: int = 100_000,
             weather_window: tuple | None = None, weather: DataFrame | None = None,
             stable_id: bool = False) -> list[str]:
    """Build and write the rides of ``months`` (``YYYY-MM``) not yet done;
    returns the months written by this call.  A doubled hour of weather or a
    repeated row id is refused.  On any failure before the ledger
    rows the staged run is deleted and every month stays as it was."""
    root = root.rstrip("/")
    wanted = sorted(set(months))
    done = set() if force else completed_months(spark, root)
    todo = [m for m in wanted if m not in done]
    if not todo:
        return []
    years = sorted({month_range(m)[0].year for m in todo})
    window = (f"{years[0]}-01-01 00:00:00", f"{years[-1] + 1}-01-01 00:00:00")
    audit = RideAudit()
    rides = build_rides(raw_trips, zones, observations, mapping=mapping, trip_window=window,
                        weather_window=weather_window, row_id=row_id, tie_break=tie_break,
                        keep=lambda trips: _in_months(trips, todo), audit=audit, weather=weather, stable_id=stable_id)
    rides = rides.withColumn("month", F.date_format("pickup_datetime", "yyyy-MM"))
    run_id = new_run_id()
    out, sums, pairs = (f"{root}/{t}/run_id={run_id}" for t in ("rides", "summary", "pairs"))
    try:
        (rides.write.mode("errorifexists").option("maxRecordsPerFile", max_records_per_file)
         .partitionBy("month").parquet(out))
        # read back with the written schema: a run without trips leaves no files to infer it from
        staged = spark.read.schema(rides.schema).parquet(out)
        audit.check()
        if has_repeated_ids(staged):
            raise ValidationError("staged rides have repeated row ids")
        summary = minute_summary(staged).withColumn("month", F.date_format("pickup_minute", "yyyy-MM"))
        summary.write.mode("errorifexists").partitionBy("month").parquet(sums)
        (pair_summary(staged).withColumn("month", F.date_format("pickup_date", "yyyy-MM"))
         .write.mode("errorifexists").partitionBy("month").parquet(pairs))
        # row counts come from the small summary of this run, not another scan of the rides
        counts = {r["month"]: r["count"] for r in   # one row per month
                  spark.read.schema(summary.schema).parquet(sums).groupBy("month").agg(F.sum("_n").alias("count")).collect()}
        if set(counts) - set(todo):
            raise ValueError(f"rides outside the months asked for: {sorted(set(counts) - set(todo))}")
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(m, run_id, int(counts.get(m, 0)), now) for m in todo]
        spark.createDataFrame(rows, MONTHS_SCHEMA).coalesce(1).write.parquet(f"{root}/_months/run={run_id}")
    except BaseException:
        # an interrupt may come after the ledger rows: what they name stays
        if run_id not in {r for r, _ in current_months(spark, root).values()}:
            for path in (out, sums, pairs):
                storage.delete(spark, path)
        raise
    return todo


def read_backfilled(spark: SparkSession, root: str, months: Sequence[str] | None = None,
                    table: str = "rides") -> DataFrame:
    """The current rides of all promoted months (or ``table="summary"`` or
    ``"pairs"``, their summaries); only the newest run of each month is read, and a month
    list prunes folders."""
    root = root.rstrip("/")
    current = current_months(spark, root)
    if not current:
        raise FileNotFoundError(f"no months written under {root}")
    wanted = {m: x for m, x in current.items() if months is None or m in months}
    paths = [f"{root}/{table}/run_id={run}/month={m}" for m, (run, n) in sorted(wanted.items()) if n]
    if not paths:   # months without trips: the table's columns, no rows
        runs = sorted({run for run, n in current.values() if n} or {run for run, _ in current.values()})
        df = spark.read.option("basePath", f"{root}/{table}/run_id={runs[-1]}").parquet(f"{root}/{table}/run_id={runs[-1]}")
        df = df if "month" in df.columns else df.withColumn("month", F.lit(None).cast("string"))
        return df.withColumn("month", F.col("month").cast("string")).limit(0)
    df = spark.read.option("basePath", f"{root}/{table}").parquet(*paths).drop("run_id")
    return df.withColumn("month", F.col("month").cast("string"))


def vacuum_backfill(spark: SparkSession, root: str, min_age: dt.timedelta = dt.timedelta(hours=24)) -> list[str]:
    """Delete what no reader of the ledger sees any more and whose newest file is
    older than ``min_age``: month folders that a newer run of the month replaced, and
    runs that were never promoted.  Younger ones may have readers or a job still
    writing, and stay."""
    root, now, removed = root.rstrip("/"), dt.datetime.now(dt.timezone.utc), []
    current = {(run, m) for m, (run, _) in current_months(spark, root).items()}
    runs = {run for run, _ in current}
    for table in ("rides", "summary", "pairs"):
        for folder in storage.list_dirs(spark, f"{root}/{table}"):
            run = folder.rstrip("/").rsplit("/run_id=", 1)[-1]
            old = [m for m in storage.list_dirs(spark, folder) if "/month=" in m
                   and (run, m.rstrip("/").rsplit("/month=", 1)[-1]) not in current] if run in runs else [folder]
            for d in old:
                if now - storage.last_modified(spark, d) >= min_age:
                    storage.delete(spark, d)
                    removed.append(d)
    return removed
