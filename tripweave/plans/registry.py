"""Queries the driver runs, one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables (through the adapters in ``sources.driver_tables``).  The
result goes through ``for_compare``: double columns are presented as 32-bit
floats, on this side and in the oracle SQL alike, because sums and averages
of doubles differ in their last bits with summation order between engines.
The library functions themselves keep full double precision.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tripweave import jobs
from tripweave.operators import measures as M
from tripweave.operators.checks import RideAudit, ValidationError, hour_uniqueness
from tripweave.operators.enrich import enrich, join_drop_report, typed_rides
from tripweave.operators.trips import clean_trips
from tripweave.operators.weather import clean_weather, split_observations
from tripweave.operators.zones import with_zones
from tripweave.plans.backfill import backfill, months_ledger, read_backfilled
from tripweave.plans.deltas import SummaryDeltas
from tripweave.plans.publish import RidesStore, create_table_if_not_exists
from tripweave.plans.rides import build_rides
from tripweave.session import scratch_path
from tripweave.sources.byname import load_by_name
from tripweave.sources.files import read_observations, read_trips, read_zones, write_csv
from tripweave.streaming.incremental import start_incremental_rides
from tripweave.sources.driver_tables import (
    observations_from_trips, raw_trips_from_events, raw_trips_from_orders,
    raw_yellow_trips_from_events, table, zones_from_nations,
)

TIE_BREAK = ["station_seq"]


def for_compare(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f.name).cast("float").alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def inputs(spark: SparkSession, sf_dir: str):
    """(raw trips, zones, observations) from the driver tables."""
    _utc(spark)
    raw = raw_trips_from_events(table(spark, sf_dir, "events"))
    zones = zones_from_nations(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
    return raw, zones, observations_from_trips(raw)


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, zones, obs = inputs(spark, sf_dir)
    return build_rides(raw, zones, obs, row_id="trip_id", tie_break=TIE_BREAK)


def _trips(spark, sf_dir):
    raw, _, _ = inputs(spark, sf_dir)
    return clean_trips(raw, "hvfhv", row_id="trip_id")


def q_trips_canonical(spark, sf_dir):
    return _trips(spark, sf_dir)


def q_trips_year_window(spark, sf_dir):
    _utc(spark)
    raw = raw_trips_from_orders(table(spark, sf_dir, "orders"))
    return clean_trips(raw, "hvfhv", year=1995, row_id="trip_id")


def q_zone_roles(spark, sf_dir):
    _, zones, _ = inputs(spark, sf_dir)
    return with_zones(_trips(spark, sf_dir), zones)


def q_weather_hourly(spark, sf_dir):
    _, _, obs = inputs(spark, sf_dir)
    return clean_weather(obs, tie_break=TIE_BREAK)


def q_weather_month_window(spark, sf_dir):
    _, _, obs = inputs(spark, sf_dir)
    return clean_weather(obs, window=("2024-01-10 00:00:00", "2024-01-20 00:00:00"), tie_break=TIE_BREAK)


def q_rides_enriched(spark, sf_dir):
    return rides(spark, sf_dir)


def q_rides_yellow(spark, sf_dir):
    """P2 + F2: yellow-taxi schema, observations of one month only (the
    annotated job keeps a single month of weather)."""
    raw, zones, obs = inputs(spark, sf_dir)
    yellow = raw_yellow_trips_from_events(table(spark, sf_dir, "events"))
    return build_rides(yellow, zones, obs, mapping="yellow", row_id="trip_id",
                       weather_window=("2024-01-01 00:00:00", "2024-02-01 00:00:00"),
                       tie_break=TIE_BREAK)


def q_rides_typed(spark, sf_dir):
    return typed_rides(rides(spark, sf_dir))


def _view(builder):
    def run(spark, sf_dir):
        return builder(rides(spark, sf_dir))
    run.__name__ = f"q_{builder.__name__}"
    return run


def _view_from_summary(builder):
    """The view as it is published: from a written minute summary."""
    def run(spark, sf_dir):
        path = scratch_path(spark, "summary")
        M.minute_summary(rides(spark, sf_dir)).write.parquet(path)
        return builder(spark.read.parquet(path))
    run.__name__ = f"q_{builder.__name__}_from_summary"
    return run


def _view_from_pairs(builder):
    """The view as it is published: from a written pair summary."""
    def run(spark, sf_dir):
        path = scratch_path(spark, "pairs")
        M.pair_summary(rides(spark, sf_dir)).write.parquet(path)
        return builder(spark.read.parquet(path))
    run.__name__ = f"q_{builder.__name__}_from_summary"
    return run


def _view_ranked(view):
    """The view with the place of each row in its order."""
    def run(spark, sf_dir):
        return M.ranked_view(view, rides(spark, sf_dir))
    run.__name__ = f"q_{view}_ranked"
    return run


def q_rejected_observations(spark, sf_dir):
    """Every text that a rule refuses, with the reason."""
    _, _, obs = inputs(spark, sf_dir)
    _, rejected = split_observations(obs, scratch_path(spark, "observations"), keep=TIE_BREAK)
    return rejected.select("station_seq", "DATE", "field", "text", "reason", "state")


def q_rides_without_rejected(spark, sf_dir):
    """Rides from the accepted observations of that pass, which lose nothing."""
    raw, zones, obs = inputs(spark, sf_dir)
    accepted, _ = split_observations(obs, scratch_path(spark, "observations"), keep=TIE_BREAK)
    return build_rides(raw, zones, accepted, row_id="trip_id", tie_break=TIE_BREAK)


def _two_deltas(spark, sf_dir) -> SummaryDeltas:
    """Two runs that share nearly every minute, hour and place pair, the second
    one sent twice."""
    path = scratch_path(spark, "delta-rides")
    rides(spark, sf_dir).write.parquet(path)
    written, deltas = spark.read.parquet(path), SummaryDeltas(spark, scratch_path(spark, "deltas"))
    odd = F.pmod(F.xxhash64("seq"), F.lit(2)) == 1
    deltas.append(written.filter(~odd), "first")
    deltas.append(written.filter(odd), "second")
    deltas.append(written.filter(odd), "second")
    return deltas


def q_summary_after_two_deltas(spark, sf_dir):
    """K2: two deltas added up equal one pass over all trips."""
    return _two_deltas(spark, sf_dir).read("minutes")


def q_summary_after_compaction(spark, sf_dir):
    """K2: the place pairs of two deltas, compacted to one run."""
    deltas = _two_deltas(spark, sf_dir)
    if deltas.compact() is None or len(deltas.runs()) != 1:
        raise AssertionError("two runs must become one")
    return deltas.read("pairs")


def _publish_job(spark, sf_dir, folder: str, root: str, database: str) -> None:
    """The publish job over files, as a user starts it."""
    _, zones, obs = inputs(spark, sf_dir)
    zpath, opath = scratch_path(spark, "zones-csv"), scratch_path(spark, "obs-csv")
    write_csv(zones, zpath)
    write_csv(obs, opath)
    status = jobs.run(["publish", folder, zpath, opath, root, "--database", database, "--row-id", "trip_id"], spark)
    if status:
        raise AssertionError(f"publish ended with {status}")


def q_published_views(spark, sf_dir):
    """Two publishes through the job, first half of the trips and then all
    of them; every lasting view by name from another session that was open all the
    time: its number of rows, and of rides where it counts them."""
    database = f"published_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'catalog')}'")
    raw, _, _ = inputs(spark, sf_dir)
    root, folder = scratch_path(spark, "store"), scratch_path(spark, "raw-trips")
    late = F.dayofmonth("pickup_datetime") > 15
    raw.filter(~late).write.parquet(folder)
    _publish_job(spark, sf_dir, folder, root, database)
    other = spark.newSession()
    _utc(other)
    before = other.table(f"{database}.rides").count()
    raw.filter(late).write.mode("append").parquet(folder)
    _publish_job(spark, sf_dir, folder, root, database)
    if not 0 < before < other.table(f"{database}.rides").count():
        raise AssertionError("the second publish must switch the views of an open session")
    out = None
    for name in ["rides", *sorted(M.VIEWS)]:
        df = other.table(f"{database}.{name}")
        total = F.sum("total_rides") if "total_rides" in df.columns else F.lit(None)
        one = df.agg(F.lit(name).alias("view_name"), F.count("*").alias("n_rows"), total.cast("bigint").alias("n_rides"))
        out = one if out is None else out.unionAll(one)
    return out


def q_publish_guards(spark, sf_dir):
    """V2–V5 in the publish itself: what its joins lost, seen while it wrote, and
    that doubled weather and repeated ids were refused."""
    raw, zones, obs = inputs(spark, sf_dir)
    store, audit = RidesStore(spark, scratch_path(spark, "store")), RideAudit()
    result = store.publish(build_rides(raw, zones, obs, row_id="trip_id", tie_break=TIE_BREAK, audit=audit), audit=audit)
    metrics = dict(result.joins, published=result.row_count)
    weather = clean_weather(obs, tie_break=TIE_BREAK)
    zoned = with_zones(_trips(spark, sf_dir), zones)
    doubled = RideAudit()
    doubled.watch(doubled.watch(zoned, "trips"), "zoned")
    twice = enrich(zoned, weather.unionAll(weather), audit=doubled)
    again = build_rides(raw.unionAll(raw), zones, obs, row_id="trip_id", tie_break=TIE_BREAK)
    for name, df, seen in (("doubled_hour_refused", twice, doubled), ("repeated_id_refused", again, None)):
        try:
            store.publish(df, audit=seen, summary=False)
            metrics[name] = 0
        except ValidationError:
            metrics[name] = 1
    metrics["left"] = store.read_current().count()
    return spark.createDataFrame(sorted(metrics.items()), "metric string, value long")


def q_stable_row_id(spark, sf_dir):
    """P5: ids of trips, some of them there three times, are unique and the same
    in two runs over two partitionings."""
    raw, _, _ = inputs(spark, sf_dir)
    twin = raw.filter(F.dayofmonth("pickup_datetime") == 3)
    raw = raw.unionAll(twin).unionAll(twin)

    def ids(parts):
        return clean_trips(raw.repartition(parts), "hvfhv", stable_id=True)

    one, two = ids(3), ids(11)
    same = one.join(two.withColumnRenamed("seq", "_seq"), F.col("seq") == F.col("_seq"), "left_semi")
    return one.agg(F.count("*").alias("n_trips"), F.count_distinct("seq").alias("n_ids")).crossJoin(
        same.agg(F.count("*").alias("n_same")))


def q_staging_validation(spark, sf_dir):
    return M.staging_counts(rides(spark, sf_dir))


def q_join_drop_report(spark, sf_dir):
    raw, zones, obs = inputs(spark, sf_dir)
    trips = clean_trips(raw, "hvfhv", row_id="trip_id")
    return join_drop_report(trips, zones, clean_weather(obs, tie_break=TIE_BREAK))


def q_hour_uniqueness(spark, sf_dir):
    raw, zones, obs = inputs(spark, sf_dir)
    return hour_uniqueness(clean_weather(obs, tie_break=TIE_BREAK), rides(spark, sf_dir))


# ---------------------------------------------------------------- sources

def _raw_files(spark, sf_dir) -> str:
    """Raw trips written as Parquet in one folder per pickup day (the shape of
    monthly files in per-period folders)."""
    raw, _, _ = inputs(spark, sf_dir)
    path = scratch_path(spark, "raw-trips")
    (raw.withColumn("day", F.date_format("pickup_datetime", "yyyy-MM-dd"))
     .write.partitionBy("day").parquet(path))
    return path


def q_parquet_glob_scan(spark, sf_dir):
    """A glob over per-period folders."""
    path = _raw_files(spark, sf_dir)
    raw = read_trips(spark, f"{path}/day=*/*.parquet")
    return clean_trips(raw, "hvfhv", row_id="trip_id")


def q_recursive_scan(spark, sf_dir):
    """Files in plain ``yyyy/mm`` folders, one level apart, with text
    files among them: neither a flat listing nor one without the pattern reads it."""
    raw, _, _ = inputs(spark, sf_dir)
    path, late = scratch_path(spark, "nested-trips"), F.dayofmonth("pickup_datetime") > 15
    raw.filter(~late).write.parquet(f"{path}/2024/01")
    raw.filter(late).write.parquet(f"{path}/2024/01/late")
    raw.select(F.col("hvfhs_license_num")).write.text(f"{path}/2024/notes")
    raw = read_trips(spark, path, recursive=True, glob_filter="*.parquet")
    return clean_trips(raw, "hvfhv", row_id="trip_id")


def q_by_name_load(spark, sf_dir):
    """Columns matched by name in any letter case onto the raw schema."""
    raw, _, _ = inputs(spark, sf_dir)
    shouted = raw.select(*[F.col(c).alias(c.upper() if i % 2 else c.lower())
                           for i, c in enumerate(reversed(raw.columns))])
    return clean_trips(load_by_name(shouted, raw.schema), "hvfhv", row_id="trip_id")


def q_csv_roundtrip(spark, sf_dir):
    """Zones and observations through CSV files, all columns text."""
    raw, zones, obs = inputs(spark, sf_dir)
    zpath, opath = scratch_path(spark, "zones-csv"), scratch_path(spark, "obs-csv")
    write_csv(zones, zpath)
    write_csv(obs, opath)
    zones_csv = read_zones(spark, zpath)
    obs_csv = read_observations(spark, opath, extra_columns=["station_seq"]) \
        .withColumn("station_seq", F.col("station_seq").cast("bigint"))
    return build_rides(raw, zones_csv, obs_csv, row_id="trip_id", tie_break=TIE_BREAK)


# ---------------------------------------------------------------- sinks / lifecycle

def q_write_max_records(spark, sf_dir):
    """K1: Parquet output with at most 1,000 rows per file, read back."""
    path = scratch_path(spark, "rides-files")
    rides(spark, sf_dir).write.mode("overwrite").option("maxRecordsPerFile", 1000).parquet(path)
    return spark.read.parquet(path)


def q_publish_promote(spark, sf_dir):
    """Stage, validate, promote, refresh views, clean up; read the table."""
    store = RidesStore(spark, scratch_path(spark, "store"))
    store.publish(rides(spark, sf_dir))
    return store.read_current()


def q_publish_rollback(spark, sf_dir):
    """A second publish fails validation; production keeps the first run."""
    store = RidesStore(spark, scratch_path(spark, "store"))
    good = rides(spark, sf_dir)
    store.publish(good)
    try:
        store.publish(good.filter(F.lit(False)))
        raise AssertionError("an empty run must not be promoted")
    except ValidationError:
        pass
    return store.read_current()


def q_create_if_absent(spark, sf_dir):
    """K4 (D10): ``CREATE TABLE IF NOT EXISTS … AS SELECT``; a second create
    with other rows leaves the first rows in place."""
    name = f"rides_if_absent_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, "if-absent")
    full = rides(spark, sf_dir)
    if not create_table_if_not_exists(spark, name, full, path):
        raise AssertionError(f"{name} existed before its first create")
    if create_table_if_not_exists(spark, name, full.filter(F.col("seq") % 2 == 0), path):
        raise AssertionError(f"{name} was created twice")
    return spark.table(name)


def _months(spark, sf_dir) -> list[str]:
    raw, _, _ = inputs(spark, sf_dir)
    return sorted(r[0] for r in raw.select(F.date_format("pickup_datetime", "yyyy-MM"))
                  .distinct().collect())


def q_partition_backfill(spark, sf_dir):
    """Month-partitioned output, dynamic overwrite, read back."""
    raw, zones, obs = inputs(spark, sf_dir)
    root = scratch_path(spark, "backfill")
    backfill(spark, raw, zones, obs, root, _months(spark, sf_dir), row_id="trip_id", tie_break=TIE_BREAK)
    return read_backfilled(spark, root)


def q_skip_completed(spark, sf_dir):
    """The second run finds every month done and writes nothing; the
    ledger keeps one row per month with its row count."""
    raw, zones, obs = inputs(spark, sf_dir)
    root = scratch_path(spark, "backfill")
    months = _months(spark, sf_dir)
    backfill(spark, raw, zones, obs, root, months, row_id="trip_id", tie_break=TIE_BREAK)
    again = backfill(spark, raw, zones, obs, root, months, row_id="trip_id", tie_break=TIE_BREAK)
    if again:
        raise AssertionError(f"months processed twice: {again}")
    return months_ledger(spark, root).select("month", "row_count")


def q_stream_incremental(spark, sf_dir):
    """Incremental file stream (availableNow) into the month-partitioned sink."""
    _, zones, obs = inputs(spark, sf_dir)
    trips_dir = scratch_path(spark, "stream-in")
    raw, _, _ = inputs(spark, sf_dir)
    raw.repartition(4).write.parquet(trips_dir)          # four files ...
    out = scratch_path(spark, "stream-out")
    query = start_incremental_rides(spark, trips_dir, zones, obs, out,
                                    checkpoint=scratch_path(spark, "stream-ckpt"),
                                    row_id="trip_id", tie_break=TIE_BREAK,
                                    max_files_per_trigger=1)  # ... one micro-batch each
    query.awaitTermination()
    return spark.read.parquet(out).drop("month")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "trips_canonical": q_trips_canonical,
    "trips_year_window": q_trips_year_window,
    "zone_roles": q_zone_roles,
    "weather_hourly": q_weather_hourly,
    "weather_month_window": q_weather_month_window,
    "rides_enriched": q_rides_enriched,
    "rides_typed": q_rides_typed,
    "rides_yellow": q_rides_yellow,
    **{name: _view(builder) for name, builder in M.VIEWS.items()},
    **{f"{name}_from_summary": _view_from_summary(M.VIEWS[name]) for name in sorted(M.SUMMARY_VIEWS)},
    **{f"{name}_from_summary": _view_from_pairs(M.VIEWS[name]) for name in sorted(M.PAIR_VIEWS)},
    **{f"{name}_ranked": _view_ranked(name) for name in M.VIEW_ORDERS},
    "rejected_observations": q_rejected_observations,
    "rides_without_rejected": q_rides_without_rejected,
    "published_views": q_published_views,
    "publish_guards": q_publish_guards,
    "stable_row_id": q_stable_row_id,
    "minute_summary": _view(M.minute_summary),
    "pair_summary": _view(M.pair_summary),
    "summary_after_two_deltas": q_summary_after_two_deltas,
    "summary_after_compaction": q_summary_after_compaction,
    "staging_validation": q_staging_validation,
    "join_drop_report": q_join_drop_report,
    "hour_uniqueness": q_hour_uniqueness,
    "parquet_glob_scan": q_parquet_glob_scan,
    "recursive_scan": q_recursive_scan,
    "by_name_load": q_by_name_load,
    "csv_roundtrip": q_csv_roundtrip,
    "write_max_records": q_write_max_records,
    "publish_promote": q_publish_promote,
    "publish_rollback": q_publish_rollback,
    "create_if_absent": q_create_if_absent,
    "partition_backfill": q_partition_backfill,
    "skip_completed": q_skip_completed,
    "stream_incremental": q_stream_incremental,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        return lambda spark, sf_dir: for_compare(fn(spark, sf_dir))
    return {name: wrap(fn) for name, fn in QUERIES.items()}
