"""All-or-nothing publishing of the rides table (C6: K3–K6, K8, K9, K11, K12,
V2, V3) and create-if-absent (K4).

Layout under ``root``::

    <root>/<name>/run_id=<id>/                one directory per run (K3), Parquet files
    <root>/<name>_minutely/run_id=<id>/       the run's minute summary (feeds ten views)
    <root>/<name>_pairs/run_id=<id>/          the run's pair summary (feeds two views)
    <root>/<name>_views/<view>/run_id=<id>/   results of the lasting views, if there are any
    <root>/_ledger/run=<id>/                  one ledger row of a promoted run, Parquet

Publishing writes a new run directory (staging), validates it with one
aggregation pass, plans every view on it, and *promotes* it by writing one
ledger row.  Readers take the newest promoted run, so they always see one
complete run: a failed job leaves only an unreferenced directory, which the
failure path deletes.  Each ledger row has a folder of its own, so two
publishers never share an output committer.  Promotion copies nothing (the
reference copies the staging table); a re-pointed read is atomic and costs no
I/O at any size.  Superseded runs stay for their open readers until ``vacuum``
deletes them by age.

Lasting views (K8) hold no path of a run.  Each selects the rows whose ``run_id``
is what the ledger names at the time of reading, and Spark prunes the folders of
all other runs.  So the ledger row that promotes a run switches all views of all
sessions at once, no catalog statement is part of a publish but the first, and a
view never points at files that ``vacuum`` deletes.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tripweave.operators.checks import RideAudit, ValidationError, has_repeated_ids, validate_rides
from tripweave.operators.measures import PAIR_VIEWS, SUMMARY_VIEWS, VIEWS, minute_summary, pair_summary
from tripweave.plans import storage
from tripweave.schemas import BASE_VIEW_COLUMNS

LEDGER_SCHEMA = StructType([
    StructField("table_name", StringType()),
    StructField("run_id", StringType()),
    StructField("path", StringType()),
    StructField("row_count", LongType()),
    StructField("month_count", LongType()),
    StructField("promoted_at", TimestampNTZType()),
])


#: The base view (P9) as SQL text, for a catalog view that copies nothing.
BASE_VIEW_SQL = {c: f"`{c}`" for c in BASE_VIEW_COLUMNS} | {
    "pickup_date": "CAST(date_trunc('DAY', pickup_datetime) AS TIMESTAMP_NTZ)",
    "dow": "dayname(pickup_datetime)",
    "pickup_hour_of_day": "hour(pickup_datetime)",
}


@dataclass
class PublishResult:
    run_id: str
    path: str
    row_count: int
    month_count: int
    joins: dict[str, int] | None = None


def new_run_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


class RidesStore:
    """Run-scoped storage of one published table plus its dashboard views."""

    def __init__(self, spark: SparkSession, root: str, name: str = "rides"):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.ledger_path = f"{self.root}/_ledger"

    def run_path(self, run_id: str) -> str:
        return f"{self.root}/{self.name}/run_id={run_id}"

    def summary_path(self, run_id: str) -> str:
        return f"{self.root}/{self.name}_minutely/run_id={run_id}"

    def pairs_path(self, run_id: str) -> str:
        return f"{self.root}/{self.name}_pairs/run_id={run_id}"

    def view_path(self, run_id: str, view: str) -> str:
        return f"{self.root}/{self.name}_views/{view}/run_id={run_id}"

    def _run_paths(self, run_id: str) -> list[str]:
        """Everything a run wrote but its ledger row."""
        views = storage.list_dirs(self.spark, f"{self.root}/{self.name}_views")
        return [self.run_path(run_id), self.summary_path(run_id), self.pairs_path(run_id),
                *(f"{v.rstrip('/')}/run_id={run_id}" for v in views)]

    # ------------------------------------------------------------ readers
    def ledger(self) -> DataFrame:
        if not storage.exists(self.spark, self.ledger_path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return (self.spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true")
                .parquet(self.ledger_path))

    def _promoted(self) -> DataFrame:
        """This table's promoted runs, the current one first."""
        return (self.ledger().filter(F.col("table_name") == self.name)
                .orderBy(F.col("promoted_at").desc(), F.col("run_id").desc()))

    def current_run(self):
        """The newest promoted run of this table (one ledger row) or None."""
        return self._promoted().first()

    def read_current(self) -> DataFrame:
        """Exactly one run is read, never the parent folder of all runs."""
        run = self.current_run()
        if run is None:
            raise FileNotFoundError(f"{self.name}: nothing published under {self.root}")
        return self.spark.read.parquet(run["path"])

    def read_current_summary(self) -> DataFrame | None:
        """The minute summary of the current run (None if it was published
        without one)."""
        return self._summary_of_current(self.summary_path)

    def read_current_pairs(self) -> DataFrame | None:
        """The pair summary of the current run, or None."""
        return self._summary_of_current(self.pairs_path)

    def _summary_of_current(self, path_of: Callable[[str], str]) -> DataFrame | None:
        run = self.current_run()
        if run is None:
            raise FileNotFoundError(f"{self.name}: nothing published under {self.root}")
        path = path_of(run["run_id"])
        return self.spark.read.parquet(path) if storage.exists(self.spark, path) else None

    # ------------------------------------------------------------ publish
    def publish(self, df: DataFrame, *, validate: bool = True,
                max_records_per_file: int = 100_000,
                views: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
                summary: bool = True, database: str | None = None,
                audit: RideAudit | None = None) -> PublishResult:
        """Stage -> summarise -> validate -> plan views -> promote -> point views.

        On any failure before promotion the staged run (table, summaries, view
        results) is deleted and the error re-raised; the published table and its
        views are untouched.  The summaries are built from the written run, so the
        trips are not recomputed.  An interrupt that comes after the ledger row
        finds the run promoted and leaves it.

        ``database``: also keep lasting views there.  Their results are written
        before the promotion, which switches all of them.

        Validation refuses an empty run, a repeated ``seq`` (V5), and with the
        ``audit`` that ``df`` was built with, a doubled hour of weather (V4); the
        audit's counts come back as ``PublishResult.joins``."""
        run_id = new_run_id()
        path, spath, ppath = self.run_path(run_id), self.summary_path(run_id), self.pairs_path(run_id)
        staging_view = f"{self.name}_staging"
        views = VIEWS if views is None else views
        try:
            (df.write.mode("errorifexists")
             .option("maxRecordsPerFile", max_records_per_file).parquet(path))      # K5, K1
            staged = self.spark.read.parquet(path)
            staged.createOrReplaceTempView(staging_view)
            checked, pairs = staged, None
            if summary:
                # the summary is written first: validation then scans the
                # summary, not the run (one pass over the run, not two)
                minute_summary(staged).write.mode("errorifexists").parquet(spath)
                pair_summary(staged).write.mode("errorifexists").parquet(ppath)
                checked, pairs = self.spark.read.parquet(spath), self.spark.read.parquet(ppath)
            counts = validate_rides(checked) if validate else {"row_count": -1, "month_count": -1}
            if validate:
                if audit is not None:
                    audit.check()
                if "seq" in staged.columns and has_repeated_ids(staged):
                    raise ValidationError("staged rides have repeated row ids")
            planned = _planned(staged, checked if summary else None, pairs, views)
            if database:
                self._write_results(run_id, planned)
            self._promote(run_id, path, counts)                                     # K6
        except BaseException:
            self.spark.catalog.dropTempView(staging_view)                           # K11
            if self.ledger().filter(F.col("run_id") == run_id).isEmpty():
                for p in self._run_paths(run_id):
                    storage.delete(self.spark, p)
            raise
        self.spark.catalog.dropTempView(staging_view)                               # K9
        self._point_views(staged, planned)                                          # K8
        if database:
            self._lasting_views(database, planned)
        return PublishResult(run_id, path, counts["row_count"], counts["month_count"],
                             audit.counts() if audit is not None else None)

    def _promote(self, run_id: str, path: str, counts: dict) -> None:
        row = (self.name, run_id, path, int(counts["row_count"]), int(counts["month_count"]),
               dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1) \
            .write.parquet(f"{self.ledger_path}/run={run_id}")

    def _point_views(self, table: DataFrame, planned: dict[str, DataFrame]) -> None:
        table.createOrReplaceTempView(self.name)
        for view_name, df in planned.items():
            df.createOrReplaceTempView(view_name)

    def refresh_views(self, views: dict[str, Callable[[DataFrame], DataFrame]]) -> None:
        """(Re)point the table view and every dashboard view of this session at
        the promoted run; the views read its summaries."""
        table = self.read_current()
        self._point_views(table, _planned(table, self.read_current_summary(), self.read_current_pairs(), views))

    def register_views(self, database: str = "default",
                       views: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> list[str]:
        """K8: lasting views of a run that was published without them; later
        publishes with ``database`` keep them up.  Calling it again is harmless."""
        run = self.current_run()
        if run is None:
            raise FileNotFoundError(f"{self.name}: nothing published under {self.root}")
        table = self.spark.read.parquet(run["path"])
        planned = _planned(table, self.read_current_summary(), self.read_current_pairs(), VIEWS if views is None else views)
        self._write_results(run["run_id"], planned)
        return self._lasting_views(database, planned)

    def _write_results(self, run_id: str, planned: dict[str, DataFrame]) -> None:
        for view_name, df in planned.items():
            path = self.view_path(run_id, view_name)
            # rides_base is a projection of the table: not copied
            if view_name != "rides_base" and not storage.exists(self.spark, f"{path}/_SUCCESS"):
                df.write.mode("overwrite").parquet(path)

    def _lasting_views(self, database: str, planned: dict[str, DataFrame]) -> list[str]:
        """Define the table's view and those of ``planned``; one that has its
        definition already is not touched, so later publishes change no view."""
        current = (f"(SELECT max_by(run_id, struct(promoted_at, run_id)) FROM parquet.`{self.ledger_path}` "
                   f"WHERE table_name = '{self.name}')")
        table = self.read_current()
        sources = {self.name: (f"{self.root}/{self.name}", {c: f"`{c}`" for c in table.columns})}
        for view_name, df in planned.items():
            sources[view_name] = (sources[self.name][0], BASE_VIEW_SQL) if view_name == "rides_base" else (
                f"{self.root}/{self.name}_views/{view_name}", {c: f"`{c}`" for c in df.columns})
        for view_name, (path, columns) in sources.items():
            chosen = ", ".join(f"{e} AS `{c}`" for c, e in columns.items())
            text = f"SELECT {chosen} FROM parquet.`{path}` WHERE run_id = {current}"
            name = f"`{database}`.`{view_name}`"
            if not (self.spark.catalog.tableExists(f"{database}.{view_name}") and self._definition(name) == text):
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
        return sorted(sources)

    def _definition(self, name: str) -> str | None:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'").collect()
        return rows[0]["data_type"] if rows else None

    def drop_views(self, views=None) -> None:
        for view_name in (views if views is not None else VIEWS):
            self.spark.catalog.dropTempView(view_name)

    def vacuum(self, min_age: dt.timedelta = dt.timedelta(hours=24), keep_runs: int = 2) -> list[str]:
        """Delete run directories (with their summaries and view results) whose
        newest file is older than ``min_age``: those never promoted, which a
        driver lost between writing and promoting leaves behind, and those
        superseded, but for the newest ``keep_runs`` promoted.  Younger ones may
        belong to a job still writing or have readers, and stay."""
        folders = [f"{self.root}/{self.name}{kind}" for kind in ("", "_minutely", "_pairs")]
        folders += storage.list_dirs(self.spark, f"{self.root}/{self.name}_views")
        found = [(d, d.rstrip("/").rsplit("/run_id=", 1)[-1]) for folder in folders
                 for d in storage.list_dirs(self.spark, folder) if "/run_id=" in d]
        keep = {r["run_id"] for r in self._promoted().limit(max(keep_runs, 1)).select("run_id").collect()}
        now = dt.datetime.now(dt.timezone.utc)
        removed = []
        for d, run_id in found:
            changed = storage.last_modified(self.spark, d)
            if run_id not in keep and now - changed >= min_age:
                storage.delete(self.spark, d)
                removed.append(d)
        return removed


def _planned(table: DataFrame, summary: DataFrame | None, pairs: DataFrame | None,
             views: dict[str, Callable[[DataFrame], DataFrame]]) -> dict[str, DataFrame]:
    """Every view, analysed against the table or the summary that it reads."""
    def source(name: str) -> DataFrame:
        if summary is not None and name in SUMMARY_VIEWS:
            return summary
        return pairs if pairs is not None and name in PAIR_VIEWS else table

    return {n: build(source(n)) for n, build in views.items()}


def create_table_if_not_exists(spark: SparkSession, name: str, df: DataFrame, path: str) -> bool:
    """K4: ``CREATE TABLE IF NOT EXISTS … AS SELECT``; an existing table keeps
    its rows (D10).  Returns True when the table was created."""
    if spark.catalog.tableExists(name):
        return False
    df.write.option("path", path).saveAsTable(name)
    return True
