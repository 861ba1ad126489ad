"""Summaries kept up by deltas (A1–A11 and D-1 under K2).

Every run of new trips adds its own partial states, of both summaries, under
``<root>/deltas/run_id=<id>/{minutes,pairs}``; nothing older is read.  One ledger
row makes a run part of the summaries.  A reader adds up the states of the runs
that count, which are as small as the summaries themselves, not the trips.

``compact`` writes those sums as one run whose ledger row names the runs it
replaces, so readers change over at once and a failed compaction changes nothing.
``vacuum`` deletes, by age, runs that no longer count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, TimestampNTZType

from tripweave.operators.checks import ValidationError
from tripweave.operators.measures import merge_summaries, minute_summary, pair_summary
from tripweave.plans import storage
from tripweave.plans.publish import new_run_id

SUMMARIES = {"minutes": minute_summary, "pairs": pair_summary}

LEDGER = StructType([
    StructField("run_id", StringType()),
    StructField("replaces", ArrayType(StringType())),
    StructField("added_at", TimestampNTZType()),
])


class SummaryDeltas:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ledger_path = f"{self.root}/_deltas"

    def _path(self, run_id: str, summary: str) -> str:
        return f"{self.root}/deltas/run_id={run_id}/{summary}"

    def runs(self) -> list[str]:
        """Runs that count: those no other run has replaced (one ledger row a run)."""
        if not storage.exists(self.spark, self.ledger_path):
            return []
        ledger = (self.spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(self.ledger_path))
        gone = ledger.select(F.explode("replaces").alias("run_id"))
        return sorted(r[0] for r in ledger.select("run_id").join(gone, "run_id", "left_anti").toLocalIterator())

    def _write(self, run_id: str, parts: dict[str, DataFrame], replaces: list[str]) -> str:
        try:
            for name, df in parts.items():
                df.write.mode("errorifexists").parquet(self._path(run_id, name))
            row = (run_id, replaces, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
            (self.spark.createDataFrame([row], LEDGER).coalesce(1).write.parquet(f"{self.ledger_path}/run={run_id}"))
        except BaseException:
            if run_id not in self.runs():
                storage.delete(self.spark, f"{self.root}/deltas/run_id={run_id}")
            raise
        return run_id

    def append(self, rides: DataFrame, run_id: str | None = None) -> str:
        """Add the rides of one run.  A ``run_id`` that already counts, or did, is
        left alone, so a repeated job adds its trips once."""
        run_id = run_id or new_run_id()
        if storage.exists(self.spark, f"{self.ledger_path}/run={run_id}"):
            return run_id
        storage.delete(self.spark, f"{self.root}/deltas/run_id={run_id}")   # what a lost driver left
        return self._write(run_id, {name: build(rides) for name, build in SUMMARIES.items()}, [])

    def read(self, summary: str = "minutes") -> DataFrame:
        """The summary over all runs that count; a view takes it as it takes one
        computed in a single pass."""
        runs = self.runs()
        if not runs:
            raise FileNotFoundError(f"no summaries under {self.root}")
        return self._merged(runs, summary)

    def _merged(self, runs: list[str], summary: str) -> DataFrame:
        return merge_summaries(self.spark.read.parquet(*[self._path(r, summary) for r in runs]))

    def compact(self) -> str | None:
        """One run instead of all that count now; None when there is only one."""
        runs = self.runs()
        if len(runs) < 2:
            return None
        run_id = new_run_id()
        merged = {name: self._merged(runs, name) for name in SUMMARIES}
        self._write(run_id, merged, runs)
        if run_id not in self.runs():
            raise ValidationError(f"compaction {run_id} was replaced while it ran")
        return run_id

    def vacuum(self, min_age: dt.timedelta = dt.timedelta(hours=24)) -> list[str]:
        """Delete the files of runs that do not count and whose newest file is older
        than ``min_age``: replaced ones, and those of a driver lost while writing."""
        keep, now, removed = set(self.runs()), dt.datetime.now(dt.timezone.utc), []
        for d in storage.list_dirs(self.spark, f"{self.root}/deltas"):
            run_id = d.rstrip("/").rsplit("/run_id=", 1)[-1]
            if run_id not in keep and now - storage.last_modified(self.spark, d) >= min_age:
                storage.delete(self.spark, d)
                removed.append(d)
        return removed
