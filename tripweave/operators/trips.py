"""Trip cleaning (C1: P1–P6, F1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.timecols import hour_bucket, year_window
from tripweave.operators.running import running, written
from tripweave.schemas import MAPPINGS, TRIP_COLUMNS


def _source_expr(df: DataFrame, spec) -> Column:
    if isinstance(spec, (list, tuple)):
        # First candidate present in the files' schema (plan time, no data read).
        present = {c.lower(): c for c in df.columns}
        for name in spec:
            if name.lower() in present:
                return F.col(present[name.lower()])
        raise ValueError(f"none of the columns {list(spec)} is present")
    if isinstance(spec, str):
        return F.col(spec)
    if isinstance(spec, Column):
        return spec
    return F.lit(spec)  # P4: literal


def _spec(mapping) -> dict:
    return MAPPINGS[mapping] if isinstance(mapping, str) else mapping


def canonical_trips(raw: DataFrame, mapping: str | dict = "hvfhv") -> DataFrame:
    """Select and rename to the canonical trip schema."""
    spec = _spec(mapping)
    return raw.select(*[_source_expr(raw, spec[name]).alias(name) for name in TRIP_COLUMNS])


def clean_trips(raw: DataFrame, mapping: str | dict = "hvfhv", *,
                year: int | None = 2024, window: tuple | None = None,
                row_id: str | Column | None = None,
                keep: Callable[[DataFrame], Column] | None = None,
                stable_id: bool = False) -> DataFrame:
    """Canonical columns, pickup and drop-off inside the window, a row id
    and the pickup hour.

    ``window=(lo, hi)`` is half-open and overrides ``year``; both ``None``
    keeps every trip.  The range is written on the renamed columns; Catalyst
    maps it back through the projection, so it reaches the Parquet scan as
    ``PushedFilters``.

    ``row_id``: a source column (or expression) to use as ``seq``; default is
    ``monotonically_increasing_id()`` like the reference (unique within one
    run, not across runs — D9).

    ``keep`` gives one more condition on the canonical trips.  It is applied
    before the default row id, which no filter passes on its way to the scan.

    ``stable_id``: ids that last over runs and partitionings, see
    ``with_stable_id``.
    """
    if stable_id and row_id is not None:
        raise ValueError("either a row id column or stable ids")
    spec = _spec(mapping)
    cols = [_source_expr(raw, spec[name]).alias(name) for name in TRIP_COLUMNS]
    if row_id is not None:
        rid = F.col(row_id) if isinstance(row_id, str) else row_id
        cols.append(rid.cast("bigint").alias("seq"))
    trips = raw.select(*cols)
    if window is None and year is not None:
        window = (f"{year}-01-01 00:00:00", f"{year + 1}-01-01 00:00:00")
    if window is not None:
        trips = trips.filter(year_window(trips, ["pickup_datetime", "dropoff_datetime"], *window))
    if keep is not None:
        trips = trips.filter(keep(trips))
    if stable_id:
        trips = with_stable_id(trips)
    elif row_id is None:
        trips = trips.withColumn("seq", F.monotonically_increasing_id())
    return trips.withColumn("pickup_hour", hour_bucket("pickup_datetime"))


def with_stable_id(trips: DataFrame) -> DataFrame:
    """P5 for good: ``seq`` is a 128-bit hash of the trip's columns as 32 hex
    digits, the same in any run and partitioning.  Trips equal in every column
    share it; they are told apart by ``-2``, ``-3`` and so on, numbered over
    distributed ranges, so copies that are a large share of all trips need no task
    of their own.

    Only hashes are grouped to find repeated ones.  The trips are read twice."""
    # a null is not the same as its neighbour's value one column further: hash it with its place
    columns = [F.struct(F.lit(i), F.col(c).isNull(), F.col(c)) for i, c in enumerate(trips.columns)]
    halves = [F.lpad(F.lower(F.hex(F.xxhash64(*columns, *more))), 16, "0") for more in ((), (F.lit(1),))]
    hashed = trips.withColumn("seq", F.concat(*halves))
    # written: a small table is broadcast, and the trips are not shuffled for it
    repeated = written(hashed.groupBy("seq").count().filter("count > 1").select("seq"), "repeated-ids")
    if repeated.isEmpty():
        return hashed
    copies = running(hashed.join(repeated, "seq", "left_semi"), ["seq"], [], {"_copy": ("sum", F.lit(1).cast("long"))})
    numbered = copies.withColumn("seq", F.when(F.col("_copy") == 1, F.col("seq")).otherwise(
        F.concat("seq", F.lit("-"), F.col("_copy").cast("string")))).drop("_copy")
    return hashed.join(repeated, "seq", "left_anti").unionByName(numbered)
