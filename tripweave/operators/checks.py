"""Data checks (V2–V5).  Each is one aggregation pass; only a one-row
result reaches the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripweave.operators.measures import staging_counts


#: Weather rows of a ride's hour; only there for an audit.
HOUR_ROWS = "_hour_rows"


class ValidationError(RuntimeError):
    pass


def validate_rides(rides: DataFrame) -> dict:
    """V2 + V3: at least one row and at least one pickup month (from the wide
    table or from its minute summary)."""
    row = staging_counts(rides).first()
    result = {"row_count": row["row_count"], "month_count": row["month_count"]}
    if result["row_count"] <= 0:
        raise ValidationError("staged rides table is empty")
    if result["month_count"] <= 0:
        raise ValidationError("staged rides table contains no pickup months")
    return result


def duplicate_hours(weather: DataFrame) -> DataFrame:
    """V4: hours with more than one weather row (must be empty before the hour join)."""
    return weather.groupBy("HOUR").count().filter(F.col("count") > 1)


def assert_one_per_hour(weather: DataFrame) -> None:
    n = duplicate_hours(weather).count()
    if n:
        raise ValidationError(f"{n} hours have more than one weather row")


def assert_unique_ids(df: DataFrame, column: str = "seq") -> None:
    """V5: the row id is a key of the output."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(column).alias("d")).first()
    if row["n"] != row["d"]:
        raise ValidationError(f"{column}: {row['n']} rows but {row['d']} distinct values")


#: Ids count as dense when they fill a 64th of their range: a bitmap of them is
#: then smaller than the ids.
DENSE = 64


def has_repeated_ids(df: DataFrame, column: str = "seq") -> bool:
    """V5 at any size, exact.  Dense whole numbers meet in bitmaps of 32,768 ids
    (one bit per id crosses the network, combined in each task); other ids are
    grouped.  Reads that one column."""
    ids = df.select(F.col(column).alias("id"))
    if ids.schema["id"].dataType.typeName() in ("long", "integer"):
        low, high, n = ids.agg(F.min("id"), F.max("id"), F.count("id")).first()
        if n and high - low < DENSE * n:
            place = F.col("id") - F.lit(low)
            per = ids.filter("id is not null").groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
                F.count(F.lit(1)).alias("n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(place))).alias("d"))
            return not per.filter("n > d").isEmpty()
    return not ids.groupBy("id").count().filter("id is not null and count > 1").isEmpty()


class RideAudit:
    """What the enrichment saw while its result was written (V4, D2), from
    ``DataFrame.observe``: no further pass over the trips.

    One audit belongs to one plan and is read after its first action."""

    def __init__(self):
        self._seen = {name: Observation(f"{name}-{uuid.uuid4().hex[:8]}") for name in ("trips", "zoned", "rides")}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        metrics = [F.count(F.lit(1)).alias("n")]
        if HOUR_ROWS in df.columns:
            metrics.append(F.max(HOUR_ROWS).alias("hour_rows"))
        return df.observe(self._seen[name], *metrics)

    def counts(self) -> dict[str, int]:
        """trips (cleaned), zoned (with both zones), rides (with weather)."""
        return {name: seen.get["n"] for name, seen in self._seen.items()}

    def check(self) -> None:
        rows = self._seen["rides"].get.get("hour_rows")
        if rows is not None and rows > 1:
            raise ValidationError(f"an hour of rides has {rows} weather rows: its trips were written {rows} times")


def hour_uniqueness(weather: DataFrame, rides: DataFrame) -> DataFrame:
    """V4 and V5 as a small report, one ``(metric, value)`` row each: weather
    rows, hours with more than one weather row, rides rows, distinct ``seq``."""
    per_hour = weather.groupBy("HOUR").agg(F.count(F.lit(1)).alias("n"))
    w = per_hour.agg(F.sum("n").cast("bigint").alias("weather_rows"),
                     F.count_if(F.col("n") > 1).alias("duplicate_hours"))
    r = rides.agg(F.count(F.lit(1)).alias("rides_rows"),
                  F.count_distinct("seq").alias("distinct_seq"))
    long_w = w.select(F.inline(F.array(
        F.struct(F.lit("weather_rows").alias("metric"), F.col("weather_rows").alias("value")),
        F.struct(F.lit("duplicate_hours").alias("metric"), F.col("duplicate_hours").alias("value")))))
    long_r = r.select(F.inline(F.array(
        F.struct(F.lit("rides_rows").alias("metric"), F.col("rides_rows").alias("value")),
        F.struct(F.lit("distinct_seq").alias("metric"), F.col("distinct_seq").alias("value")))))
    return long_w.unionByName(long_r)
