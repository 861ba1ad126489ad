"""Incremental rides: the month-by-month backfill as a file stream.

The reference runs one batch job per month and marks finished work with flag
files.  Here a file-source stream over the trips folder does the same
bookkeeping with Spark's own checkpoint: each trip file is processed exactly
once, a rerun picks up only new files, and the Parquet file sink commits
each micro-batch atomically (readers of the output folder see committed
batches only).  ``availableNow`` processes what is there and stops, so it
runs like a batch job from any scheduler; without it the query keeps running.

The zone lookup and the hourly weather are static tables joined to the
stream (stream-static joins, broadcast after their size check).  The weather
is cleaned once when the query starts and written as a small Parquet table
under the shared scratch folder, so a micro-batch joins that table instead
of re-reading and re-ranking every observation; observations added later are
seen by the next start (each ``availableNow`` run).  Row ids must
be stable across batches, so ``seq`` is either a source column or a 64-bit
hash of the trip's columns instead of ``monotonically_increasing_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave.operators.weather import clean_weather
from tripweave.plans import storage
from tripweave.plans.rides import build_rides
from tripweave.session import scratch_path


def trip_hash_id(raw: DataFrame) -> Column:
    """xxhash64 over every source column: same trip, same id, in any batch."""
    return F.xxhash64(*[F.col(c) for c in raw.columns])


def start_incremental_rides(spark: SparkSession, trips_dir: str, zones: DataFrame,
                            observations: DataFrame, out_dir: str, *,
                            checkpoint: str | None = None, mapping: str | dict = "hvfhv",
                            year: int | None = 2024, trip_window: tuple | None = None,
                            row_id: str | None = None, tie_break: Sequence[str] = (),
                            max_files_per_trigger: int | None = None,
                            available_now: bool = True,
                            schema=None, recursive: bool = False) -> StreamingQuery:
    """``checkpoint`` defaults to ``<out_dir>_checkpoint``, next to the output and
    the same in every session; an output whose checkpoint is missing is refused.
    ``schema`` (StructType or DDL) fixes the trips' read schema, which
    also widens drifted column types per file (see ``read_trips``); by
    default it is taken from the files present at start.  ``recursive`` also reads
    files in folders below ``trips_dir``."""
    nested = str(recursive).lower()
    if schema is None:
        schema = spark.read.option("recursiveFileLookup", nested).parquet(trips_dir).schema
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", nested)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.parquet(trips_dir)
    rid = F.col(row_id) if row_id else trip_hash_id(raw)
    weather_path = scratch_path(spark, "stream-weather")
    clean_weather(observations, tie_break=tie_break).write.parquet(weather_path)
    rides = build_rides(raw, zones, None, mapping=mapping, year=year, trip_window=trip_window,
                        row_id=rid, weather=spark.read.parquet(weather_path))
    rides = rides.withColumn("month", F.date_format("pickup_datetime", "yyyy-MM"))
    out_dir = out_dir.rstrip("/")
    checkpoint = (checkpoint or f"{out_dir}_checkpoint").rstrip("/")
    if storage.exists(spark, f"{out_dir}/_spark_metadata") and not storage.exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{out_dir} holds a stream's output, but {checkpoint} is not its checkpoint: "
                         "a new start would take its first batches for committed and lose their trips")
    writer = (rides.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).partitionBy("month"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(out_dir)
