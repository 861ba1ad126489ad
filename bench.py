"""Benchmark: the enrichment job and every dashboard view.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.

Setup (untimed, reported as ``setup_sec``) writes the pipeline's inputs in
their production form under the session's checkpoint folder: raw trips as
Parquet files, the zone lookup and the observations as CSV.  (The driver's
test tables are single-row-group files, which Spark can only scan with one
task; real monthly trip files have many row groups.)  Timed: the enrichment
job from those files, written as Parquet, then every view over the written
table, as publishing does: both summaries are written once, the ten
time and weather views read the minute summary, heatmap and filters the pair
summary, the base view the rides table.
  * ``ev_*``: trips from ``events`` (one month, 100k trips at sf0.1);
  * ``li_*``: trips from ``lineitem`` (seven years, 600k trips at sf0.1),
    observations derived from the same trips.
Each query runs to completion through the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripweave.operators import measures as M  # noqa: E402
from tripweave.plans.rides import build_rides  # noqa: E402
from tripweave.session import get_session, scratch_path  # noqa: E402
from tripweave.sources.driver_tables import (  # noqa: E402
    observations_from_trips, raw_trips_from_events, raw_trips_from_lineitem, table,
    zones_from_nations,
)
from tripweave.sources.files import read_observations, read_trips, read_zones, write_csv  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", app="tripweave-bench",
                        shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    t_setup = time.perf_counter()
    zones_csv = scratch_path(spark, "bench-zones")
    write_csv(zones_from_nations(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")), zones_csv)
    zones = read_zones(spark, zones_csv)
    setup = 0.0

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    fixtures = {
        "ev": (raw_trips_from_events(table(spark, sf_dir, "events")),
               ("2024-01-01 00:00:00", "2025-01-01 00:00:00")),
        # the whole span of the ship dates (1995–2001): every trip is kept
        "li": (raw_trips_from_lineitem(table(spark, sf_dir, "lineitem")),
               ("1995-01-01 00:00:00", "2002-01-01 00:00:00")),
    }
    files = {}
    for prefix, (derived, window) in fixtures.items():
        trips_path = scratch_path(spark, f"bench-trips-{prefix}")
        obs_path = scratch_path(spark, f"bench-obs-{prefix}")
        derived.repartition(int(cpus) * 2).write.parquet(trips_path)
        write_csv(observations_from_trips(derived), obs_path)
        files[prefix] = (trips_path, obs_path, window)
    setup = round(time.perf_counter() - t_setup, 3)
    for prefix, (trips_path, obs_path, window) in files.items():
        raw = read_trips(spark, trips_path)
        obs = (read_observations(spark, obs_path, extra_columns=["station_seq"])
               .withColumn("station_seq", F.col("station_seq").cast("bigint")))
        out = scratch_path(spark, f"bench-rides-{prefix}")
        rides = build_rides(raw, zones, obs, trip_window=window,
                            row_id="trip_id", tie_break=["station_seq"])
        timed(f"{prefix}_build_rides",
              lambda: rides.write.option("maxRecordsPerFile", 100_000).parquet(out))
        written = spark.read.parquet(out)
        summary_out = scratch_path(spark, f"bench-summary-{prefix}")
        timed(f"{prefix}_minute_summary",
              lambda: M.minute_summary(written).write.parquet(summary_out))
        summary = spark.read.parquet(summary_out)
        pairs_out = scratch_path(spark, f"bench-pairs-{prefix}")
        timed(f"{prefix}_pair_summary", lambda: M.pair_summary(written).write.parquet(pairs_out))
        pairs = spark.read.parquet(pairs_out)
        for name, builder in M.VIEWS.items():
            source = summary if name in M.SUMMARY_VIEWS else pairs if name in M.PAIR_VIEWS else written
            timed(f"{prefix}_{name}", lambda b=builder, src=source: run(b(src)))
        timed(f"{prefix}_staging_counts", lambda: run(M.staging_counts(written)))

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "setup_sec": setup, "sf": sf}))


if __name__ == "__main__":
    main()
