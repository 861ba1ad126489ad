"""Write the physical plans of the headline steps to PLANS.md.

Usage: python tools/plans.py [sf_dir]

Inputs are the files a production run reads (trips as Parquet, zones and
observations as CSV), written first under the session's checkpoint folder.
Plans are Spark's own ``explain()`` output, with long attribute lists cut.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tripweave.operators import measures as M  # noqa: E402
from tripweave.operators.weather import clean_weather  # noqa: E402
from tripweave.plans.rides import build_rides  # noqa: E402
from tripweave.session import get_session, scratch_path  # noqa: E402
from tripweave.sources.driver_tables import (  # noqa: E402
    observations_from_trips, raw_trips_from_events, table, zones_from_nations,
)
from tripweave.sources.files import read_observations, read_trips, read_zones, write_csv  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    text = re.sub(r"#\d+L?", "", buf.getvalue())
    lines = []
    for line in text.splitlines():
        lines.append(line if len(line) <= 220 else line[:217] + "...")
    return "\n".join(lines).strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", app="tripweave-plans", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    raw = raw_trips_from_events(table(spark, sf_dir, "events"))
    trips_path, zones_path, obs_path = (scratch_path(spark, n) for n in ("p-trips", "p-zones", "p-obs"))
    raw.write.parquet(trips_path)
    write_csv(zones_from_nations(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")), zones_path)
    write_csv(observations_from_trips(raw), obs_path)
    obs = (read_observations(spark, obs_path, extra_columns=["station_seq"])
           .withColumn("station_seq", F.col("station_seq").cast("bigint")))
    rides = build_rides(read_trips(spark, trips_path), read_zones(spark, zones_path), obs,
                        row_id="trip_id", tie_break=["station_seq"])
    rides_path = scratch_path(spark, "p-rides")
    rides.write.parquet(rides_path)
    written = spark.read.parquet(rides_path)
    summary_path = scratch_path(spark, "p-summary")
    M.minute_summary(written).write.parquet(summary_path)
    summary = spark.read.parquet(summary_path)
    pairs_path = scratch_path(spark, "p-pairs")
    M.pair_summary(written).write.parquet(pairs_path)
    pairs = spark.read.parquet(pairs_path)

    sections = [
        ("Enrichment (`build_rides`)",
         "One scan of the trips with the year range in `PushedFilters` and only the used columns in "
         "`ReadSchema`; three broadcast hash joins; the only exchange is the per-hour step of the "
         "observations.  This is the plan before adaptive execution, so the zone broadcast is "
         "listed for both roles; the two are the same plan, so the drop-off role reuses the "
         "pickup role's broadcast (`ReusedExchange` in the static plan).", rides),
        ("First observation per hour (`clean_weather`)",
         "`WindowGroupLimit` Partial before the exchange: each map task sends at most one row per hour.",
         clean_weather(obs, tie_break=["station_seq"])),
        ("Minute summary (`minute_summary`, written once per run)",
         "Trips aggregated by the minute alone (partial aggregation before the exchange); the hours' weather "
         "is joined to the minutes.",
         M.minute_summary(written)),
        ("ROLLUP over the summary (`measures_by_time`)",
         "No `Expand`: each level is aggregated from the level below it. This is the plan before adaptive "
         "execution; when it runs, equal exchanges are computed once.", M.measures_by_time(summary)),
        ("Grouping sets over the summary (`measures_by_weather`)",
         "Filter, then each set from the smallest set that holds it; the sort applies to the final small result.",
         M.measures_by_weather(summary)),
        ("Heatmap over the pair summary (`pickup_dropoff_heatmap`)",
         "Reads the pair summary only; the trips are not scanned.", M.pickup_dropoff_heatmap(pairs)),
        ("Dashboard filters over the pair summary (`dashboard_filters`)",
         "Reads six columns of the pair summary.", M.dashboard_filters(pairs)),
    ]
    out = ["# Physical plans", "",
           f"Generated by `python tools/plans.py` on {os.path.basename(sf_dir.rstrip('/'))}, "
           "Spark's `explain()` with attribute ids removed and long lines cut.  Inputs are files "
           "in their production form: trips as Parquet, zones and observations as CSV (no "
           "pushdown into CSV).", ""]
    for title, note, df in sections:
        out += [f"## {title}", "", note, "", "```", plan(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
