"""Batch and stream jobs for ``spark-submit`` (or ``python -m tripweave``).

    spark-submit tripweave/jobs.py build    TRIPS ZONES WEATHER OUTPUT [options]
    spark-submit tripweave/jobs.py publish  TRIPS ZONES WEATHER ROOT   [options]
    spark-submit tripweave/jobs.py backfill TRIPS ZONES WEATHER ROOT --months 2024-01 ...
    spark-submit tripweave/jobs.py stream   TRIPS_DIR ZONES WEATHER OUTPUT [--checkpoint DIR]

``TRIPS`` is a Parquet file, folder or glob (expanded by Spark on any file
system); ``ZONES`` and ``WEATHER`` are CSV files with a header.  Every job
first checks that all inputs exist and names each missing one (V1); a glob
that matches nothing is an error.  ``build`` writes the rides table (at most
``--max-records`` rows per file); ``publish`` writes a run, validates it and
promotes it together with its lasting views in ``--database``; ``backfill`` writes the given months (skipping
finished ones unless ``--force``); ``stream`` processes new trip files only.

The exit status is 0 on success and 1 on any error; ``publish`` and
``backfill`` leave the published data untouched when they fail.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    # run as a file by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripweave.operators.checks import RideAudit  # noqa: E402
from tripweave.plans.backfill import backfill  # noqa: E402
from tripweave.operators.weather import split_observations  # noqa: E402
from tripweave.plans.publish import RidesStore, new_run_id  # noqa: E402
from tripweave.plans.rides import build_rides  # noqa: E402
from tripweave.session import get_session  # noqa: E402
from tripweave.sources.files import read_observations, read_trips, read_zones, require_inputs  # noqa: E402
from tripweave.streaming.incremental import start_incremental_rides  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tripweave", description="trips enriched with zones and hourly weather")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("build", "publish", "backfill", "stream"):
        s = sub.add_parser(name)
        s.add_argument("trips")
        s.add_argument("zones")
        s.add_argument("weather")
        s.add_argument("output")
        s.add_argument("--mapping", choices=["hvfhv", "yellow"], default="hvfhv")
        if name != "backfill":   # a backfill's months name their years
            s.add_argument("--year", type=int, default=2024, help="pickup and drop-off year (0: any)")
        s.add_argument("--row-id", default=None, help="source column to use as seq")
        s.add_argument("--recursive", action="store_true", help="list TRIPS recursively")
        s.add_argument("--trip-schema", default=None,
                       help="read schema of the trips as DDL (widens int32/float columns that drifted)")
        if name != "stream":
            s.add_argument("--stable-id", action="store_true", help="row ids that last over runs (instead of --row-id)")
            s.add_argument("--weather-from", default=None, help="first hour kept, e.g. 2024-01-01")
            s.add_argument("--weather-until", default=None, help="first hour dropped, e.g. 2024-02-01")
            s.add_argument("--max-records", type=int, default=100_000, help="rows per output file")
        if name in ("build", "publish"):
            s.add_argument("--rejects", default=None,
                           help="folder for the observations by state, with what was refused and why (a sub-folder per run)")
        if name == "publish":
            s.add_argument("--database", default="default", help="database of the lasting views")
        if name == "backfill":
            s.add_argument("--months", nargs="+", required=True, help="YYYY-MM")
            s.add_argument("--force", action="store_true", help="redo finished months")
        if name == "stream":
            s.add_argument("--checkpoint", default=None)
            s.add_argument("--max-files-per-trigger", type=int, default=None)
    return p


def _weather_window(args):
    if args.weather_from is None and args.weather_until is None:
        return None
    return (args.weather_from or "0001-01-01 00:00:00", args.weather_until or "9999-12-31 00:00:00")


def run(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or get_session(app=f"tripweave-{args.command}")
    year = getattr(args, "year", None) or None
    require_inputs(spark, {"trips": args.trips, "zones": args.zones, "weather": args.weather},
                   fmt={"zones": "csv", "weather": "csv"},
                   recursive={"trips"} if getattr(args, "recursive", False) else frozenset())
    zones = read_zones(spark, args.zones)
    weather = read_observations(spark, args.weather)
    if args.command == "stream":
        query = start_incremental_rides(
            spark, args.trips, zones, weather, args.output, checkpoint=args.checkpoint,
            mapping=args.mapping, year=year, row_id=args.row_id,
            max_files_per_trigger=args.max_files_per_trigger, schema=args.trip_schema,
            recursive=args.recursive)
        query.awaitTermination()
        return 0
    trips = read_trips(spark, args.trips, recursive=args.recursive, schema=args.trip_schema)
    if args.command == "backfill":
        done = backfill(spark, trips, zones, weather, args.output, args.months, mapping=args.mapping,
                        force=args.force, row_id=args.row_id, max_records_per_file=args.max_records,
                        weather_window=_weather_window(args), stable_id=args.stable_id)
        print(f"months written: {', '.join(done) or 'none'}")
        return 0
    if args.rejects:
        path = f"{args.rejects.rstrip('/')}/run_id={new_run_id()}"
        weather, rejected = split_observations(weather, path)
        for row in rejected.groupBy("field", "reason", "state").count().orderBy("field", "reason", "state").collect():
            print(f"refused {row['field']}: {row['reason']}, row {row['state']}: {row['count']}")
    audit = RideAudit()
    rides = build_rides(trips, zones, weather, mapping=args.mapping, year=year,
                        weather_window=_weather_window(args), row_id=args.row_id, stable_id=args.stable_id, audit=audit)
    if args.command == "build":
        (rides.write.mode("overwrite").option("maxRecordsPerFile", args.max_records)
         .parquet(args.output))
        return 0
    result = RidesStore(spark, args.output).publish(rides, max_records_per_file=args.max_records,
                                                       database=args.database, audit=audit)
    print(f"published run {result.run_id}: {result.row_count} rows, {result.month_count} months; "
          f"of {result.joins['trips']} trips {result.joins['zoned']} have both zones, {result.joins['rides']} weather too")
    return 0


def main(argv: list[str] | None = None) -> None:
    try:
        code = run(argv)
    except Exception as exc:  # noqa: BLE001 - report and exit non-zero, as a job should
        print(f"tripweave: {type(exc).__name__}: {exc}", file=sys.stderr)
        code = 1
    sys.exit(code)


if __name__ == "__main__":
    main()
