"""Sources, publishing, backfill and the incremental stream."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripweave.operators.checks import ValidationError
from tripweave.plans import registry as R
from tripweave.plans import storage
from tripweave.plans.backfill import backfill, completed_months, current_months, months_ledger, read_backfilled
from tripweave.plans.publish import RidesStore, create_table_if_not_exists, new_run_id
from tripweave.plans.rides import build_rides
from tripweave.sources import InputMissingError, infer_schema, read_trips, require_inputs
from tripweave.streaming import start_incremental_rides


def test_glob_without_match_is_an_error(spark, scratch):
    with pytest.raises(InputMissingError):
        read_trips(spark, scratch("nothing") + "/*.parquet")


def test_require_inputs_lists_every_missing_one(spark, scratch):
    with pytest.raises(InputMissingError) as err:
        require_inputs(spark, {"zones": scratch("z") + "/zones.csv", "weather": scratch("w") + "/w.csv",
                               "trips": f"{SF_SMALL}/events.parquet"},
                       fmt={"zones": "csv", "weather": "csv"})
    assert "zones" in str(err.value) and "weather" in str(err.value) and "trips" not in str(err.value)


def test_infer_schema_merges_files(spark, scratch):
    path = scratch("merge")
    spark.range(3).withColumn("a", F.lit(1)).write.parquet(f"{path}/p=1")
    spark.range(3).withColumn("B", F.lit("x")).write.parquet(f"{path}/p=2")
    names = set(infer_schema(spark, path).fieldNames())
    assert {"id", "a", "B", "p"} <= names


def test_create_table_if_not_exists_keeps_rows(spark, scratch):
    name = "tw_if_absent"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = scratch("tbl")
    assert create_table_if_not_exists(spark, name, spark.range(5), path)
    assert not create_table_if_not_exists(spark, name, spark.range(50), path)
    assert spark.table(name).count() == 5
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_publish_views_and_old_runs(spark, scratch):
    store = RidesStore(spark, scratch("store"))
    rides = R.rides(spark, SF_SMALL)
    first = store.publish(rides)
    assert spark.table("rides").count() == first.row_count
    assert spark.table("measures_by_time").filter(F.col("year").isNull()).first()["total_rides"] == first.row_count
    second = store.publish(rides)
    assert store.current_run()["run_id"] == second.run_id
    assert storage.exists(spark, first.path)           # superseded, but it may have readers
    store.vacuum(dt.timedelta(0))
    assert storage.exists(spark, first.path)           # two runs are kept
    store.vacuum(dt.timedelta(0), keep_runs=1)
    assert not storage.exists(spark, first.path)
    assert storage.exists(spark, second.path)
    assert "rides_staging" not in [t.name for t in spark.catalog.listTables()]


def test_failed_publish_leaves_production(spark, scratch):
    store = RidesStore(spark, scratch("store"))
    rides = R.rides(spark, SF_SMALL)
    good = store.publish(rides)
    with pytest.raises(ValidationError):
        store.publish(rides.filter(F.lit(False)))
    assert store.current_run()["run_id"] == good.run_id
    assert store.read_current().count() == good.row_count
    runs = storage.list_dirs(spark, f"{store.root}/rides")
    assert len(runs) == 1                                # the failed stage is gone


def test_backfill_dynamic_overwrite_and_force(spark, scratch):
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    root = scratch("bf")
    kw = dict(row_id="trip_id", tie_break=R.TIE_BREAK)
    assert backfill(spark, raw, zones, obs, root, ["2024-01"], **kw) == ["2024-01"]
    n = read_backfilled(spark, root).count()
    assert completed_months(spark, root) == {"2024-01"}
    assert backfill(spark, raw, zones, obs, root, ["2024-01"], **kw) == []
    # a month without trips is recorded and leaves January alone
    assert backfill(spark, raw, zones, obs, root, ["2024-02"], **kw) == ["2024-02"]
    assert read_backfilled(spark, root).count() == n
    assert backfill(spark, raw, zones, obs, root, ["2024-01"], force=True, **kw) == ["2024-01"]
    assert read_backfilled(spark, root, ["2024-01"]).count() == n
    assert months_ledger(spark, root).count() == 3


def test_stream_processes_only_new_files(spark, scratch):
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    trips_dir, out, ckpt = scratch("sin"), scratch("sout"), scratch("sck")
    first = raw.filter(F.dayofmonth("pickup_datetime") <= 15)
    rest = raw.filter(F.dayofmonth("pickup_datetime") > 15)
    first.write.mode("append").parquet(trips_dir)
    kw = dict(checkpoint=ckpt, row_id="trip_id", tie_break=R.TIE_BREAK)
    start_incremental_rides(spark, trips_dir, zones, obs, out, **kw).awaitTermination()
    n1 = spark.read.parquet(out).count()
    rest.write.mode("append").parquet(trips_dir)
    start_incremental_rides(spark, trips_dir, zones, obs, out, **kw).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == R.rides(spark, SF_SMALL).count() > n1
    assert got.select("seq").distinct().count() == got.count()


def test_published_summary_feeds_the_time_and_weather_views(spark, scratch):
    """Each of the ten summary views, read from the run's written minute
    summary, equals the same view computed from the table."""
    from tripweave.operators import measures as M
    store = RidesStore(spark, scratch("store-summary"))
    rides = R.rides(spark, SF_SMALL)
    store.publish(rides)
    summary = store.read_current_summary()
    assert summary is not None
    assert summary.agg(F.sum("_n")).first()[0] == rides.count()
    # one row per pickup minute: the weather columns follow the hour
    assert summary.count() == summary.select("pickup_minute").distinct().count()
    table = store.read_current()
    for name in M.SUMMARY_VIEWS:
        got = R.for_compare(spark.table(name))
        want = R.for_compare(M.VIEWS[name](table))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
    # superseded runs lose their summary too
    first_run = store.current_run()["run_id"]
    store.publish(rides)
    store.vacuum(dt.timedelta(0), keep_runs=1)
    assert not storage.exists(spark, store.summary_path(first_run))


def test_failed_publish_removes_the_staged_summary(spark, scratch):
    store = RidesStore(spark, scratch("store-fail-summary"))
    with pytest.raises(ValidationError):
        store.publish(R.rides(spark, SF_SMALL).filter(F.lit(False)))
    assert storage.list_dirs(spark, f"{store.root}/{store.name}_minutely") == []
    assert storage.list_dirs(spark, f"{store.root}/{store.name}") == []


def test_backfill_summary_per_month(spark, scratch):
    """The month-partitioned summary equals the rides of the same months, and a
    forced rerun of one month replaces only that month's summary."""
    from tripweave.operators import measures as M
    from tripweave.sources.driver_tables import observations_from_trips, raw_trips_from_orders, table
    raw = raw_trips_from_orders(table(spark, SF_SMALL, "orders"))
    _, zones, _ = R.inputs(spark, SF_SMALL)
    obs = observations_from_trips(raw)
    root = scratch("bf-summary")
    months = ["1995-01", "1995-02", "1995-03"]
    kw = dict(row_id="trip_id", tie_break=R.TIE_BREAK)
    backfill(spark, raw, zones, obs, root, months, **kw)
    backfill(spark, raw, zones, obs, root, ["1995-02"], force=True, **kw)
    rides = read_backfilled(spark, root).drop("month")
    summary = read_backfilled(spark, root, table="summary").drop("month")
    assert rides.count() > 0
    assert summary.agg(F.sum("_n")).first()[0] == rides.count()
    for name in ("measures_by_time", "rides_over_day", "measures_by_weather"):
        got, want = R.for_compare(M.VIEWS[name](summary)), R.for_compare(M.VIEWS[name](rides))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def _job_inputs(spark, scratch):
    """Trips as Parquet files and the lookups as CSV, as a job receives them."""
    from tripweave.sources.files import write_csv
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    trips, zpath, wpath = scratch("job-trips"), scratch("job-zones"), scratch("job-weather")
    raw.repartition(3).write.parquet(trips)
    write_csv(zones, zpath)
    write_csv(obs, wpath)
    return trips, zpath, wpath


def test_job_build_and_publish(spark, scratch):
    from tripweave.jobs import run
    trips, zpath, wpath = _job_inputs(spark, scratch)
    out = scratch("job-out")
    assert run(["build", f"{trips}/*.parquet", zpath, wpath, out, "--row-id", "trip_id",
                "--max-records", "300"], spark=spark) == 0
    built = spark.read.parquet(out)
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    from tripweave.sources.files import read_observations, read_zones
    want = build_rides(raw, read_zones(spark, zpath), read_observations(spark, wpath), row_id="trip_id")
    assert built.count() == want.count() and built.exceptAll(want).count() == 0
    assert built.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 300
    root = scratch("job-store")
    assert run(["publish", trips, zpath, wpath, root, "--row-id", "trip_id"], spark=spark) == 0
    assert RidesStore(spark, root).read_current().count() == want.count()


def test_job_names_every_missing_input(spark, scratch):
    from tripweave.jobs import run
    trips, zpath, _ = _job_inputs(spark, scratch)
    with pytest.raises(InputMissingError) as err:
        run(["build", trips, zpath, scratch("no-weather") + "/w.csv", scratch("o")], spark=spark)
    assert "weather" in str(err.value) and "zones" not in str(err.value)


def test_job_backfill_skips_finished_months(spark, scratch, capsys):
    from tripweave.jobs import run
    trips, zpath, wpath = _job_inputs(spark, scratch)
    root = scratch("job-bf")
    args = ["backfill", trips, zpath, wpath, root, "--months", "2024-01", "--row-id", "trip_id"]
    assert run(args, spark=spark) == 0
    assert run(args, spark=spark) == 0
    assert capsys.readouterr().out.splitlines()[-1] == "months written: none"
    assert completed_months(spark, root) == {"2024-01"}


def test_scratch_space_is_the_sessions_checkpoint_dir(spark, scratch):
    from tripweave.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    assert scratch("x").startswith(base.rstrip("/") + "/tripweave-x-")
    assert scratch("x") != scratch("x")


def test_backfill_of_months_without_trips(spark, scratch):
    """A first run whose months hold no trips records them with 0 rows."""
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    root = scratch("bf-empty")
    assert backfill(spark, raw, zones, obs, root, ["2023-05"], row_id="trip_id",
                    tie_break=R.TIE_BREAK) == ["2023-05"]
    assert [(r["month"], r["row_count"]) for r in months_ledger(spark, root).collect()] == [("2023-05", 0)]


def test_vacuum_removes_only_old_unpromoted_runs(spark, scratch):
    store = RidesStore(spark, scratch("store-vacuum"))
    current = store.publish(R.rides(spark, SF_SMALL))
    lost = store.run_path("20000101T000000-deadbeef")          # a driver died before promoting
    fresh = store.run_path("20000101T000000-00c0ffee")         # begun long ago, still writing
    spark.range(3).write.parquet(lost)
    spark.range(3).write.parquet(fresh)
    for f in Path(lost.removeprefix("file:")).rglob("*"):
        os.utime(f, (0, 0))
    removed = store.vacuum(dt.timedelta(hours=1))
    assert [r.rstrip("/").rsplit("/", 1)[-1] for r in removed] == ["run_id=20000101T000000-deadbeef"]
    assert storage.exists(spark, fresh) and storage.exists(spark, current.path)
    assert not storage.exists(spark, lost)


def test_broken_view_leaves_production(spark, scratch):
    store = RidesStore(spark, scratch("store-broken"))
    rides = R.rides(spark, SF_SMALL)
    good = store.publish(rides)
    with pytest.raises(Exception, match="no_such_column"):
        store.publish(rides.limit(5), views={"broken": lambda df: df.select("no_such_column")})
    assert store.current_run()["run_id"] == good.run_id
    assert store.read_current().count() == good.row_count == spark.table("rides").count()
    assert len(storage.list_dirs(spark, f"{store.root}/rides")) == 1


def test_interrupt_after_promotion_keeps_the_run(spark, scratch, monkeypatch):
    store = RidesStore(spark, scratch("store-interrupt"))
    promote = store._promote

    def interrupted(*args):
        promote(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(store, "_promote", interrupted)
    with pytest.raises(KeyboardInterrupt):
        store.publish(R.rides(spark, SF_SMALL))
    assert store.read_current().count() == store.current_run()["row_count"] > 0


def test_two_publishers_and_an_open_reader(spark, scratch):
    root = scratch("store-two")
    one, two = RidesStore(spark, root), RidesStore(spark, root, name="others")
    rides = R.rides(spark, SF_SMALL)
    first = one.publish(rides)
    reader = one.read_current()
    two.publish(rides.limit(7))
    one.publish(rides.limit(5))
    assert reader.count() == first.row_count
    assert (one.read_current().count(), two.read_current().count(), one.ledger().count()) == (5, 7, 3)


def test_read_schema_widens_drifted_months(spark, scratch):
    """Monthly files with int32/int64 and float/double for the same column."""
    path = scratch("drift")
    spark.range(5).select(F.col("id").cast("int").alias("passenger_count"),
                          F.col("id").cast("float").alias("fare")).write.parquet(f"{path}/month=2024-01")
    spark.range(5).select(F.col("id").cast("bigint").alias("passenger_count"),
                          F.col("id").cast("double").alias("fare")).write.parquet(f"{path}/month=2024-02")
    df = read_trips(spark, path, schema="passenger_count bigint, fare double, month string")
    row = df.agg(F.sum("passenger_count").alias("p"), F.sum("fare").alias("f"), F.count_distinct("month").alias("m")).first()
    assert (row["p"], row["f"], row["m"]) == (20, 20.0, 2)


def test_job_stream_with_a_read_schema(spark, scratch):
    from tripweave.jobs import run
    from tripweave.sources.files import read_observations, read_zones
    trips, zpath, wpath = _job_inputs(spark, scratch)
    out, ckpt = scratch("job-stream-out"), scratch("job-stream-ck")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(trips).schema.fields)
    assert run(["stream", trips, zpath, wpath, out, "--row-id", "trip_id", "--checkpoint", ckpt,
                "--trip-schema", ddl, "--max-files-per-trigger", "1"], spark=spark) == 0
    raw, _, _ = R.inputs(spark, SF_SMALL)
    want = build_rides(raw, read_zones(spark, zpath), read_observations(spark, wpath), row_id="trip_id")
    got = spark.read.parquet(out).drop("month")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def _trip_rows(spark, rows):
    """Trips, zones and hourly observations for pickups and drop-offs given as text."""
    import datetime as dt
    ts = lambda x: dt.datetime.strptime(x, "%Y-%m-%d %H:%M")
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    kept = R.rides(spark, SF_SMALL).first()["seq"]   # a trip whose zones are known
    one = raw.filter(F.col("trip_id") == kept).limit(1).drop("pickup_datetime", "dropoff_datetime", "trip_id")
    times = spark.createDataFrame([(i, ts(a), ts(b)) for i, (a, b) in enumerate(rows)],
                                  "trip_id long, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz")
    seen = obs.limit(1).drop("DATE").crossJoin(
        times.select(F.date_format("pickup_datetime", "yyyy-MM-dd'T'HH:00:00").alias("DATE")).distinct())
    return one.crossJoin(times).select(*raw.columns), zones, seen.select(*obs.columns)


def test_backfill_does_not_depend_on_batching(spark, scratch):
    raw, zones, obs = _trip_rows(spark, [("2023-12-31 23:50", "2024-01-01 00:10"), ("2023-12-05 10:00", "2023-12-05 10:20"),
                                         ("2024-01-03 10:00", "2024-01-03 10:20")])
    months = ["2023-12", "2024-01"]
    once, twice = scratch("once"), scratch("twice")
    backfill(spark, raw, zones, obs, once, months, row_id="trip_id")
    for m in months:
        backfill(spark, raw, zones, obs, twice, [m], row_id="trip_id")
    count = lambda root: {m: n for m, (_, n) in current_months(spark, root).items()}
    assert count(once) == count(twice) == {"2023-12": 1, "2024-01": 1}


def test_forced_month_without_trips_is_emptied(spark, scratch):
    raw, zones, obs = _trip_rows(spark, [("2024-01-03 10:00", "2024-01-03 10:20"), ("2024-02-03 10:00", "2024-02-03 10:20")])
    root = scratch("emptied")
    backfill(spark, raw, zones, obs, root, ["2024-01", "2024-02"], row_id="trip_id")
    assert read_backfilled(spark, root).count() == 2
    backfill(spark, raw.filter("trip_id = 0"), zones, obs, root, ["2024-02"], force=True, row_id="trip_id")
    assert [r["month"] for r in read_backfilled(spark, root).collect()] == ["2024-01"]
    assert read_backfilled(spark, root, ["2024-02"]).count() == 0
    assert read_backfilled(spark, root, table="summary").count() == 1


def test_failed_summary_leaves_the_month(spark, scratch, monkeypatch):
    from tripweave.plans import backfill as module
    raw, zones, obs = _trip_rows(spark, [("2024-01-03 10:00", "2024-01-03 10:20")])
    root = scratch("failed")
    backfill(spark, raw, zones, obs, root, ["2024-01"], row_id="trip_id")
    before = current_months(spark, root)

    def broken(_):
        raise RuntimeError("no summary")

    monkeypatch.setattr(module, "minute_summary", broken)
    with pytest.raises(RuntimeError):
        backfill(spark, raw.filter("trip_id < 0"), zones, obs, root, ["2024-01"], force=True, row_id="trip_id")
    assert current_months(spark, root) == before and read_backfilled(spark, root).count() == 1
    assert len(storage.list_dirs(spark, f"{root}/rides")) == 1


def test_stream_restarts_where_it_stopped(spark, scratch):
    raw, zones, obs = _trip_rows(spark, [("2024-01-03 10:00", "2024-01-03 10:20"), ("2024-01-04 10:00", "2024-01-04 10:20")])
    trips, out, other = scratch("trips"), scratch("out"), scratch("other")
    raw.filter("trip_id = 0").write.parquet(trips)
    start = lambda to, **kw: start_incremental_rides(
        spark, trips, zones, obs, to, row_id="trip_id", **kw).awaitTermination()
    start(out)
    raw.filter("trip_id = 1").write.mode("append").parquet(trips)
    start(out)
    start(other)
    assert spark.read.parquet(out).count() == spark.read.parquet(other).count() == 2
    with pytest.raises(ValueError, match="not its checkpoint"):
        start(out, checkpoint=scratch("new"))
