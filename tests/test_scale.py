"""Plan shape and skew: what must hold at any data size.

These tests read plans (``explain``) and build inputs where one key holds a
large share of the rows, the case that breaks plans at scale.
"""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripweave.operators import clean_weather, enrich, join_drop_report, with_zones
from tripweave.operators import measures as M
from tripweave.operators.checks import assert_one_per_hour
from tripweave.operators.trips import clean_trips
from tripweave.plans import registry as R
from tripweave.plans.backfill import _in_months
from tripweave.plans.publish import RidesStore
from tripweave.plans.rides import build_rides
from tripweave.sources import read_trips
from tripweave.sources.files import set_split_size
from tripweave.streaming.incremental import trip_hash_id


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_enrichment_broadcasts_and_never_shuffles_trips(spark):
    """Three broadcast hash joins; the only exchange is the per-hour step of
    the observations, never one over the trips."""
    plan = _plan(R.rides(spark, SF_SMALL), "simple")
    for key in ("pickup_location", "dropoff_location", "pickup_hour"):
        assert f"BroadcastHashJoin [{key}" in plan
    assert "SortMergeJoin" not in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and all("HOUR" in line for line in shuffles)


def test_first_per_hour_limits_rows_before_the_shuffle(spark):
    _, _, obs = R.inputs(spark, SF_SMALL)
    plan = _plan(clean_weather(obs, tie_break=["station_seq"]), "simple")
    # a partial WindowGroupLimit below the exchange: one row per hour per map task
    lines = plan.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exchange:])


def test_coarser_grains_come_from_finer_ones(spark):
    """No ``Expand``: the trips are aggregated once, at the finest grain; when the
    plan has run, coarser levels read the exchanges of finer ones again."""
    rides = R.rides(spark, SF_SMALL)
    for view in (M.measures_by_time, M.measures_by_dow, M.measures_by_weather):
        df = view(rides)
        assert "Expand" not in _plan(df, "simple")
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_pair_views_read_their_summary_only(spark, scratch):
    path = scratch("pairs")
    M.pair_summary(R.rides(spark, SF_SMALL)).write.parquet(path)
    pairs = spark.read.parquet(path)
    for view in M.PAIR_VIEWS:
        text = _plan(M.VIEWS[view](pairs), "simple")
        assert text.count("FileScan") == 1 and "pickup_datetime" not in text


def test_weather_broadcast_bound(spark):
    """Three cases: the trip window's hour count is within the cap (broadcast,
    no count job); it is not, but the counted rows are (broadcast); the
    counted rows exceed the cap (shuffle join on the hour)."""
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    build = lambda cap: build_rides(raw, zones, obs, row_id="trip_id",
                                    tie_break=["station_seq"], max_broadcast_rows=cap)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # only the library's own broadcast marks count here, not the planner's estimate
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_window, by_count, shuffled = build(10_000), build(1_000), build(100)
        assert "BroadcastHashJoin [pickup_hour" in _plan(by_window, "simple")
        assert "BroadcastHashJoin [pickup_hour" in _plan(by_count, "simple")
        plan = _plan(shuffled, "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin [pickup_hour" not in plan
    assert "SortMergeJoin [pickup_hour" in plan or "ShuffledHashJoin [pickup_hour" in plan
    assert shuffled.exceptAll(by_window).count() == 0 and shuffled.count() == by_window.count()


def _hot_trips(spark, n=3000):
    """A third of all trips in one hour and one pickup zone."""
    base = dt.datetime(2024, 3, 4, 0, 0)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        pickup = base + (dt.timedelta(minutes=i % 50) if hot else dt.timedelta(hours=1 + i % 40, minutes=i % 60))
        rows.append((i, "B1", pickup, pickup + dt.timedelta(minutes=10), float(i % 9),
                     1 if hot else 1 + i % 4, 1 + i % 3, float(i % 17), float(i % 13)))
    return spark.createDataFrame(
        rows, "trip_id bigint, hvfhs_license_num string, pickup_datetime timestamp_ntz, "
              "dropoff_datetime timestamp_ntz, trip_miles double, PULocationID bigint, "
              "DOLocationID bigint, base_passenger_fare double, driver_pay double")


def _zones(spark):
    return spark.createDataFrame([(str(k), f"B{k % 2}", f"Z{k}") for k in range(1, 5)],
                                 "LocationID string, Borough string, Zone string")


def _obs(spark, hours=41, per_hour=5):
    base = dt.datetime(2024, 3, 4, 0, 0)
    rows = [((base + dt.timedelta(hours=h, minutes=m * 7)).isoformat(sep=" "), "RA", "0.1", "80", "40", m)
            for h in range(hours) for m in range(per_hour)]
    return spark.createDataFrame(rows, "DATE string, HourlyPresentWeatherType string, HourlyPrecipitation string, "
                                       "HourlyRelativeHumidity string, HourlyDryBulbTemperature string, station_seq bigint")


def test_hot_hour_and_zone_keep_every_row(spark):
    raw = _hot_trips(spark)
    rides = build_rides(raw, _zones(spark), _obs(spark), row_id="trip_id", tie_break=["station_seq"])
    n = raw.count()
    assert rides.count() == n                                    # nothing dropped, nothing multiplied
    assert rides.select("seq").distinct().count() == n
    hot = rides.filter(F.col("pickup_hour") == dt.datetime(2024, 3, 4, 0, 0)).count()
    assert hot == n // 3
    by_hour = M.rides_over_time(rides, ordered=False)
    assert by_hour.agg(F.sum("total_rides")).first()[0] == n
    report = join_drop_report(clean_trips(raw, row_id="trip_id"), _zones(spark),
                              clean_weather(_obs(spark), tie_break=["station_seq"])).first()
    assert (report["trips"], report["kept"]) == (n, n)


def test_hot_hour_of_observations(spark):
    """A third of all observations in one hour still gives one row for it."""
    obs = _obs(spark, hours=10, per_hour=3).unionByName(_obs(spark, hours=1, per_hour=15))
    w = clean_weather(obs.repartition(6), tie_break=["station_seq"])
    assert_one_per_hour(w)
    assert w.count() == 10


def test_hash_id_is_stable_across_partitionings(spark):
    raw = R.inputs(spark, SF_SMALL)[0]
    a = raw.select("trip_id", trip_hash_id(raw).alias("h"))
    b = raw.repartition(5).select("trip_id", trip_hash_id(raw).alias("h"))
    assert a.exceptAll(b).count() == 0
    assert a.select("h").distinct().count() == raw.count()


def test_single_file_scan(spark, scratch):
    """S3: one Parquet file read directly."""
    raw = R.inputs(spark, SF_SMALL)[0]
    folder = scratch("one-file")
    raw.coalesce(1).write.parquet(folder)
    files = [f for f in spark.sparkContext.wholeTextFiles(folder).keys().collect() if f.endswith(".parquet")]
    assert len(files) == 1
    assert read_trips(spark, files[0]).count() == raw.count()


def test_split_size_is_a_session_setting(spark, scratch):
    """The session setting changes the input splits; a reader option does not."""
    folder = scratch("splits")
    spark.range(200_000).withColumn("v", F.rand(1)).coalesce(1).write.parquet(folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        set_split_size(spark, 128 * 1024 * 1024)
        default = spark.read.parquet(folder).rdd.getNumPartitions()
        as_option = spark.read.option("maxPartitionBytes", "20000").parquet(folder).rdd.getNumPartitions()
        set_split_size(spark, 200_000)
        small = spark.read.parquet(folder).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert as_option == default
    assert small > default


def test_max_records_per_file(spark, scratch):
    """K1: at most N rows in any output file."""
    folder = scratch("max-records")
    spark.range(10_000).coalesce(1).write.option("maxRecordsPerFile", 4_000).parquet(folder)
    files = spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 3 and max(r["count"] for r in files) <= 4_000


def test_drop_views(spark, scratch):
    """K9: the dashboard views go away, the published table stays readable."""
    store = RidesStore(spark, scratch("store-drop"))
    store.publish(R.rides(spark, SF_SMALL))
    assert spark.catalog.tableExists("measures_by_dow")
    store.drop_views()
    assert not spark.catalog.tableExists("measures_by_dow")
    assert store.read_current().count() > 0


def test_zone_roles_use_one_lookup(spark):
    """The same lookup in both roles; trips keep their own zones."""
    raw, zones, _ = R.inputs(spark, SF_SMALL)
    zoned = with_zones(clean_trips(raw, row_id="trip_id"), zones)
    z = zones.select(F.col("LocationID").cast("bigint").alias("k"), F.col("Zone").alias("z"))
    bad = (zoned.join(z, zoned["pickup_location"] == z["k"])
           .filter(F.col("pickup_zone") != F.col("z")).count())
    assert bad == 0
    assert enrich(zoned, clean_weather(R.inputs(spark, SF_SMALL)[2], tie_break=["station_seq"])).count() \
        <= zoned.count()


def test_month_ranges_reach_the_scan_without_a_row_id(spark):
    """The default row id stops filters; the months are applied before it."""
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = _plan(build_rides(raw, zones, obs, keep=lambda t: _in_months(t, ["2024-02", "2024-05"])), "simple")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line.split("PushedFilters")[1] for line in plan.splitlines() if "PushedFilters" in line]
    assert any("2024-02-01" in p and "2024-06-01" in p for p in pushed)
