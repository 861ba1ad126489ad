"""Operator properties on the driver tables (sf0.001)."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripweave.operators import (
    canonical_trips, clean_trips, clean_weather, enrich, join_drop_report, with_zones,
)
from tripweave.operators import measures as M
from tripweave.operators.checks import ValidationError, assert_one_per_hour, assert_unique_ids, validate_rides
from tripweave.plans import registry as R
from tripweave.sources.driver_tables import raw_trips_from_orders, table


def test_canonical_mapping_first_available(spark):
    raw = spark.createDataFrame(
        [("B1", "L1", dt.datetime(2024, 3, 1, 10), dt.datetime(2024, 3, 1, 11), 2.0, 1, 2, 10.0, 8.0)],
        "h_license_num string, hvfhs_license_num string, pickup_datetime timestamp_ntz, "
        "dropoff_datetime timestamp_ntz, trip_miles double, PULocationID bigint, DOLocationID bigint, "
        "base_passenger_fare double, driver_pay double")
    row = canonical_trips(raw, "hvfhv").first()
    assert row["VendorID"] == "B1"          # h_license_num wins when present
    assert row["passenger_count"] == 1      # literal
    assert row["total_amount"] == 8.0       # driver pay is the "total"


def test_yellow_mapping(spark):
    raw = spark.createDataFrame(
        [(2, dt.datetime(2024, 10, 1, 8, 30), dt.datetime(2024, 10, 1, 8, 50), 3, 1.5, 4, 5, 9.0, 12.5)],
        "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count bigint, trip_distance double, PULocationID bigint, DOLocationID bigint, "
        "fare_amount double, total_amount double")
    row = clean_trips(raw, "yellow").first()
    assert row["passenger_count"] == 3
    assert row["pickup_hour"] == dt.datetime(2024, 10, 1, 8, 0)


def test_year_window_is_pushed_to_parquet(spark):
    raw = raw_trips_from_orders(table(spark, SF_SMALL, "orders"))
    trips = clean_trips(raw, year=1995, row_id="trip_id")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        trips.explain("formatted")
    plan = buf.getvalue()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    years = {r[0] for r in trips.select(F.year("pickup_datetime")).distinct().collect()}
    assert years == {1995}


def test_weather_one_row_per_hour_and_deterministic(spark):
    _, _, obs = R.inputs(spark, SF_SMALL)
    w1 = clean_weather(obs, tie_break=["station_seq"])
    assert_one_per_hour(w1)
    # the same rows whatever the input partitioning
    w2 = clean_weather(obs.repartition(7), tie_break=["station_seq"])
    assert sorted(map(tuple, w1.collect()), key=str) == sorted(map(tuple, w2.collect()), key=str)


def test_first_observation_wins(spark):
    obs = spark.createDataFrame([
        (2, "2024-01-01T10:40:00", "T", "50", "30", "+RA"),
        (1, "2024-01-01T10:05:00", "0.10", "60", "31", "-SN"),
        (3, "2024-01-01T10:05:00", "0.20", "70", "32", "RA"),
    ], "station_seq bigint, DATE string, HourlyPrecipitation string, HourlyRelativeHumidity string, "
       "HourlyDryBulbTemperature string, HourlyPresentWeatherType string")
    row = clean_weather(obs, tie_break=["station_seq"]).first()
    assert (row["severity"], row["condition"], row["humidity"]) == ("light", "SN", 60.0)


def test_enrich_never_multiplies_trips(spark):
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    trips = clean_trips(raw, row_id="trip_id")
    rides = R.rides(spark, SF_SMALL)
    assert_unique_ids(rides, "seq")
    assert rides.count() <= trips.count()
    report = join_drop_report(trips, zones, clean_weather(obs, tie_break=["station_seq"])).first()
    assert report["kept"] == rides.count()
    assert report["trips"] == trips.count()


def test_grouping_sets_totals(spark):
    rides = R.rides(spark, SF_SMALL)
    total = rides.count()
    by_time = M.measures_by_time(rides)
    assert by_time.filter(F.col("year").isNull()).first()["total_rides"] == total
    assert by_time.filter(F.col("minute").isNotNull()).agg(F.sum("total_rides")).first()[0] == total
    by_dow = M.measures_by_dow(rides)
    assert by_dow.filter(F.col("hour").isNull()).agg(F.sum("total_rides")).first()[0] == total
    assert by_dow.filter(F.col("dow").isNull()).agg(F.sum("total_rides")).first()[0] == total


def test_pre_aggregated_rollup_equals_single_pass(spark):
    """Brute force: the two-step rollup against one-pass SQL ROLLUP."""
    rides = R.rides(spark, SF_SMALL)
    rides.createOrReplaceTempView("rides_t")
    direct = spark.sql("""
        SELECT year(pickup_datetime) AS year, month(pickup_datetime) AS month,
               day(pickup_datetime) AS day, hour(pickup_datetime) AS hour,
               minute(pickup_datetime) AS minute, count(*) AS total_rides,
               avg(passenger_count) AS avg_passengers, avg(trip_distance) AS avg_distance,
               avg(fare_amount) AS avg_fare, avg(total_amount) AS avg_total_amount,
               sum(fare_amount) AS sum_fare, sum(total_amount) AS total_revenue
        FROM rides_t GROUP BY ROLLUP (year, month, day, hour, minute)""")
    got = R.for_compare(M.measures_by_time(rides))
    want = R.for_compare(direct)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_validation_rejects_empty(spark):
    rides = R.rides(spark, SF_SMALL)
    assert validate_rides(rides)["month_count"] == 1
    with pytest.raises(ValidationError):
        validate_rides(rides.limit(0))


def test_staging_counts_from_the_summary(spark):
    rides = R.rides(spark, SF_SMALL)
    wide = M.staging_counts(rides).first()
    small = M.staging_counts(M.minute_summary(rides)).first()
    assert (wide["row_count"], wide["month_count"]) == (small["row_count"], small["month_count"])
    empty = M.staging_counts(M.minute_summary(rides.filter(F.lit(False)))).first()
    assert (empty["row_count"], empty["month_count"]) == (0, 0)
    with pytest.raises(ValidationError):
        validate_rides(M.minute_summary(rides.filter(F.lit(False))))


def test_pre_cleaned_weather_gives_the_same_rides(spark, scratch):
    from tripweave.plans.rides import build_rides
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    path = scratch("weather-once")
    clean_weather(obs, tie_break=R.TIE_BREAK).write.parquet(path)
    a = build_rides(raw, zones, obs, row_id="trip_id", tie_break=R.TIE_BREAK)
    b = build_rides(raw, zones, None, row_id="trip_id", weather=spark.read.parquet(path))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_blank_condition_option(spark):
    """D5: '' stays a value by default; the option turns it into NULL."""
    obs = spark.createDataFrame(
        [("2024-03-04T10:05:00", "|RA:61", "0", "50", "40"), ("2024-03-04T11:05:00", "RA:02", "0", "50", "40")],
        "DATE string, HourlyPresentWeatherType string, HourlyPrecipitation string, "
        "HourlyRelativeHumidity string, HourlyDryBulbTemperature string")
    kept = {r["condition"] for r in clean_weather(obs).collect()}
    nulled = {r["condition"] for r in clean_weather(obs, blank_condition_as_null=True).collect()}
    assert kept == {"", "RA"} and nulled == {None, "RA"}
