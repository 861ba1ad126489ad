"""Pipeline inputs derived from the driver's test tables.

The reference reads ride-hail trips (Parquet), a zone lookup (CSV) and
hourly observations (CSV).  The driver ships TPC-H-like tables instead, so
these adapters shape them into the reference's input schemas, lazily, with
Spark: every derived input grows with the tables it comes from.

* trips        <- ``events`` (Jan 2024), ``orders`` (1995–2001, year tests),
                  ``lineitem`` (bench scale)
* zones        <- ``nation`` joined with ``region`` (25 zones; trip keys 25–29
                  match none, so the inner zone join drops some trips)
* observations <- the raw trips themselves: one observation per trip, those of
                  hour 5 with a ``DATE`` that does not parse (so the hour join
                  drops some trips), several per hour (so the first-per-hour
                  rule matters)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values — present-weather texts assigned to observations by ``seq % 7``.
WEATHER_CODE_FIXTURES = [
    "-RA:02 BR:1 |RA |", "+SN:03", "|FG:2", "HZ:7 |FU |HZ", None, "RA BR", "+FG",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def raw_trips_from_events(events: DataFrame) -> DataFrame:
    """Ride-hail-shaped raw trips, one per event."""
    return events.select(
        F.col("event_id").alias("trip_id"),
        F.col("event_type").alias("hvfhs_license_num"),
        F.col("ts").alias("pickup_datetime"),
        (F.col("ts") + _minutes(F.col("event_id") % 60)).alias("dropoff_datetime"),
        F.get_json_object("props", "$.k").try_cast("double").alias("trip_miles"),
        (F.col("user_id") % 30).alias("PULocationID"),
        (F.col("event_id") % 25).alias("DOLocationID"),
        F.col("value").alias("base_passenger_fare"),
        F.round(F.col("value") * 0.8, 2).alias("driver_pay"),
    )


def raw_yellow_trips_from_events(events: DataFrame) -> DataFrame:
    """Yellow-taxi-shaped raw trips (real vendor id and passenger count)."""
    return events.select(
        F.col("event_id").alias("trip_id"),
        (F.col("user_id") % 3).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + _minutes(F.col("event_id") % 60)).alias("tpep_dropoff_datetime"),
        (F.col("event_id") % 4 + 1).alias("passenger_count"),
        F.get_json_object("props", "$.k").try_cast("double").alias("trip_distance"),
        (F.col("user_id") % 30).alias("PULocationID"),
        (F.col("event_id") % 25).alias("DOLocationID"),
        F.col("value").alias("fare_amount"),
        F.round(F.col("value") * 1.2, 2).alias("total_amount"),
    )


def raw_trips_from_orders(orders: DataFrame) -> DataFrame:
    """Raw trips spread over seven calendar years (for the year window)."""
    return orders.select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_orderstatus").alias("hvfhs_license_num"),
        F.col("o_orderdate").alias("pickup_datetime"),
        (F.col("o_orderdate") + _minutes(F.col("o_orderkey") % 60)).alias("dropoff_datetime"),
        (F.col("o_custkey") % 50).cast("double").alias("trip_miles"),
        (F.col("o_custkey") % 25).alias("PULocationID"),
        (F.col("o_orderkey") % 25).alias("DOLocationID"),
        F.col("o_totalprice").alias("base_passenger_fare"),
        F.round(F.col("o_totalprice") * 0.8, 2).alias("driver_pay"),
    )


def raw_trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Bench-scale raw trips: pickup = ship date plus a minute offset, so that
    hours and minutes vary."""
    pickup = F.col("l_shipdate") + _minutes((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1440)
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("trip_id"),
        F.col("l_returnflag").alias("hvfhs_license_num"),
        pickup.alias("pickup_datetime"),
        (pickup + _minutes((F.col("l_orderkey") + F.col("l_linenumber")) % 45)).alias("dropoff_datetime"),
        F.col("l_quantity").alias("trip_miles"),
        (F.col("l_suppkey") % 30).alias("PULocationID"),
        (F.col("l_partkey") % 25).alias("DOLocationID"),
        F.col("l_extendedprice").alias("base_passenger_fare"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("driver_pay"),
    )


def zones_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone lookup as text columns, like the CSV."""
    return (nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
            .select(F.col("n_nationkey").cast("string").alias("LocationID"),
                    F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone")))


def observations_from_trips(raw_trips: DataFrame) -> DataFrame:
    """Observation text rows (all strings, like the CSV) plus ``station_seq``."""
    seq = F.col("trip_id")
    fare_text = F.col("base_passenger_fare").cast("string")
    k = seq % 5
    precip = (F.when(k == 0, F.lit("T")).when(k == 1, F.concat(fare_text, F.lit("s")))
              .when(k == 2, fare_text).when(k == 3, F.lit("*")).otherwise(F.lit(None).cast("string")))
    c = seq % 7
    code = F.lit(None).cast("string")
    for i, text in reversed(list(enumerate(WEATHER_CODE_FIXTURES))):
        code = F.when(c == i, F.lit(text).cast("string")).otherwise(code)
    date = (F.when(F.hour("pickup_datetime") == 5, F.date_format("pickup_datetime", "dd.MM.yyyy HH:mm"))
            .otherwise(F.date_format("pickup_datetime", "yyyy-MM-dd'T'HH:mm:ss")))
    return (raw_trips
            .select(seq.alias("station_seq"),
                    date.alias("DATE"),
                    precip.alias("HourlyPrecipitation"),
                    (seq % 101).cast("string").alias("HourlyRelativeHumidity"),
                    (seq % 95).cast("string").alias("HourlyDryBulbTemperature"),
                    code.alias("HourlyPresentWeatherType")))
