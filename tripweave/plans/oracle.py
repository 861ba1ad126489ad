"""Independent SQL for every driver query, written for DuckDB.

The CTEs restate the adapters and the cleaning rules in plain SQL; DuckDB
has no look-ahead in regular expressions, so the condition pattern consumes
the ``:`` instead of looking at it (same group 1).  Double results are cast
to FLOAT, as the Spark side presents them (see ``registry.for_compare``).
"""

from __future__ import annotations

RAW_EVENTS = """
raw AS (
  SELECT event_id AS trip_id, event_type AS hvfhs_license_num, ts AS pickup_datetime,
         ts + to_minutes(CAST(event_id % 60 AS INTEGER)) AS dropoff_datetime,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS trip_miles,
         user_id % 30 AS PULocationID, event_id % 25 AS DOLocationID,
         value AS base_passenger_fare, round(value * 0.8, 2) AS driver_pay
  FROM events)"""

TRIPS = """
trips AS (
  SELECT trip_id AS seq, hvfhs_license_num AS VendorID, pickup_datetime, dropoff_datetime,
         1 AS passenger_count, trip_miles AS trip_distance, PULocationID AS pickup_location,
         DOLocationID AS dropoff_location, base_passenger_fare AS fare_amount,
         driver_pay AS total_amount, date_trunc('hour', pickup_datetime) AS pickup_hour
  FROM raw
  WHERE pickup_datetime >= TIMESTAMP '{lo}' AND pickup_datetime < TIMESTAMP '{hi}'
    AND dropoff_datetime >= TIMESTAMP '{lo}' AND dropoff_datetime < TIMESTAMP '{hi}')"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS LocationID, r_name AS Borough, n_name AS Zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

OBS = """
obs AS (
  SELECT trip_id AS station_seq,
         CASE WHEN extract(hour FROM pickup_datetime) = 5 THEN strftime(pickup_datetime, '%d.%m.%Y %H:%M')
              ELSE strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S') END AS DATE,
         CASE trip_id % 5 WHEN 0 THEN 'T'
                          WHEN 1 THEN CAST(base_passenger_fare AS VARCHAR) || 's'
                          WHEN 2 THEN CAST(base_passenger_fare AS VARCHAR)
                          WHEN 3 THEN '*' ELSE NULL END AS HourlyPrecipitation,
         CAST(trip_id % 101 AS VARCHAR) AS HourlyRelativeHumidity,
         CAST(trip_id % 95 AS VARCHAR) AS HourlyDryBulbTemperature,
         CASE trip_id % 7 WHEN 0 THEN '-RA:02 BR:1 |RA |' WHEN 1 THEN '+SN:03'
                          WHEN 2 THEN '|FG:2' WHEN 3 THEN 'HZ:7 |FU |HZ' WHEN 4 THEN NULL
                          WHEN 5 THEN 'RA BR' WHEN 6 THEN '+FG' END AS HourlyPresentWeatherType
  FROM raw)"""

PARSED = """
parsed AS (
  SELECT TRY_CAST(DATE AS TIMESTAMP) AS obs_ts,
         date_trunc('hour', TRY_CAST(DATE AS TIMESTAMP)) AS HOUR,
         TRY_CAST(CASE WHEN HourlyPrecipitation = 'T' THEN '0'
                       ELSE regexp_replace(HourlyPrecipitation, 's$', '') END AS FLOAT) AS precipitation,
         TRY_CAST(HourlyRelativeHumidity AS FLOAT) AS humidity,
         TRY_CAST(HourlyDryBulbTemperature AS FLOAT) AS temperature,
         split_part(HourlyPresentWeatherType, '|', 1) AS code,
         station_seq
  FROM obs)"""

WEATHER = """
weather AS (
  SELECT HOUR, precipitation, humidity, temperature,
         CASE WHEN code IS NULL THEN NULL
              WHEN contains(code, '-') THEN 'light'
              WHEN contains(code, '+') THEN 'heavy'
              ELSE 'moderate' END AS severity,
         regexp_extract(code, '[+-]?(\\w+)(:|$)', 1) AS condition
  FROM parsed
  {where}
  QUALIFY row_number() OVER (PARTITION BY HOUR ORDER BY obs_ts, station_seq) = 1)"""

ZONED = """
zoned AS (
  SELECT t.*, p.Borough AS pickup_borough, p.Zone AS pickup_zone,
         d.Borough AS dropoff_borough, d.Zone AS dropoff_zone
  FROM trips t
  JOIN zones p ON t.pickup_location = TRY_CAST(p.LocationID AS BIGINT)
  JOIN zones d ON t.dropoff_location = TRY_CAST(d.LocationID AS BIGINT))"""

RIDES = """
rides AS (
  SELECT seq, VendorID, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
         fare_amount, total_amount, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone,
         pickup_hour, precipitation, humidity, temperature, severity, condition
  FROM zoned JOIN weather w ON zoned.pickup_hour = w.HOUR)"""

Y2024 = {"lo": "2024-01-01 00:00:00", "hi": "2025-01-01 00:00:00"}


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _weather(where: str = "") -> str:
    return WEATHER.format(where=where)


BASE = _with(RAW_EVENTS, TRIPS.format(**Y2024), ZONES, OBS, PARSED, _weather(), ZONED, RIDES)

F = "CAST({0} AS FLOAT) AS {1}"


def fl(expr: str, name: str | None = None) -> str:
    return F.format(expr, name or expr)


M7 = ", ".join([
    "COUNT(*) AS total_rides",
    fl("AVG(passenger_count)", "avg_passengers"),
    fl("AVG(trip_distance)", "avg_distance"),
    fl("AVG(fare_amount)", "avg_fare"),
    fl("AVG(total_amount)", "avg_total_amount"),
    fl("SUM(fare_amount)", "sum_fare"),
    fl("SUM(total_amount)", "total_revenue"),
])
M6 = ", ".join([
    "COUNT(*) AS total_rides",
    fl("AVG(passenger_count)", "avg_passengers"),
    fl("AVG(trip_distance)", "avg_distance"),
    fl("AVG(fare_amount)", "avg_fare"),
    fl("AVG(total_amount)", "avg_total_amount"),
    fl("SUM(total_amount)", "total_revenue"),
])
M3 = ", ".join([
    "COUNT(*) AS total_rides",
    fl("AVG(trip_distance)", "avg_distance"),
    fl("AVG(total_amount)", "avg_total_amount"),
])

RIDE_COLS = (
    "seq, VendorID, pickup_datetime, dropoff_datetime, passenger_count, "
    + fl("trip_distance") + ", " + fl("fare_amount") + ", " + fl("total_amount") + ", "
    "pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, pickup_hour, "
    "precipitation, humidity, temperature, severity, condition"
)

HOUR = "CAST(EXTRACT(hour FROM pickup_datetime) AS INTEGER)"

SQL: dict[str, str] = {}

SQL["trips_canonical"] = _with(RAW_EVENTS, TRIPS.format(**Y2024)) + f"""
SELECT seq, VendorID, pickup_datetime, dropoff_datetime, passenger_count,
       {fl('trip_distance')}, pickup_location, dropoff_location,
       {fl('fare_amount')}, {fl('total_amount')}, pickup_hour
FROM trips"""

SQL["trips_year_window"] = _with("""
raw AS (
  SELECT o_orderkey AS trip_id, o_orderstatus AS hvfhs_license_num, o_orderdate AS pickup_datetime,
         o_orderdate + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS dropoff_datetime,
         CAST(o_custkey % 50 AS DOUBLE) AS trip_miles, o_custkey % 25 AS PULocationID,
         o_orderkey % 25 AS DOLocationID, o_totalprice AS base_passenger_fare,
         round(o_totalprice * 0.8, 2) AS driver_pay
  FROM orders)""", TRIPS.format(lo="1995-01-01 00:00:00", hi="1996-01-01 00:00:00")) + f"""
SELECT seq, VendorID, pickup_datetime, dropoff_datetime, passenger_count,
       {fl('trip_distance')}, pickup_location, dropoff_location,
       {fl('fare_amount')}, {fl('total_amount')}, pickup_hour
FROM trips"""

SQL["zone_roles"] = _with(RAW_EVENTS, TRIPS.format(**Y2024), ZONES, ZONED) + f"""
SELECT seq, VendorID, pickup_datetime, dropoff_datetime, passenger_count, {fl('trip_distance')},
       pickup_location, dropoff_location, {fl('fare_amount')}, {fl('total_amount')}, pickup_hour,
       pickup_borough, pickup_zone, dropoff_borough, dropoff_zone
FROM zoned"""

SQL["weather_hourly"] = _with(RAW_EVENTS, OBS, PARSED, _weather()) + """
SELECT HOUR, precipitation, humidity, temperature, severity, condition FROM weather"""

SQL["weather_month_window"] = _with(RAW_EVENTS, OBS, PARSED, _weather(
    "WHERE HOUR >= TIMESTAMP '2024-01-10 00:00:00' AND HOUR < TIMESTAMP '2024-01-20 00:00:00'")) + """
SELECT HOUR, precipitation, humidity, temperature, severity, condition FROM weather"""

SQL["rides_enriched"] = BASE + f"SELECT {RIDE_COLS} FROM rides"

SQL["rides_yellow"] = _with(RAW_EVENTS, """
yellow AS (
  SELECT event_id AS seq, user_id % 3 AS VendorID, ts AS pickup_datetime,
         ts + to_minutes(CAST(event_id % 60 AS INTEGER)) AS dropoff_datetime,
         event_id % 4 + 1 AS passenger_count,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS trip_distance,
         user_id % 30 AS pickup_location, event_id % 25 AS dropoff_location,
         value AS fare_amount, round(value * 1.2, 2) AS total_amount,
         date_trunc('hour', ts) AS pickup_hour
  FROM events)""", """
trips AS (
  SELECT * FROM yellow
  WHERE pickup_datetime >= TIMESTAMP '2024-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '2025-01-01 00:00:00'
    AND dropoff_datetime >= TIMESTAMP '2024-01-01 00:00:00' AND dropoff_datetime < TIMESTAMP '2025-01-01 00:00:00')""",
    ZONES, OBS, PARSED, _weather(
    "WHERE HOUR >= TIMESTAMP '2024-01-01 00:00:00' AND HOUR < TIMESTAMP '2024-02-01 00:00:00'"),
    ZONED, RIDES) + f"SELECT {RIDE_COLS} FROM rides"

SQL["rides_typed"] = BASE + f"""
SELECT seq, VendorID, pickup_datetime, dropoff_datetime, passenger_count,
       {fl('trip_distance')}, {fl('fare_amount')}, {fl('total_amount')},
       pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, pickup_hour, precipitation,
       CAST(humidity AS INTEGER) AS humidity, CAST(temperature AS INTEGER) AS temperature,
       severity, condition
FROM rides"""

SQL["rides_base"] = BASE + f"""
SELECT pickup_datetime, pickup_hour,
       CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS pickup_date,
       left(dayname(pickup_datetime), 3) AS dow,
       {HOUR} AS pickup_hour_of_day,
       pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, passenger_count,
       {fl('trip_distance')}, {fl('fare_amount')}, {fl('total_amount')},
       precipitation, humidity, temperature, condition, severity
FROM rides"""

SQL["minute_summary"] = BASE + f"""
SELECT date_trunc('minute', pickup_datetime) AS pickup_minute, pickup_hour,
       precipitation, humidity, temperature, severity, condition,
       COUNT(*) AS _n,
       CAST(SUM(passenger_count) AS BIGINT) AS _s_passenger_count, COUNT(passenger_count) AS _c_passenger_count,
       {fl('SUM(trip_distance)', '_s_trip_distance')}, COUNT(trip_distance) AS _c_trip_distance,
       {fl('SUM(fare_amount)', '_s_fare_amount')}, COUNT(fare_amount) AS _c_fare_amount,
       {fl('SUM(total_amount)', '_s_total_amount')}, COUNT(total_amount) AS _c_total_amount
FROM rides
GROUP BY ALL"""

SQL["pair_summary"] = BASE + f"""
SELECT CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS pickup_date, {HOUR} AS hour_of_day,
       pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, condition, severity,
       COUNT(*) AS _n,
       {fl('SUM(trip_distance)', '_s_trip_distance')}, COUNT(trip_distance) AS _c_trip_distance,
       {fl('SUM(total_amount)', '_s_total_amount')}, COUNT(total_amount) AS _c_total_amount
FROM rides
GROUP BY ALL"""

SQL["summary_after_two_deltas"] = SQL["minute_summary"]
SQL["summary_after_compaction"] = SQL["pair_summary"]

SQL["measures_by_time"] = BASE + f"""
SELECT CAST(EXTRACT(year FROM pickup_datetime) AS INTEGER) AS year,
       CAST(EXTRACT(month FROM pickup_datetime) AS INTEGER) AS month,
       CAST(EXTRACT(day FROM pickup_datetime) AS INTEGER) AS day,
       CAST(EXTRACT(hour FROM pickup_datetime) AS INTEGER) AS hour,
       CAST(EXTRACT(minute FROM pickup_datetime) AS INTEGER) AS minute,
       {M7}
FROM rides
GROUP BY ROLLUP (year, month, day, hour, minute)"""

SQL["measures_by_dow"] = BASE + f"""
SELECT dayname(pickup_datetime) AS dow, {HOUR} AS hour, {M7}
FROM rides
GROUP BY GROUPING SETS ((dow, hour), (dow), (hour))"""

SQL["measures_by_weather"] = BASE + f"""
SELECT dayname(pickup_datetime) AS dow, {HOUR} AS hour, condition, severity, {M7}
FROM rides
WHERE dayname(pickup_datetime) IS NOT NULL AND pickup_datetime IS NOT NULL
  AND condition IS NOT NULL AND severity IS NOT NULL
GROUP BY GROUPING SETS ((condition, severity), (condition, dow),
  (condition, severity, dow), (condition), (condition, severity, dow, hour),
  (condition, dow, hour))"""

SQL["rides_over_time"] = BASE + f"""
SELECT date_trunc('hour', pickup_datetime) AS ts_hour, {M6}
FROM rides GROUP BY date_trunc('hour', pickup_datetime)"""

SQL["rides_over_day"] = BASE + f"""
SELECT CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS ts_day, {M6}
FROM rides GROUP BY 1"""

SQL["avg_rides_per_dow"] = BASE + f"""
, daily_counts AS (
  SELECT date_trunc('day', pickup_datetime) AS pickup_date,
         left(dayname(pickup_datetime), 3) AS dow, COUNT(*) AS daily_rides
  FROM rides GROUP BY 1, 2)
SELECT dow, {fl('AVG(daily_rides)', 'avg_rides_per_day')},
       MIN(daily_rides) AS min_rides_per_day, MAX(daily_rides) AS max_rides_per_day
FROM daily_counts GROUP BY dow"""

SQL["rides_by_weather"] = BASE + f"""
SELECT COALESCE(condition, 'Unknown') AS condition, COALESCE(severity, 'Unknown') AS severity,
       COUNT(*) AS total_rides, {fl('AVG(trip_distance)', 'avg_distance')},
       {fl('AVG(fare_amount)', 'avg_fare')}, {fl('AVG(total_amount)', 'avg_total_amount')}
FROM rides GROUP BY 1, 2"""

for _m in ("precipitation", "temperature", "humidity"):
    SQL[f"{_m}_vs_rides"] = BASE + f"""
SELECT pickup_hour, condition, severity, {_m}, {M3}
FROM rides WHERE {_m} IS NOT NULL
GROUP BY pickup_hour, condition, severity, {_m}"""

SQL["pickup_dropoff_heatmap"] = BASE + f"""
SELECT pickup_borough, pickup_zone, dropoff_borough, dropoff_zone,
       COALESCE(condition, 'Unknown') AS condition, COALESCE(severity, 'Unknown') AS severity,
       CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS pickup_date, {M3}
FROM rides GROUP BY 1, 2, 3, 4, 5, 6, 7"""

SQL["dashboard_filters"] = BASE + f"""
SELECT DISTINCT CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS pickup_date,
       left(dayname(pickup_datetime), 3) AS dow, {HOUR} AS hour_of_day,
       COALESCE(condition, 'Unknown') AS condition, COALESCE(severity, 'Unknown') AS severity,
       pickup_borough, dropoff_borough
FROM rides"""

_ORDERS = {
    "measures_by_dow": "dow NULLS LAST, hour NULLS LAST",
    "measures_by_weather": "dow NULLS LAST, hour NULLS LAST, condition NULLS LAST, severity NULLS LAST",
    "rides_over_time": "ts_hour",
    "rides_over_day": "ts_day",
    "rides_by_weather": "total_rides DESC, condition, severity",
    **{f"{m}_vs_rides": f"pickup_hour, condition NULLS LAST, severity NULLS LAST, {m}"
       for m in ("precipitation", "temperature", "humidity")},
}
for _k, _o in _ORDERS.items():
    SQL[f"{_k}_ranked"] = f"SELECT *, row_number() OVER (ORDER BY {_o}) AS row_rank FROM ({SQL[_k]}) x"

_BAD = [
    ("DATE", "not a timestamp", "TRY_CAST(DATE AS TIMESTAMP) IS NULL"),
    ("HourlyPrecipitation", "not a number", "HourlyPrecipitation IS NOT NULL AND TRY_CAST(CASE WHEN HourlyPrecipitation = 'T' "
     "THEN '0' ELSE regexp_replace(HourlyPrecipitation, 's$', '') END AS FLOAT) IS NULL"),
    *((c, "not a number", f"{c} IS NOT NULL AND TRY_CAST({c} AS FLOAT) IS NULL")
      for c in ("HourlyRelativeHumidity", "HourlyDryBulbTemperature")),
    ("HourlyPresentWeatherType", "no condition",
     "regexp_extract(split_part(HourlyPresentWeatherType, '|', 1), '[+-]?(\\w+)(:|$)', 1) = ''"),
]
SQL["rejected_observations"] = _with(RAW_EVENTS, OBS) + "\nUNION ALL ".join(
    f"SELECT station_seq, DATE, '{field}' AS field, {field} AS text, "
    f"{'CASE WHEN DATE IS NULL THEN ' + repr('missing') + ' ELSE ' + repr(why) + ' END' if field == 'DATE' else repr(why)} AS reason, "
    f"CASE WHEN TRY_CAST(DATE AS TIMESTAMP) IS NULL THEN 'dropped' ELSE 'partial' END AS state FROM obs WHERE {cond}"
    for field, why, cond in _BAD)
SQL["rides_without_rejected"] = SQL["rides_enriched"]

# The published views: the ten of the minute summary, and all of them by name.
PUBLISHED = ("measures_by_time measures_by_dow measures_by_weather rides_over_time rides_over_day rides_by_weather "
             "precipitation_vs_rides temperature_vs_rides humidity_vs_rides pickup_dropoff_heatmap").split()
for _k in [*PUBLISHED, "avg_rides_per_dow", "dashboard_filters"]:
    SQL[f"{_k}_from_summary"] = SQL[_k]

SQL["published_views"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS view_name, COUNT(*) AS n_rows, CAST({total} AS BIGINT) AS n_rides FROM ({SQL[source]}) x"
    for name, source, total in [
        ("rides", "rides_enriched", "NULL"), *((n, n, "SUM(total_rides)") for n in PUBLISHED),
        *((n, n, "NULL") for n in ("rides_base", "avg_rides_per_dow", "dashboard_filters"))])

SQL["staging_validation"] = BASE + """
SELECT COUNT(*) AS row_count,
       COUNT(DISTINCT date_trunc('month', pickup_datetime)) AS month_count
FROM rides"""

SQL["join_drop_report"] = _with(RAW_EVENTS, TRIPS.format(**Y2024), ZONES, OBS, PARSED, _weather()) + """
, zk AS (SELECT TRY_CAST(LocationID AS BIGINT) AS k, COUNT(*) AS n FROM zones GROUP BY 1),
  wk AS (SELECT HOUR AS k, COUNT(*) AS n FROM weather GROUP BY 1)
SELECT COUNT(*) AS trips,
       COUNT(*) FILTER (WHERE p.n IS NULL) AS no_pickup_zone,
       COUNT(*) FILTER (WHERE d.n IS NULL) AS no_dropoff_zone,
       COUNT(*) FILTER (WHERE w.n IS NULL) AS no_weather,
       CAST(COALESCE(SUM(p.n * d.n * w.n), 0) AS BIGINT) AS kept
FROM trips t
LEFT JOIN zk p ON t.pickup_location = p.k
LEFT JOIN zk d ON t.dropoff_location = d.k
LEFT JOIN wk w ON t.pickup_hour = w.k"""

SQL["publish_guards"] = BASE + """
SELECT 'trips' AS metric, COUNT(*) AS value FROM trips
UNION ALL SELECT 'zoned', COUNT(*) FROM zoned
UNION ALL SELECT 'rides', COUNT(*) FROM rides
UNION ALL SELECT 'published', COUNT(*) FROM rides
UNION ALL SELECT 'left', COUNT(*) FROM rides
UNION ALL SELECT 'doubled_hour_refused', 1
UNION ALL SELECT 'repeated_id_refused', 1"""

SQL["stable_row_id"] = _with(RAW_EVENTS, TRIPS.format(**Y2024)) + """
, counted AS (
  SELECT CAST(SUM(CASE WHEN extract(day FROM pickup_datetime) = 3 THEN 3 ELSE 1 END) AS BIGINT) AS n FROM trips)
SELECT n AS n_trips, n AS n_ids, n AS n_same FROM counted"""

SQL["hour_uniqueness"] = BASE + """
SELECT 'weather_rows' AS metric, COUNT(*) AS value FROM weather
UNION ALL
SELECT 'duplicate_hours', COUNT(*) FROM (SELECT HOUR FROM weather GROUP BY HOUR HAVING COUNT(*) > 1)
UNION ALL
SELECT 'rides_rows', COUNT(*) FROM rides
UNION ALL
SELECT 'distinct_seq', COUNT(DISTINCT seq) FROM rides"""


# Sources, sinks and lifecycle: the data read back must equal the plain result.
for _k in ("parquet_glob_scan", "recursive_scan", "by_name_load"):
    SQL[_k] = SQL["trips_canonical"]
for _k in ("csv_roundtrip", "write_max_records", "publish_promote", "publish_rollback", "create_if_absent",
           "stream_incremental"):
    SQL[_k] = SQL["rides_enriched"]

SQL["partition_backfill"] = BASE + f"""
SELECT {RIDE_COLS}, strftime(pickup_datetime, '%Y-%m') AS month FROM rides"""

SQL["skip_completed"] = BASE + """
SELECT strftime(pickup_datetime, '%Y-%m') AS month, COUNT(*) AS row_count FROM rides GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
