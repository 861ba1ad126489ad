"""Column names and source-to-canonical mappings.

Fixed values: these names must equal the ones the dashboard reads.
"""

from __future__ import annotations

# Fixed values — canonical trip columns, in order, after the rename.
TRIP_COLUMNS = [
    "VendorID", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "pickup_location", "dropoff_location", "fare_amount",
    "total_amount",
]

# Fixed values — ride-hail (HVFHV) source columns for each canonical column.
# A list means "first of these that the file has" (P3); an int is a literal.
HVFHV_MAPPING = {
    "VendorID": ["h_license_num", "hvfhs_license_num"],
    "pickup_datetime": "pickup_datetime",
    "dropoff_datetime": "dropoff_datetime",
    "passenger_count": 1,
    "trip_distance": "trip_miles",
    "pickup_location": "PULocationID",
    "dropoff_location": "DOLocationID",
    "fare_amount": "base_passenger_fare",
    "total_amount": "driver_pay",
}

# Fixed values — yellow-taxi source columns.
YELLOW_MAPPING = {
    "VendorID": "VendorID",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "pickup_location": "PULocationID",
    "dropoff_location": "DOLocationID",
    "fare_amount": "fare_amount",
    "total_amount": "total_amount",
}

MAPPINGS = {"hvfhv": HVFHV_MAPPING, "yellow": YELLOW_MAPPING}

# Fixed values — zone lookup CSV columns (all text).
ZONE_COLUMNS = ["LocationID", "Borough", "Zone"]

# Fixed values — observation CSV columns the weather cleaning reads.
OBSERVATION_COLUMNS = [
    "DATE", "HourlyPrecipitation", "HourlyRelativeHumidity",
    "HourlyDryBulbTemperature", "HourlyPresentWeatherType",
]

# Fixed values — clean weather, one row per hour.
WEATHER_COLUMNS = ["HOUR", "precipitation", "humidity", "temperature", "severity", "condition"]

# Fixed values — the wide output table, 18 columns in this order.
RIDES_COLUMNS = [
    "seq", "VendorID", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "fare_amount", "total_amount", "pickup_borough",
    "pickup_zone", "dropoff_borough", "dropoff_zone", "pickup_hour",
    "precipitation", "humidity", "temperature", "severity", "condition",
]

# Fixed values — row-level dashboard base view (P9), in order.
BASE_VIEW_COLUMNS = [
    "pickup_datetime", "pickup_hour", "pickup_date", "dow", "pickup_hour_of_day",
    "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone",
    "passenger_count", "trip_distance", "fare_amount", "total_amount",
    "precipitation", "humidity", "temperature", "condition", "severity",
]

# Fixed values — placeholder for a missing weather label in the dashboard views.
UNKNOWN = "Unknown"
