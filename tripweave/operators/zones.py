"""Zone enrichment (C2: J1, J2, P7).

The same lookup plays two roles, pickup and drop-off.  Its text key is cast
once, tolerantly, to the trips' key type: the join compares like with like and
a malformed key drops out instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast

# Column order of the trip table after the zone joins.
ZONED_COLUMNS = [
    "seq", "VendorID", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "pickup_location", "dropoff_location", "fare_amount",
    "total_amount", "pickup_hour", "pickup_borough", "pickup_zone",
    "dropoff_borough", "dropoff_zone",
]


def zone_dimension(zones: DataFrame, key_type="bigint") -> DataFrame:
    return zones.select(
        F.col("LocationID").try_cast(key_type).alias("zone_key"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
    )


def _role(dim: DataFrame, role: str) -> DataFrame:
    return dim.select(
        F.col("zone_key").alias(f"{role}_zone_key"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone").alias(f"{role}_zone"),
    )


def with_zones(trips: DataFrame, zones: DataFrame, *,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Inner-join the zone lookup twice; trips with an unknown zone drop out
    (see ``join_drop_report`` for how many)."""
    key_type = trips.schema["pickup_location"].dataType
    dim, _ = bounded_broadcast(zone_dimension(zones, key_type), max_broadcast_rows)
    pickup, dropoff = _role(dim, "pickup"), _role(dim, "dropoff")
    joined = (
        trips
        .join(pickup, trips["pickup_location"] == pickup["pickup_zone_key"])
        .join(dropoff, trips["dropoff_location"] == dropoff["dropoff_zone_key"])
    )
    return joined.select(*ZONED_COLUMNS)
