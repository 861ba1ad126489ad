"""Hour join and the wide output (C4: J3, P8, K7) and the join-loss report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.numeric import round_half_even_int
from tripweave.operators.checks import HOUR_ROWS, RideAudit
from tripweave.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast
from tripweave.operators.zones import zone_dimension
from tripweave.schemas import RIDES_COLUMNS


def enrich(zoned_trips: DataFrame, weather: DataFrame, *,
           max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
           hours_bound: int | None = None, audit: RideAudit | None = None) -> DataFrame:
    """C4: attach the weather of the pickup hour; trips whose hour has no
    observation drop out (inner join, as the reference).

    ``hours_bound``: upper bound of weather rows known by construction (one
    row per hour of a window); saves the count that otherwise proves the
    broadcast size.  ``audit`` also counts the weather rows of each hour, on the
    weather side, and watches the joined rides."""
    if audit is not None:
        rows = weather.groupBy("HOUR").agg(F.count(F.lit(1)).alias(HOUR_ROWS))
        weather = weather.join(rows, "HOUR")
    dim, _ = bounded_broadcast(weather, max_broadcast_rows, known_bound=hours_bound)
    joined = zoned_trips.join(dim, zoned_trips["pickup_hour"] == dim["HOUR"])
    return (audit.watch(joined, "rides") if audit is not None else joined).select(*RIDES_COLUMNS)


def typed_rides(rides: DataFrame) -> DataFrame:
    """K7: temperature and humidity as int, rounded half to even, as the local
    SQL store's in-place type change does."""
    return rides.withColumns({
        "temperature": round_half_even_int("temperature"),
        "humidity": round_half_even_int("humidity"),
    })


def join_drop_report(trips: DataFrame, zones: DataFrame, weather: DataFrame, *,
                     max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One row ``trips, no_pickup_zone, no_dropoff_zone, no_weather, kept``.

    Each miss is counted on its own.  ``kept`` equals the row count of the
    inner joins, duplicates in a lookup included: each side contributes the
    number of its rows for the key.  One pass over the trips; the lookups are
    reduced to (key, multiplicity) first, so the left joins cannot multiply
    trips."""
    key_type = trips.schema["pickup_location"].dataType
    zkeys = (zone_dimension(zones, key_type).groupBy("zone_key")
             .agg(F.count(F.lit(1)).alias("n")))
    wkeys = weather.groupBy("HOUR").agg(F.count(F.lit(1)).alias("n"))
    zdim, _ = bounded_broadcast(zkeys, max_broadcast_rows)
    wdim, _ = bounded_broadcast(wkeys, max_broadcast_rows)
    p = zdim.select(F.col("zone_key").alias("_pk"), F.col("n").alias("_pn"))
    d = zdim.select(F.col("zone_key").alias("_dk"), F.col("n").alias("_dn"))
    w = wdim.select(F.col("HOUR").alias("_wk"), F.col("n").alias("_wn"))
    flagged = (trips.select("pickup_location", "dropoff_location", "pickup_hour")
               .join(p, F.col("pickup_location") == F.col("_pk"), "left")
               .join(d, F.col("dropoff_location") == F.col("_dk"), "left")
               .join(w, F.col("pickup_hour") == F.col("_wk"), "left"))
    return flagged.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("_pn").isNull()).alias("no_pickup_zone"),
        F.count_if(F.col("_dn").isNull()).alias("no_dropoff_zone"),
        F.count_if(F.col("_wn").isNull()).alias("no_weather"),
        F.coalesce(F.sum(F.col("_pn") * F.col("_dn") * F.col("_wn")), F.lit(0)).cast("bigint").alias("kept"),
    )
