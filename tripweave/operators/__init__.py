"""DataFrame operators: cleaning, enrichment joins, measures and checks."""

from tripweave.operators.joins import bounded_broadcast, DEFAULT_BROADCAST_ROWS
from tripweave.operators.trips import canonical_trips, clean_trips
from tripweave.operators.zones import zone_dimension, with_zones
from tripweave.operators.weather import parse_observations, first_per_hour, clean_weather
from tripweave.operators.enrich import enrich, typed_rides, join_drop_report

__all__ = [
    "bounded_broadcast", "DEFAULT_BROADCAST_ROWS", "canonical_trips", "clean_trips",
    "zone_dimension", "with_zones", "parse_observations", "first_per_hour",
    "clean_weather", "enrich", "typed_rides", "join_drop_report",
]
