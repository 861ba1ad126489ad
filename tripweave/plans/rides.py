"""The enrichment plan (C1 -> C2 -> C3 -> C4) as one lazy DataFrame.

Physical shape: one scan of the trips with the year range pushed into it,
two broadcast hash joins against the zone lookup and one against the hourly
weather (each broadcast only after its row count is checked), no shuffle of
the trips at all.  The only shuffle is the small one that keeps one
observation per hour.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import datetime as dt

from pyspark.sql import Column, DataFrame

from tripweave.functions.timecols import year_window
from tripweave.operators.checks import RideAudit, assert_one_per_hour
from tripweave.operators.enrich import enrich
from tripweave.operators.joins import DEFAULT_BROADCAST_ROWS
from tripweave.operators.trips import clean_trips
from tripweave.operators.weather import clean_weather
from tripweave.operators.zones import with_zones


def build_rides(raw_trips: DataFrame, zones: DataFrame, observations: DataFrame | None, *,
                mapping: str | dict = "hvfhv", year: int | None = 2024,
                trip_window: tuple | None = None, weather_window: tuple | None = None,
                row_id: str | Column | None = None, tie_break: Sequence[str] = (),
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                weather: DataFrame | None = None,
                keep: Callable[[DataFrame], Column] | None = None,
                blank_condition_as_null: bool = False, stable_id: bool = False,
                audit: RideAudit | None = None) -> DataFrame:
    """``weather``: already cleaned weather (``clean_weather`` output, one row
    per hour) to use instead of cleaning ``observations`` here, e.g. a copy
    written once for many stream batches; an hour with two rows is an error.
    ``keep``, ``stable_id``: see ``clean_trips``.  ``audit`` watches what each join
    loses while the result is written."""
    if trip_window is None and year is not None:
        trip_window = (f"{year}-01-01 00:00:00", f"{year + 1}-01-01 00:00:00")
    trips = clean_trips(raw_trips, mapping, year=None, window=trip_window, row_id=row_id, keep=keep,
                        stable_id=stable_id)
    if audit is not None:
        trips = audit.watch(trips, "trips")
    zoned = with_zones(trips, zones, max_broadcast_rows=max_broadcast_rows)
    if audit is not None:
        zoned = audit.watch(zoned, "zoned")
    if weather is None:
        weather = clean_weather(observations, window=weather_window, tie_break=tie_break,
                                blank_condition_as_null=blank_condition_as_null)
    else:
        assert_one_per_hour(weather)
    if weather_window is not None:
        weather = weather.filter(year_window(weather, ["HOUR"], *weather_window))
    hours_bound = None
    if trip_window is not None:
        # Only hours inside the trips' window can match; one weather row per
        # hour makes the window's hour count a proven bound for the broadcast.
        lo, hi = _hour_floor(trip_window[0]), _parse(trip_window[1])
        weather = weather.filter(year_window(weather, ["HOUR"], lo, hi))
        hours_bound = int((hi - lo).total_seconds() // 3600) + 1
    return enrich(zoned, weather, max_broadcast_rows=max_broadcast_rows, hours_bound=hours_bound, audit=audit)


def _parse(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


def _hour_floor(value) -> dt.datetime:
    return _parse(value).replace(minute=0, second=0, microsecond=0)
