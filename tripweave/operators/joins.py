"""Broadcast behind a proven size bound.

A dimension is broadcast only after counting it: the count is the proof that
what every executor receives stays small.  Beyond the bound the join is left to
the planner (shuffle sort-merge join; AQE splits skewed partitions, so a zone or
an hour holding a third of all trips does not end up in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About 50 bytes a row for zones and weather: 500k rows stays well under the
# memory an executor gives a broadcast relation.
DEFAULT_BROADCAST_ROWS = 500_000


def bounded_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, *,
                      known_bound: int | None = None) -> tuple[DataFrame, int]:
    """Return ``(dim marked for broadcast or not, row bound)``.

    ``known_bound`` is an upper bound that holds by construction (e.g. one
    weather row per hour of a fixed window); when it is small enough no count
    job is needed.  Otherwise the dimension is counted."""
    if known_bound is not None and known_bound <= max_rows:
        return F.broadcast(dim), known_bound
    n = dim.count()
    return (F.broadcast(dim) if n <= max_rows else dim), n
