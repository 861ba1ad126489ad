"""Numeric and label helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.schemas import UNKNOWN


def round_half_even_int(c) -> Column:
    """Float -> int rounding half to even (2.5 -> 2, 3.5 -> 4, 2.6 -> 3), as an
    in-place type change does in the SQL store; a plain cast would truncate."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c).cast("int")


def or_unknown(c) -> Column:
    """``COALESCE(c, 'Unknown')``; an empty string stays empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(UNKNOWN))
