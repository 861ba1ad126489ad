"""Time buckets and calendar parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bucket(unit: str, c) -> Column:
    # date_trunc returns a session-zone timestamp even for timestamp_ntz input;
    # the session zone is UTC, so the cast back is exact.
    return F.date_trunc(unit, _col(c)).cast("timestamp_ntz")


def minute_bucket(c) -> Column:
    return _bucket("minute", c)


def hour_bucket(c) -> Column:
    return _bucket("hour", c)


def day_bucket(c) -> Column:
    return _bucket("day", c)


def month_bucket(c) -> Column:
    return _bucket("month", c)


def day_name_full(c) -> Column:
    """``Monday`` … ``Sunday`` (the local SQL store's DAYNAME)."""
    return F.date_format(_col(c), "EEEE")


def day_name_short(c) -> Column:
    """``Mon`` … ``Sun`` (the warehouse's DAYNAME)."""
    return F.dayname(_col(c))


def ts_literal(value, data_type) -> Column:
    """A timestamp literal of the same type as the column it is compared with,
    so the comparison needs no cast on the column and reaches the Parquet scan."""
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    type_name = "timestamp_ntz" if isinstance(data_type, TimestampNTZType) else "timestamp"
    return F.lit(str(value)).cast(type_name)


def year_window(df: DataFrame, columns: list[str], lo, hi) -> Column:
    """``lo <= c < hi`` for every column: a half-open range, pushed to Parquet
    (``year(c) = k`` would only push ``IsNotNull``)."""
    cond = None
    for name in columns:
        dtype = df.schema[name].dataType
        part = (F.col(name) >= ts_literal(lo, dtype)) & (F.col(name) < ts_literal(hi, dtype))
        cond = part if cond is None else cond & part
    return cond
