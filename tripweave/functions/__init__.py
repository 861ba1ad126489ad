"""Column-expression helpers.  All are built-in Spark functions, so they stay
inside whole-stage code generation; none is a Python UDF."""

from tripweave.functions.timecols import (
    hour_bucket, day_bucket, month_bucket, day_name_full, day_name_short,
    ts_literal, year_window,
)
from tripweave.functions.weathercodes import (
    first_code, severity_of, condition_of, parse_precipitation, tolerant_float,
)
from tripweave.functions.numeric import round_half_even_int, or_unknown

__all__ = [
    "hour_bucket", "day_bucket", "month_bucket", "day_name_full", "day_name_short",
    "ts_literal", "year_window", "first_code", "severity_of", "condition_of",
    "parse_precipitation", "tolerant_float", "round_half_even_int", "or_unknown",
]
