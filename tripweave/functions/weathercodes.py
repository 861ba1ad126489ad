"""Parsing of the observation text fields.

Fixed values — must equal the reference's rules:
  * the present-weather field is a ``|``-separated list; only the first entry counts;
  * severity: NULL code -> NULL; code containing ``-`` -> ``light``; else containing
    ``+`` -> ``heavy``; else ``moderate`` (``-`` is tested first);
  * condition: group 1 of ``[+-]?(\\w+)(?=:|$)`` (empty string when nothing matches);
  * precipitation: ``T`` (trace) -> ``0``; a trailing ``s`` is removed; then a float;
  * numbers that do not parse become NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE_SEPARATOR = r"\|"
CONDITION_PATTERN = r"[+-]?(\w+)(?=:|$)"
LIGHT, HEAVY, MODERATE = "light", "heavy", "moderate"
TRACE = "T"
SUSPECT_SUFFIX = "s$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_code(c) -> Column:
    # split always yields at least one element, so index 0 is always in range.
    return F.split(_col(c), CODE_SEPARATOR).getItem(0)


def severity_of(code) -> Column:
    code = _col(code)
    return (F.when(code.isNull(), F.lit(None).cast("string"))
            .when(code.contains("-"), LIGHT)
            .when(code.contains("+"), HEAVY)
            .otherwise(MODERATE))


def condition_of(code) -> Column:
    return F.regexp_extract(_col(code), CONDITION_PATTERN, 1)


def tolerant_float(c) -> Column:
    """Text -> float; bad text (``''``, ``*``, ``M``) gives NULL instead of an
    error under ANSI mode."""
    return _col(c).try_cast("float")


def parse_precipitation(c) -> Column:
    c = _col(c)
    text = F.when(c == TRACE, F.lit("0")).otherwise(F.regexp_replace(c, SUSPECT_SUFFIX, ""))
    return tolerant_float(text)
