"""Unit cases for the scalar rules (weather codes, precipitation, rounding,
day names)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripweave.functions import (
    condition_of, day_name_full, day_name_short, first_code, parse_precipitation,
    round_half_even_int, severity_of,
)

# (present-weather text, severity, condition); None is NULL.
CODE_CASES = [
    ("-RA:02 BR:1", "light", "RA"),
    ("RA:02", "moderate", "RA"),
    ("+RA", "heavy", "RA"),
    ("", "moderate", ""),
    ("|RA:61", "moderate", ""),
    ("-RA:02 BR:1 |RA |", "light", "RA"),
    ("VCTS:7", "moderate", "VCTS"),
    ("*:9", "moderate", "9"),
    ("+SN -RA", "light", "RA"),
    ("RA BR", "moderate", "BR"),
    (None, None, None),
    ("-SN:03 |FG:2", "light", "SN"),
    ("BR:1 ||", "moderate", "BR"),
    ("HZ:7 |FU |HZ", "moderate", "HZ"),
    ("+FG", "heavy", "FG"),
    (" RA:02", "moderate", "RA"),
    (" RA ", "moderate", ""),
]


def test_weather_codes(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(CODE_CASES)], "i int, code string")
    code = first_code("code")
    out = {r["i"]: (r["severity"], r["condition"]) for r in
           df.select("i", severity_of(code).alias("severity"), condition_of(code).alias("condition")).collect()}
    for i, (text, sev, cond) in enumerate(CODE_CASES):
        assert out[i] == (sev, cond), text


@pytest.mark.parametrize("text,value", [
    ("T", 0.0), ("0.05s", 0.05), ("0.10", 0.1), ("", None), ("*", None), ("M", None), (None, None),
])
def test_precipitation(spark, text, value):
    got = spark.createDataFrame([(text,)], "p string").select(parse_precipitation("p").alias("v")).first()["v"]
    if value is None:
        assert got is None
    else:
        assert got == pytest.approx(value, rel=1e-6)


def test_round_half_even(spark):
    vals = [2.5, 3.5, 2.6, -2.5, -3.5, 0.5, 1.49]
    want = [2, 4, 3, -2, -4, 0, 1]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v float")
    got = [r["r"] for r in df.orderBy("i").select(round_half_even_int("v").alias("r")).collect()]
    assert got == want


def test_day_names(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 0),)], "ts timestamp_ntz")
    r = df.select(day_name_full("ts").alias("f"), day_name_short("ts").alias("s")).first()
    assert (r["f"], r["s"]) == ("Monday", "Mon")
