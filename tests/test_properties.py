"""Properties and schemas (test strategy items 3 and 4).

Generated inputs are checked against a brute-force Python statement of the
same fixed rules; whole tables are checked for determinism; the published
table and every view have a fixed column order and type.
"""

import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from tripweave.functions import condition_of, first_code, parse_precipitation, round_half_even_int, severity_of
from tripweave.operators import measures as M
from tripweave.plans import registry as R
from tripweave.plans.rides import build_rides

SPARK_SETTINGS = settings(max_examples=20, deadline=None,
                          suppress_health_check=[HealthCheck.function_scoped_fixture])

# ASCII only, no line breaks: Java's \w and $ then mean what Python's do.
CODE_TEXT = st.one_of(st.none(), st.text(alphabet="RASNBFGZH019+-:| *", max_size=14))


def brute_code(text):
    """The fixed rules, stated directly: first ``|`` entry; ``-`` before
    ``+``; group 1 of the condition pattern, empty when nothing matches."""
    if text is None:
        return None, None
    first = text.split("|")[0]
    severity = "light" if "-" in first else "heavy" if "+" in first else "moderate"
    m = re.search(r"[+-]?(\w+)(?=:|$)", first)
    return severity, (m.group(1) if m else "")


@SPARK_SETTINGS
@given(st.lists(CODE_TEXT, min_size=1, max_size=40))
def test_weather_code_rules(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, code string")
    code = first_code("code")
    got = {r["i"]: (r["s"], r["c"]) for r in
           df.select("i", severity_of(code).alias("s"), condition_of(code).alias("c")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute_code(text), repr(text)


PRECIP_TEXT = st.one_of(
    st.none(), st.just("T"), st.just(""), st.just("*"), st.just("M"),
    st.decimals(min_value=0, max_value=20, places=2).map(str),
    st.decimals(min_value=0, max_value=20, places=2).map(lambda d: f"{d}s"),
)


def brute_precip(text):
    if text is None:
        return None
    text = "0" if text == "T" else re.sub(r"s$", "", text)
    try:
        return float(np.float32(float(text)))
    except ValueError:
        return None


@SPARK_SETTINGS
@given(st.lists(PRECIP_TEXT, min_size=1, max_size=40))
def test_precipitation_rule(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string")
    got = {r["i"]: r["v"] for r in df.select("i", parse_precipitation("p").alias("v")).collect()}
    for i, text in enumerate(texts):
        want = brute_precip(text)
        assert (got[i] is None and want is None) or got[i] == pytest.approx(want, rel=1e-6), repr(text)


@SPARK_SETTINGS
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, width=32), min_size=1, max_size=40))
def test_half_even_rounding(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v float")
    got = {r["i"]: r["r"] for r in df.select("i", round_half_even_int("v").alias("r")).collect()}
    for i, v in enumerate(values):
        assert got[i] == round(float(np.float32(v))), v


def test_rides_are_the_same_whatever_the_partitioning(spark):
    """Running twice, with inputs split differently, gives the same table."""
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    a = build_rides(raw, zones, obs, row_id="trip_id", tie_break=R.TIE_BREAK)
    b = build_rides(raw.repartition(7), zones.repartition(3), obs.repartition(5),
                    row_id="trip_id", tie_break=R.TIE_BREAK)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


M7 = [("total_rides", "bigint"), ("avg_passengers", "double"), ("avg_distance", "double"),
      ("avg_fare", "double"), ("avg_total_amount", "double"), ("sum_fare", "double"),
      ("total_revenue", "double")]
M6 = [m for m in M7 if m[0] != "sum_fare"]
M3 = [m for m in M7 if m[0] in ("total_rides", "avg_distance", "avg_total_amount")]


def _vs(measure):
    return [("pickup_hour", "timestamp_ntz"), ("condition", "string"), ("severity", "string"),
            (measure, "float"), *M3]


# Fixed values — column order and types of the published table and its views.
SCHEMAS = {
    "rides": [
        ("seq", "bigint"), ("VendorID", "string"), ("pickup_datetime", "timestamp_ntz"),
        ("dropoff_datetime", "timestamp_ntz"), ("passenger_count", "int"), ("trip_distance", "double"),
        ("fare_amount", "double"), ("total_amount", "double"), ("pickup_borough", "string"),
        ("pickup_zone", "string"), ("dropoff_borough", "string"), ("dropoff_zone", "string"),
        ("pickup_hour", "timestamp_ntz"), ("precipitation", "float"), ("humidity", "float"),
        ("temperature", "float"), ("severity", "string"), ("condition", "string"),
    ],
    "rides_base": [
        ("pickup_datetime", "timestamp_ntz"), ("pickup_hour", "timestamp_ntz"),
        ("pickup_date", "timestamp_ntz"), ("dow", "string"), ("pickup_hour_of_day", "int"),
        ("pickup_borough", "string"), ("pickup_zone", "string"), ("dropoff_borough", "string"),
        ("dropoff_zone", "string"), ("passenger_count", "int"), ("trip_distance", "double"),
        ("fare_amount", "double"), ("total_amount", "double"), ("precipitation", "float"),
        ("humidity", "float"), ("temperature", "float"), ("condition", "string"), ("severity", "string"),
    ],
    "measures_by_time": [("year", "int"), ("month", "int"), ("day", "int"), ("hour", "int"),
                         ("minute", "int"), *M7],
    "measures_by_dow": [("dow", "string"), ("hour", "int"), *M7],
    "measures_by_weather": [("dow", "string"), ("hour", "int"), ("condition", "string"),
                            ("severity", "string"), *M7],
    "rides_over_time": [("ts_hour", "timestamp_ntz"), *M6],
    "rides_over_day": [("ts_day", "timestamp_ntz"), *M6],
    "avg_rides_per_dow": [("dow", "string"), ("avg_rides_per_day", "double"),
                          ("min_rides_per_day", "bigint"), ("max_rides_per_day", "bigint")],
    "rides_by_weather": [("condition", "string"), ("severity", "string"), ("total_rides", "bigint"),
                         ("avg_distance", "double"), ("avg_fare", "double"), ("avg_total_amount", "double")],
    "precipitation_vs_rides": _vs("precipitation"),
    "temperature_vs_rides": _vs("temperature"),
    "humidity_vs_rides": _vs("humidity"),
    "pickup_dropoff_heatmap": [
        ("pickup_borough", "string"), ("pickup_zone", "string"), ("dropoff_borough", "string"),
        ("dropoff_zone", "string"), ("condition", "string"), ("severity", "string"),
        ("pickup_date", "timestamp_ntz"), *M3,
    ],
    "dashboard_filters": [
        ("pickup_date", "timestamp_ntz"), ("dow", "string"), ("hour_of_day", "int"),
        ("condition", "string"), ("severity", "string"), ("pickup_borough", "string"),
        ("dropoff_borough", "string"),
    ],
}


def _schema(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def test_schemas_of_table_and_views(spark):
    rides = R.rides(spark, SF_SMALL)
    assert _schema(rides) == SCHEMAS["rides"]
    summary = M.minute_summary(rides)
    for name, builder in M.VIEWS.items():
        assert _schema(builder(rides)) == SCHEMAS[name], name
        if name in M.SUMMARY_VIEWS:
            assert _schema(builder(summary)) == SCHEMAS[name], name
