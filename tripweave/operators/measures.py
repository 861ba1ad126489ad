"""Dashboard measures (C5: P9, A1–A12, D-1, O1–O5).

Each view function takes the wide ``rides`` table; the ten time and weather
views (A1–A10, ``SUMMARY_VIEWS``) also take its ``minute_summary``.

Those ten group by pickup time and the weather of the pickup hour only, so
they all read one summary: partial states (count, sums, non-null counts) per
pickup minute and the hour's weather.  There is one weather row per hour, so
the summary keeps one row per minute: at most 525,600 rows a year at any trip
volume.  Publishing and backfill write it once next to the table, and those
views then scan the summary, never the trips.  Given the wide table instead,
a single-grain view aggregates it in one pass, and a multi-grain view
aggregates it once at its own finest grain (map-side combine).  Every coarser
grain is then computed from the smallest finer one (``_lattice``), so no row is
ever multiplied by the number of grains.  Averages from
partial states are rebuilt as sum / non-null count, so results equal a
one-pass aggregation.

The heatmap and the dashboard filters (A11, D-1, ``PAIR_VIEWS``) group by place
pair and day.  They read a second summary, ``pair_summary``: partial states per
day, hour, place pair and weather label, at most one row per hour and pair of
zones at any trip volume.  Both summaries merge by adding states, so a run
brings its own share and earlier ones are not computed anew.

Sorting (O1–O5) is done only on the final, small result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.numeric import or_unknown
from tripweave.functions.timecols import (
    day_bucket, day_name_full, day_name_short, hour_bucket, minute_bucket, month_bucket,
)
from tripweave.operators.running import ranked
from tripweave.schemas import BASE_VIEW_COLUMNS

# Measure sets as (output name, kind, source column).
M7 = [
    ("total_rides", "count", None),
    ("avg_passengers", "avg", "passenger_count"),
    ("avg_distance", "avg", "trip_distance"),
    ("avg_fare", "avg", "fare_amount"),
    ("avg_total_amount", "avg", "total_amount"),
    ("sum_fare", "sum", "fare_amount"),
    ("total_revenue", "sum", "total_amount"),
]
M6 = [m for m in M7 if m[0] != "sum_fare"]
M3 = [m for m in M7 if m[0] in ("total_rides", "avg_distance", "avg_total_amount")]
M_WEATHER = [m for m in M7 if m[0] in ("total_rides", "avg_distance", "avg_fare", "avg_total_amount")]


def aggregates(measures) -> list[Column]:
    """Single-level aggregate expressions for a measure set."""
    out = []
    for name, kind, src in measures:
        if kind == "count":
            out.append(F.count(F.lit(1)).alias(name))
        elif kind == "avg":
            out.append(F.avg(src).alias(name))
        elif kind == "sum":
            out.append(F.sum(src).alias(name))
        else:
            raise ValueError(kind)
    return out


def _partial_states(measures) -> list[Column]:
    states, seen = [], set()
    for _, kind, src in measures:
        if kind == "count" and "_n" not in seen:
            states.append(F.count(F.lit(1)).alias("_n")); seen.add("_n")
        if kind in ("avg", "sum") and f"_s_{src}" not in seen:
            states.append(F.sum(src).alias(f"_s_{src}")); seen.add(f"_s_{src}")
        if kind == "avg" and f"_c_{src}" not in seen:
            states.append(F.count(src).alias(f"_c_{src}")); seen.add(f"_c_{src}")
    return states


def _merge_states(measures) -> list[Column]:
    out = []
    for name, kind, src in measures:
        if kind == "count":
            out.append(F.sum("_n").cast("bigint").alias(name))
        elif kind == "avg":
            out.append(F.try_divide(F.sum(f"_s_{src}").cast("double"),
                                    F.sum(f"_c_{src}")).alias(name))
        else:
            out.append(F.sum(f"_s_{src}").alias(name))
    return out


# ---------------------------------------------------------------- minute summary

SUMMARY_KEYS = ["pickup_minute", "pickup_hour", "precipitation", "humidity",
                "temperature", "severity", "condition"]


def minute_states(rides: DataFrame) -> DataFrame:
    """Partial states of M7 per pickup minute: one numeric key, so the hash
    aggregation (map-side combined, also for a hot minute) ships no texts."""
    return rides.groupBy(minute_bucket("pickup_datetime").alias("pickup_minute")).agg(*_partial_states(M7))


def hour_weather(rides: DataFrame) -> DataFrame:
    """Weather of every pickup hour.  An hour with two different weathers would
    have doubled its trips in the join (V4): reading such a row is an error."""
    hours = rides.select(*SUMMARY_KEYS[1:]).distinct()
    once = hours.groupBy("pickup_hour").agg(
        *[F.max(c).alias(c) for c in SUMMARY_KEYS[2:]], F.count(F.lit(1)).alias("_rows"))
    twice = F.concat(F.lit("more than one weather row for hour "), F.col("pickup_hour").cast("string"))
    return once.select(F.when(F.col("_rows") > 1, F.raise_error(twice).cast("timestamp_ntz"))
                       .otherwise(F.col("pickup_hour")).alias("pickup_hour"), *SUMMARY_KEYS[2:])


def minute_summary(rides: DataFrame) -> DataFrame:
    """Partial states of M7 per pickup minute, with the weather of the pickup hour
    attached afterwards: the trips are aggregated by the minute alone."""
    states = minute_states(rides).withColumn("pickup_hour", hour_bucket("pickup_minute"))
    return states.join(hour_weather(rides), "pickup_hour").select(
        "pickup_minute", *SUMMARY_KEYS[1:], *_state_columns(states))


# ---------------------------------------------------------------- pair summary

PAIR_KEYS = ["pickup_date", "hour_of_day", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone",
             "condition", "severity"]


def pair_summary(rides: DataFrame) -> DataFrame:
    """Partial states of M3 per day, hour, place pair and weather label.  Missing
    labels stay null; the views present them."""
    return rides.groupBy(
        day_bucket("pickup_datetime").alias("pickup_date"), F.hour("pickup_datetime").alias("hour_of_day"),
        *PAIR_KEYS[2:],
    ).agg(*_partial_states(M3))


def is_pair_summary(df: DataFrame) -> bool:
    return "_n" in df.columns and "hour_of_day" in df.columns


def merge_summaries(parts: DataFrame) -> DataFrame:
    """One row per key from several runs' rows of either summary (union them
    first): states of a minute or place pair add up."""
    states = _state_columns(parts)
    keys = [c for c in parts.columns if c not in states]
    return parts.groupBy(*keys).agg(*_added(states)).select(*parts.columns)


def _added(states: Sequence[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in states]


def is_summary(df: DataFrame) -> bool:
    return "_n" in df.columns and "pickup_minute" in df.columns


def _time(df: DataFrame) -> Column:
    """Pickup time: the minute of a summary, the timestamp of the wide table."""
    return F.col("pickup_minute") if is_summary(df) else F.col("pickup_datetime")


def _aggs(df: DataFrame, measures) -> list[Column]:
    """Single-level aggregates: merged partial states from a summary, plain
    aggregates (one pass) from the wide table."""
    return _merge_states(measures) if is_summary(df) else aggregates(measures)


def _rows(df: DataFrame) -> Column:
    return F.sum("_n") if is_summary(df) else F.count(F.lit(1))


def multi_grain(df: DataFrame, keys: dict[str, Column], measures, *,
                grouping_sets: Sequence[Sequence[str]] | None = None,
                rollup: bool = False, from_states: bool | None = None) -> DataFrame:
    """Aggregate ``measures`` over several grains of ``keys`` in one view.

    ``rollup=True`` gives ROLLUP over ``keys`` in order; otherwise
    ``grouping_sets`` lists the sets.  A NULL key marks "all values" as in SQL.
    The rows (trips, or rows of a summary, ``from_states``) are aggregated once
    to partial states at the finest grain, with map-side combine."""
    names = list(keys)
    from_states = is_summary(df) if from_states is None else from_states
    if from_states:
        states = _state_columns(df)
        finest = df.groupBy(*[expr.alias(k) for k, expr in keys.items()]).agg(*_added(states))
    else:
        finest = df.groupBy(*[expr.alias(k) for k, expr in keys.items()]).agg(*_partial_states(measures))
    sets = [names[:n] for n in range(len(names), -1, -1)] if rollup else [list(s) for s in grouping_sets]
    return _lattice(finest, names, sets, measures)


def _lattice(finest: DataFrame, names: Sequence[str], sets: Sequence[Sequence[str]], measures) -> DataFrame:
    """Union of the grouping sets, each aggregated from the smallest set that holds
    it, which Spark computes once (the exchange behind it is reused)."""
    states, done, out = _state_columns(finest), {frozenset(names): finest}, None
    for s in sorted(sets, key=len, reverse=True):
        if frozenset(s) not in done:
            above = min((k for k in done if k > frozenset(s)), key=len)
            done[frozenset(s)] = done[above].groupBy(*s).agg(*_added(states))
            if not s:   # the total of no rows is no row, as in ROLLUP
                done[frozenset(s)] = done[frozenset(s)].filter(F.col("_n").isNotNull())
        level = done[frozenset(s)]
        part = level.select(*[F.col(c) if c in s else F.lit(None).cast(finest.schema[c].dataType).alias(c) for c in names],
                            *_read_states(measures))
        out = part if out is None else out.unionByName(part)
    return out


def _read_states(measures) -> list[Column]:
    """Measures of rows that hold merged partial states."""
    out = []
    for name, kind, src in measures:
        if kind == "count":
            out.append(F.col("_n").cast("bigint").alias(name))
        elif kind == "avg":
            out.append(F.try_divide(F.col(f"_s_{src}").cast("double"), F.col(f"_c_{src}")).alias(name))
        else:
            out.append(F.col(f"_s_{src}").alias(name))
    return out


def _state_columns(summary: DataFrame) -> list[str]:
    return [c for c in summary.columns if c == "_n" or c.startswith("_s_") or c.startswith("_c_")]


# Orders of the views (O1-O5): columns, ``-`` for descending; the last ones decide ties.
VIEW_ORDERS = {
    "measures_by_dow": ["dow", "hour"],
    "measures_by_weather": ["dow", "hour", "condition", "severity"],
    "rides_over_time": ["ts_hour"],
    "rides_over_day": ["ts_day"],
    "rides_by_weather": ["-total_rides", "condition", "severity"],
    **{f"{m}_vs_rides": ["pickup_hour", "condition", "severity", m] for m in ("precipitation", "temperature", "humidity")},
}


def view_order(view: str) -> list[Column]:
    return [F.col(c[1:]).desc_nulls_last() if c[0] == "-" else F.col(c).asc_nulls_last() for c in VIEW_ORDERS[view]]


def _order(df: DataFrame, view: str) -> DataFrame:
    return df.orderBy(*view_order(view))


def ranked_view(view: str, rides: DataFrame) -> DataFrame:
    """A view with its order as a column, ``row_rank`` from 1: a reader that gets
    the rows through a store or a shuffle can still sort them as the view does."""
    return ranked(VIEWS[view](rides, ordered=False), view_order(view))


# ---------------------------------------------------------------- row level

def rides_base(rides: DataFrame) -> DataFrame:
    """Row-level base view for the dashboard."""
    ts = F.col("pickup_datetime")
    return rides.select(
        ts.alias("pickup_datetime"), "pickup_hour",
        day_bucket(ts).alias("pickup_date"),
        day_name_short(ts).alias("dow"),
        F.hour(ts).alias("pickup_hour_of_day"),
        "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone",
        "passenger_count", "trip_distance", "fare_amount", "total_amount",
        "precipitation", "humidity", "temperature", "condition", "severity",
    ).select(*BASE_VIEW_COLUMNS)


# ---------------------------------------------------------------- multi-grain
# Each view below takes the wide table or its minute summary.

def measures_by_time(rides: DataFrame) -> DataFrame:
    """A1: ROLLUP(year, month, day, hour, minute) with M7 — six levels."""
    ts = _time(rides)
    keys = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
            "hour": F.hour(ts), "minute": F.minute(ts)}
    return multi_grain(rides, keys, M7, rollup=True)


def measures_by_dow(rides: DataFrame, ordered: bool = True) -> DataFrame:
    """A2: GROUPING SETS ((dow, hour), (dow), (hour)), full day names; O1."""
    ts = _time(rides)
    keys = {"dow": day_name_full(ts), "hour": F.hour(ts)}
    out = multi_grain(rides, keys, M7, grouping_sets=[["dow", "hour"], ["dow"], ["hour"]])
    return _order(out, "measures_by_dow") if ordered else out


# The grouping sets of A3.
WEATHER_SETS = [
    ["condition", "severity"], ["condition", "dow"], ["condition", "severity", "dow"],
    ["condition"], ["condition", "severity", "dow", "hour"], ["condition", "dow", "hour"],
]


def measures_by_weather(rides: DataFrame, ordered: bool = True) -> DataFrame:
    """A3 + F4: six grouping sets over condition, severity, day and hour; only
    rides whose derived day, hour, condition and severity are all present.
    An empty condition (``''``) is present (D5)."""
    ts, states = _time(rides), is_summary(rides)
    values = _state_columns(rides) if states else [
        "passenger_count", "trip_distance", "fare_amount", "total_amount"]
    derived = rides.select(
        day_name_full(ts).alias("dow"), F.hour(ts).alias("hour"), "condition", "severity", *values,
    ).dropna(subset=["dow", "hour", "condition", "severity"])
    keys = {"dow": F.col("dow"), "hour": F.col("hour"),
            "condition": F.col("condition"), "severity": F.col("severity")}
    out = multi_grain(derived, keys, M7, grouping_sets=WEATHER_SETS, from_states=states)
    out = out.select("dow", "hour", "condition", "severity", *[m[0] for m in M7])
    return _order(out, "measures_by_weather") if ordered else out


# ---------------------------------------------------------------- single grain

def rides_over_time(rides: DataFrame, ordered: bool = True) -> DataFrame:
    """A4 + O3: hourly series, M6."""
    out = rides.groupBy(hour_bucket(_time(rides)).alias("ts_hour")).agg(*_aggs(rides, M6))
    return _order(out, "rides_over_time") if ordered else out


def rides_over_day(rides: DataFrame, ordered: bool = True) -> DataFrame:
    """A5 + O3: daily series, M6."""
    out = rides.groupBy(day_bucket(_time(rides)).alias("ts_day")).agg(*_aggs(rides, M6))
    return _order(out, "rides_over_day") if ordered else out


def avg_rides_per_dow(rides: DataFrame) -> DataFrame:
    """Rides per calendar day, then average / min / max of those daily
    counts per day of week.  Days without rides are absent, not zero."""
    ts = _time(rides)
    daily = rides.groupBy(day_bucket(ts).alias("pickup_date"),
                          day_name_short(ts).alias("dow")).agg(_rows(rides).alias("daily_rides"))
    return daily.groupBy("dow").agg(
        F.avg("daily_rides").alias("avg_rides_per_day"),
        F.min("daily_rides").alias("min_rides_per_day"),
        F.max("daily_rides").alias("max_rides_per_day"),
    )


def rides_by_weather(rides: DataFrame, ordered: bool = True) -> DataFrame:
    """A7 + X13 + O4: per weather label, missing labels as ``Unknown``."""
    out = rides.groupBy(or_unknown("condition").alias("condition"),
                        or_unknown("severity").alias("severity")).agg(*_aggs(rides, M_WEATHER))
    return _order(out, "rides_by_weather") if ordered else out


def measure_vs_rides(rides: DataFrame, measure: str, ordered: bool = True) -> DataFrame:
    """A8–A10 (+ F5–F7, O5): scatter table of one weather measure against rides."""
    out = (rides.filter(F.col(measure).isNotNull())
           .groupBy("pickup_hour", "condition", "severity", measure).agg(*_aggs(rides, M3)))
    return _order(out, f"{measure}_vs_rides") if ordered else out


def precipitation_vs_rides(rides: DataFrame, ordered: bool = True) -> DataFrame:
    return measure_vs_rides(rides, "precipitation", ordered)


def temperature_vs_rides(rides: DataFrame, ordered: bool = True) -> DataFrame:
    return measure_vs_rides(rides, "temperature", ordered)


def humidity_vs_rides(rides: DataFrame, ordered: bool = True) -> DataFrame:
    return measure_vs_rides(rides, "humidity", ordered)


def pickup_dropoff_heatmap(rides: DataFrame) -> DataFrame:
    """Place pair, weather labels and day, M3; from the wide table or its
    ``pair_summary``."""
    pairs = is_pair_summary(rides)
    day = F.col("pickup_date") if pairs else day_bucket("pickup_datetime")
    return rides.groupBy(
        "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone",
        or_unknown("condition").alias("condition"),
        or_unknown("severity").alias("severity"),
        day.alias("pickup_date"),
    ).agg(*(_merge_states(M3) if pairs else aggregates(M3)))


def dashboard_filters(rides: DataFrame) -> DataFrame:
    """D-1: distinct filter values for the dashboard; from the wide table or its
    ``pair_summary``."""
    ts = F.col("pickup_date") if is_pair_summary(rides) else F.col("pickup_datetime")
    hour = F.col("hour_of_day") if is_pair_summary(rides) else F.hour(ts)
    return rides.select(
        day_bucket(ts).alias("pickup_date"),
        day_name_short(ts).alias("dow"),
        hour.alias("hour_of_day"),
        or_unknown("condition").alias("condition"),
        or_unknown("severity").alias("severity"),
        "pickup_borough", "dropoff_borough",
    ).distinct()


def staging_counts(rides: DataFrame) -> DataFrame:
    """A12 (V2 + V3 in one pass): row count and number of distinct pickup
    months.  From a minute summary the same two numbers cost a scan of the
    summary only (a minute lies in one month)."""
    if is_summary(rides):
        return rides.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"),
            F.count_distinct(month_bucket("pickup_minute")).alias("month_count"),
        )
    return rides.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(month_bucket("pickup_datetime")).alias("month_count"),
    )


# Views that read the minute summary (a wide rides table works too).
SUMMARY_VIEWS = {
    "measures_by_time", "measures_by_dow", "measures_by_weather", "rides_over_time",
    "rides_over_day", "avg_rides_per_dow", "rides_by_weather", "precipitation_vs_rides",
    "temperature_vs_rides", "humidity_vs_rides",
}

# Views that read the pair summary (a wide rides table works too).
PAIR_VIEWS = {"pickup_dropoff_heatmap", "dashboard_filters"}

# Dashboard views published over the rides table (name -> builder).
VIEWS = {
    "rides_base": rides_base,
    "measures_by_time": measures_by_time,
    "measures_by_dow": measures_by_dow,
    "measures_by_weather": measures_by_weather,
    "rides_over_time": rides_over_time,
    "rides_over_day": rides_over_day,
    "avg_rides_per_dow": avg_rides_per_dow,
    "rides_by_weather": rides_by_weather,
    "precipitation_vs_rides": precipitation_vs_rides,
    "temperature_vs_rides": temperature_vs_rides,
    "humidity_vs_rides": humidity_vs_rides,
    "pickup_dropoff_heatmap": pickup_dropoff_heatmap,
    "dashboard_filters": dashboard_filters,
}
