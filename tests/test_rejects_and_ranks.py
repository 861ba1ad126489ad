"""Rejected observation text (X3, X6-X12) and view orders as a column."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripweave import jobs
from tripweave.operators import clean_weather
from tripweave.operators import measures as M
from tripweave.operators.running import ranked
from tripweave.operators.weather import split_observations
from tripweave.plans import registry as R
from tripweave.sources.files import write_csv

FIELDS = ("DATE string, HourlyPrecipitation string, HourlyRelativeHumidity string, "
          "HourlyDryBulbTemperature string, HourlyPresentWeatherType string")
GOOD = ("2024-01-01T00:10:00", "0.10s", "50", "30", "-RA:02")


def _row(**changed):
    return tuple(changed.get(k, v) for k, v in zip(("date", "rain", "humidity", "temperature", "code"), GOOD))


def test_every_refused_text_has_a_reason(spark, scratch):
    obs = spark.createDataFrame([
        GOOD, _row(rain="T"), _row(rain=None, humidity=None, temperature=None, code=None),
        _row(date="01/02/2024"), _row(date=None, rain="*"), _row(date=""),
        _row(rain="s"), _row(humidity="M", temperature="12 F"), _row(code="|FG:2"),
    ], FIELDS)
    accepted, rejected = split_observations(obs, scratch("obs"))
    got = sorted((r["field"], r["text"] or "-", r["reason"], r["state"]) for r in rejected.collect())
    assert got == sorted([
        ("DATE", "01/02/2024", "not a timestamp", "dropped"), ("DATE", "-", "missing", "dropped"),
        ("HourlyPrecipitation", "*", "not a number", "dropped"), ("DATE", "-", "not a timestamp", "dropped"),
        ("HourlyPrecipitation", "s", "not a number", "partial"),
        ("HourlyRelativeHumidity", "M", "not a number", "partial"),
        ("HourlyDryBulbTemperature", "12 F", "not a number", "partial"),
        ("HourlyPresentWeatherType", "|FG:2", "no condition", "partial")])
    assert accepted.count() == 6 and accepted.columns == obs.columns


def test_outputs_read_only_their_folders(spark, scratch):
    accepted, rejected = split_observations(spark.createDataFrame([GOOD, _row(date="x")], FIELDS), scratch("obs"))
    assert {f.split("state=")[1].split("/")[0] for f in accepted.inputFiles()} >= {"clean"}
    plan = rejected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [state" in plan


def test_no_observations(spark, scratch):
    accepted, rejected = split_observations(spark.createDataFrame([], FIELDS), scratch("obs"))
    assert accepted.count() == rejected.count() == 0
    assert clean_weather(accepted).count() == 0


def test_weather_is_the_same_but_for_the_hour_without_a_time(spark, scratch):
    _, _, obs = R.inputs(spark, SF_SMALL)
    accepted, rejected = split_observations(obs, scratch("obs"), keep=R.TIE_BREAK)
    want = clean_weather(obs, tie_break=R.TIE_BREAK).filter("HOUR IS NOT NULL").collect()
    assert sorted(clean_weather(accepted, tie_break=R.TIE_BREAK).collect(), key=repr) == sorted(want, key=repr)
    assert accepted.count() + rejected.filter("state = 'dropped'").select("station_seq").distinct().count() == obs.count()


def test_job_reports_and_keeps_rejects(spark, scratch, capsys):
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    trips, z, o, out, kept = (scratch(n) for n in ("trips", "zones", "obs", "out", "rejects"))
    raw.write.parquet(trips)
    write_csv(zones, z)
    write_csv(obs, o)
    assert jobs.run(["build", trips, z, o, out, "--row-id", "trip_id", "--rejects", kept], spark) == 0
    lost = raw.filter(F.hour("pickup_datetime") == 5).count()
    assert f"refused DATE: not a timestamp, row dropped: {lost}" in capsys.readouterr().out
    assert spark.read.parquet(kept).filter("state = 'dropped'").count() == lost


@pytest.mark.parametrize("view", sorted(M.VIEW_ORDERS))
def test_rank_is_the_order_the_view_has(spark, scratch, view):
    rides = scratch("rides")
    R.rides(spark, SF_SMALL).write.parquet(rides)
    rides = spark.read.parquet(rides)
    key = [c.lstrip("-") for c in M.VIEW_ORDERS[view]]
    shown = [tuple(r) for r in M.VIEWS[view](rides).select(*key).collect()]
    rows = M.ranked_view(view, rides).select("row_rank", *key).collect()
    assert [tuple(r)[1:] for r in sorted(rows)] == shown
    assert sorted(r["row_rank"] for r in rows) == list(range(1, len(shown) + 1))


def test_rank_with_a_hot_value_and_over_no_rows(spark):
    df = spark.range(5000).select((F.col("id") % 3 * 0).alias("k"), "id").repartition(7)
    rows = ranked(df, [F.col("k").asc(), F.col("id").desc()]).collect()
    assert {(r["id"], r["row_rank"]) for r in rows} == {(i, 5000 - i) for i in range(5000)}
    assert ranked(df.limit(0), [F.col("id").asc()]).collect() == []
