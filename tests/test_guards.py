"""Guards of a publish, lasting views, stable ids, summaries by deltas."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripweave import jobs
from tripweave.operators import measures as M
from tripweave.operators.checks import RideAudit, ValidationError, has_repeated_ids
from tripweave.operators.trips import clean_trips
from tripweave.operators.weather import clean_weather
from tripweave.plans import registry as R
from tripweave.plans import storage
from tripweave.plans.backfill import backfill, read_backfilled, vacuum_backfill
from tripweave.plans.deltas import SummaryDeltas
from tripweave.plans.publish import RidesStore
from tripweave.plans.rides import build_rides


@pytest.fixture
def database(spark, scratch):
    name = "lasting"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch('catalog')}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_lasting_views_switch_with_the_ledger_row(spark, scratch, database, monkeypatch):
    rides = spark.createDataFrame(R.rides(spark, SF_SMALL).collect(), R.rides(spark, SF_SMALL).schema)
    store, reader = RidesStore(spark, scratch("store")), spark.newSession()
    reader.conf.set("spark.sql.session.timeZone", "UTC")

    def seen():
        total = reader.table(f"{database}.rides_over_day").agg(F.sum("total_rides")).first()[0]
        pairs = reader.table(f"{database}.pickup_dropoff_heatmap").agg(F.sum("total_rides")).first()[0]
        return {total, pairs, reader.table(f"{database}.rides").count(), reader.table(f"{database}.rides_base").count()}

    n = rides.count()
    first = store.publish(rides, database=database)
    assert seen() == {n}
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.rides").collect()
    promote, between = store._promote, []

    def watched(*args):
        between.append(seen())          # everything of the next run is written, nothing switched
        promote(*args)
        between.append(seen())          # all at once, without a catalog statement

    monkeypatch.setattr(store, "_promote", watched)
    store.publish(rides.limit(9), database=database)
    assert between == [{n}, {9}] and seen() == {9}
    assert spark.sql(f"DESCRIBE TABLE EXTENDED {database}.rides").collect() == text
    store.vacuum(dt.timedelta(0), keep_runs=1)
    assert not storage.exists(spark, first.path) and seen() == {9}
    with pytest.raises(ValidationError):
        store.publish(rides.limit(0), database=database)
    assert seen() == {9}


def test_publish_refuses_a_doubled_hour_and_repeated_ids(spark, scratch):
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    store, audit = RidesStore(spark, scratch("store")), RideAudit()
    good = store.publish(build_rides(raw, zones, obs, row_id="trip_id", tie_break=R.TIE_BREAK, audit=audit), audit=audit)
    report = R.q_join_drop_report(spark, SF_SMALL).first()
    assert good.joins["trips"] == report["trips"] and good.joins["rides"] == report["kept"] == good.row_count
    with pytest.raises(ValidationError, match="repeated row ids"):
        store.publish(build_rides(raw.unionAll(raw), zones, obs, row_id="trip_id", tie_break=R.TIE_BREAK))
    weather = clean_weather(obs, tie_break=R.TIE_BREAK)
    with pytest.raises(ValidationError, match="more than one weather row"):
        build_rides(raw, zones, None, row_id="trip_id", weather=weather.unionAll(weather))
    assert store.current_run()["run_id"] == good.run_id
    root = scratch("backfill")
    with pytest.raises(ValidationError, match="repeated row ids"):
        backfill(spark, raw.unionAll(raw), zones, obs, root, ["2024-01"], row_id="trip_id", tie_break=R.TIE_BREAK)
    assert storage.list_dirs(spark, f"{root}/rides") == []


def test_minute_summary_refuses_two_weathers_of_an_hour(spark):
    rides = R.rides(spark, SF_SMALL)
    other = rides.limit(1).withColumn("severity", F.lit("other"))
    with pytest.raises(Exception, match="more than one weather row"):
        M.minute_summary(rides.unionAll(other)).collect()


@pytest.mark.parametrize("ids,repeated", [
    (range(100_000), False), ([*range(70_000), 65_536], True), ([-5, 0, 5], False), ([-5, 0, -5], True),
    ([1, 10**15, 2 * 10**15], False), ([1, 10**15, 10**15], True), ([None, None, 1], False), ([], False),
    ([-2**63, 2**63 - 1], False)])
def test_repeated_ids(spark, ids, repeated):
    df = spark.createDataFrame([(i,) for i in ids], "seq long")
    assert has_repeated_ids(df) is repeated
    assert has_repeated_ids(df.select(F.concat(F.lit("x"), "seq").alias("seq"))) is repeated


def test_stable_ids_over_runs_and_copies(spark):
    raw, _, _ = R.inputs(spark, SF_SMALL)
    hot = raw.limit(1)
    for _ in range(7):
        hot = hot.unionAll(hot)                        # one trip 128 times: more than a tenth of all
    trips = raw.unionAll(hot)
    one, two = ({r["seq"] for r in clean_trips(trips.repartition(n), stable_id=True).collect()} for n in (2, 9))
    assert one == two and len(one) == clean_trips(trips, row_id="trip_id").count()
    plain = {r["seq"] for r in clean_trips(raw, stable_id=True).collect()}
    assert plain < one and all(len(s) == 32 for s in plain)
    empty = clean_trips(raw.limit(0), stable_id=True)
    assert empty.collect() == []
    with pytest.raises(ValueError):
        clean_trips(raw, row_id="trip_id", stable_id=True)


def test_deltas_repeat_compact_and_vacuum(spark, scratch):
    rides = R.rides(spark, SF_SMALL)
    deltas = SummaryDeltas(spark, scratch("deltas"))
    with pytest.raises(FileNotFoundError):
        deltas.read()
    even = F.pmod("seq", F.lit(2)) == 0
    for part, run in ((rides.filter(even), "a"), (rides.filter(~even), "b"), (rides.filter(~even), "b")):
        deltas.append(part, run)
    rows = lambda df: sorted(map(repr, R.for_compare(df).collect()))
    assert rows(deltas.read("minutes")) == rows(M.minute_summary(rides))
    whole = rows(deltas.read("pairs"))
    assert whole == rows(M.pair_summary(rides))
    compacted = deltas.compact()
    assert deltas.runs() == [compacted] and deltas.compact() is None
    assert rows(deltas.read("pairs")) == whole
    deltas.append(rides.filter(even), "a")             # replaced, but added once all the same
    assert rows(deltas.read("pairs")) == whole
    assert len(deltas.vacuum(dt.timedelta(0))) == 2 and rows(deltas.read("pairs")) == whole
    assert M.rides_over_day(deltas.read()).agg(F.sum("total_rides")).first()[0] == rides.count()


def test_vacuum_of_a_backfill_keeps_what_the_ledger_names(spark, scratch):
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    root, args = scratch("backfill"), {"row_id": "trip_id", "tie_break": R.TIE_BREAK}
    backfill(spark, raw, zones, obs, root, ["2024-01", "2024-02"], **args)
    backfill(spark, raw, zones, obs, root, ["2024-01"], force=True, **args)
    n = read_backfilled(spark, root).count()
    assert vacuum_backfill(spark, root) == []          # too young
    assert len(vacuum_backfill(spark, root, dt.timedelta(0))) > 0
    assert read_backfilled(spark, root).count() == n
    for table in ("summary", "pairs"):
        assert read_backfilled(spark, root, table=table).agg(F.sum("_n")).first()[0] == n


def test_options_that_a_job_does_not_have_are_refused():
    with pytest.raises(SystemExit):
        jobs._parser().parse_args(["backfill", "a", "b", "c", "d", "--months", "2024-01", "--year", "2023"])


def test_recursive_stream(spark, scratch):
    raw, zones, obs = R.inputs(spark, SF_SMALL)
    folder, zpath, opath, out = scratch("in"), scratch("z"), scratch("o"), scratch("out")
    raw.write.parquet(f"{folder}/2024/01")
    R.write_csv(zones, zpath)
    R.write_csv(obs, opath)
    assert jobs.run(["stream", folder, zpath, opath, out, "--recursive", "--row-id", "trip_id"], spark) == 0
    assert spark.read.parquet(out).count() == R.rides(spark, SF_SMALL).count()
