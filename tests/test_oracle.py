"""Differential test: every driver query against its DuckDB SQL (sf0.001),
row count, column names and values (order-insensitive)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tripweave.plans import oracle, registry

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), ocols)


def test_every_query_has_a_check(spark):
    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_rides" in df.columns
