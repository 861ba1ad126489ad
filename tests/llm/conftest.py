import duckdb
import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "conversations", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    return c


@pytest.fixture(scope="session")
def documents(con):
    """doc_id -> text of the middle size."""
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.fixture
def texts(spark):
    """A frame of (doc_id, text) with columns whose names clash with internal ones."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "x", 1.0, 7, "y") for i, t in rows],
            "doc_id long, text string, source string, score double, n long, tokens string")
    return make
