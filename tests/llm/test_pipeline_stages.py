"""Each stage of the corpus pipeline on odd rows: nulls, repeated ids, clashing
columns, empty tables."""

import random

import pytest

import corpus_pipeline as P
from tripweave.llm import ngram_join
from tripweave.llm.common import written

DDL = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, component_id long"
LONG = " ".join(f"word{i} und other{i % 7}" for i in range(60))
ROWS = [(1, LONG), (1, LONG), (1, "another clean text under the id of a copy, which has words enough"), (None, LONG + " end"),
        (None, "no id but words of its own that nothing else here has said"), (None, None), (3, None), (4, ""), (4, ""),
        (5, " 12 -- 34 "), (6, "one"), (7, "one"), (8, "é ß 中 " * 500)]


@pytest.fixture
def docs(spark):
    def make(rows, lang="en"):
        return written(spark.createDataFrame([(i, t, lang, "s", len(t or ""), 0.5, 1, 2) for i, t in rows], DDL), "docs")
    return make


@pytest.fixture
def sf_dir(spark, scratch):
    path = scratch("sf")
    spark.createDataFrame([(1, 0), (3, 1), (6, 0), (None, 1)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_every_stage_takes_odd_rows_and_an_empty_table(spark, docs, sf_dir):
    for name, stage in P.STAGES:
        for rows in (ROWS, []):
            out = stage(spark, docs(rows), sf_dir)
            if name != "best_fit_packing":
                assert out.columns == list(P.COLUMNS)
            got = out.collect()
            assert (len(got) > 0) == (len(rows) > 0), name


@pytest.mark.parametrize("lang", ["en", None])
def test_language_stage_drops_letterless_texts_alone(spark, docs, sf_dir, lang):
    got = texts(P.identify_language(spark, docs(ROWS, lang), sf_dir))
    assert got == sorted(((i, t) for i, t in ROWS if any(c.isalpha() for c in t or "")), key=repr)


def test_near_duplicate_stage_decides_by_row(spark, docs, sf_dir):
    got = texts(P.join_near_duplicates(spark, docs(ROWS), sf_dir))
    kept = [t for _, t in got]
    assert sum(t in (LONG, LONG + " end") for t in kept) == 1       # copies under one id and under none
    assert kept.count("one") == 1
    assert kept.count(None) == 2 and kept.count("") == 2            # no words: linked with nothing
    for _, t in (ROWS[2], ROWS[4], ROWS[9], ROWS[12]):
        assert kept.count(t) == 1
    assert len(kept) == 10


def test_near_duplicate_stage_keeps_the_smallest_id(spark, docs, sf_dir):
    rows = [(9, LONG), (2, LONG + " end"), (5, LONG), (7, "some words that are nowhere else in here"), (-3, "x y")]
    assert [i for i, _ in texts(P.join_near_duplicates(spark, docs(rows), sf_dir))] == [-3, 2, 7]


def test_near_duplicate_stage_ships_few_texts_of_a_passage_chain(spark, docs, sf_dir, monkeypatch):
    """Texts that share a passage with the next, too little for a link, with more
    shingles than the counters tell apart; and a near copy."""
    for name, value in (("TABLE_BITS", (12, 12)), ("TILE", 2_000), ("MAX_TILES", 4)):
        monkeypatch.setattr(ngram_join, name, value)
    shipped, verify = [], ngram_join._verify
    monkeypatch.setattr(ngram_join, "_verify", lambda dealt, *rest: (shipped.append(dealt.count()), verify(dealt, *rest))[1])
    r = random.Random(12)
    some = lambda k: [f"w{r.randrange(5000)}" for _ in range(k)]
    passages = [some(50) for _ in range(201)]
    rows = [(i, " ".join(some(100) + passages[i] + some(100) + passages[i + 1] + some(100))) for i in range(200)]
    got = texts(P.join_near_duplicates(spark, docs(rows + [(300, rows[50][1] + " end")]), sf_dir))
    assert got == sorted(rows, key=repr)
    assert sum(shipped) < len(rows)


def test_pieces_of_all_rows_are_packed(spark, docs, sf_dir):
    got = P.pack_sequences(spark, docs(ROWS), sf_dir).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got) >= len(ROWS)
