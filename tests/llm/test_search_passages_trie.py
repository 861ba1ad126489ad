"""Ranked search, repeated passages and the prefix trie against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_MID

from tripweave.llm import passage_dedup, prefix_trie, queries as Q, ranked_search
from tripweave.llm.induced_sort import common_prefixes, suffix_array
from tripweave.operators import running

# ------------------------------------------------------------------ helpers


def test_running_sums_split_a_hot_key(spark):
    rows = [("hot", i % 7, i) for i in range(3000)] + [("x", None, 5), ("x", 2, 6), (None, 1, 7)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(7)
    from pyspark.sql import functions as F

    out = running.running(df, ["k"], ["o"], {"s": ("sum", F.lit(1).cast("long")), "x": ("xor", F.col("v"))}).collect()
    assert sorted(r["s"] for r in out if r["k"] == "hot") == list(range(1, 3001))
    last = max((r for r in out if r["k"] == "hot"), key=lambda r: r["s"])
    assert last["x"] == int(np.bitwise_xor.reduce(np.arange(3000)))
    assert {(r["o"], r["s"]) for r in out if r["k"] == "x"} == {(None, 1), (2, 2)}


# ------------------------------------------------------------------ ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k=50):
    found = [(i, Counter(words_of(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(words_of(text)) if t in c)
            if s > 0:
                scores.append((-s, -(1 << 63) if i is None else i))
        out += [(item, r, None if i == -(1 << 63) else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("shard_docs", [16_384, 25])
def test_search_equals_brute_force(spark, monkeypatch, shard_docs):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", shard_docs)
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ñandú", "ABC", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 40)))) for i in range(400)]
    docs += [(3, docs[3][1]), (None, "abc, w50 w51"), (500, None), (501, ""), (502, "--- \x00!"), (503, "w1 " * 30_000)]
    items = [(j, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 12)))) for j in range(30)]
    items += [(30, None), (31, ""), (32, "nowhere"), (None, "w50 ABC"), (1, "w3"), (1, "w3")]
    index = ranked_search.build_index(spark.createDataFrame(
        [(i, t, "s", 1.0) for i, t in docs], "doc_id long, text string, shard string, score double").repartition(2))
    got = ranked_search.search(index, spark.createDataFrame(
        [(i, t, 0) for i, t in items], "item_id long, text string, rank int"), k=10).collect()
    assert order(got) == order(ranked(docs, items, 10))


def test_search_skips_by_pairs(spark):
    """Two terms that never meet: neither needs a scan, though their single bounds add up above the best."""
    index = ranked_search.build_index(spark.createDataFrame(
        [(i, "apple apple") for i in range(40)] + [(100 + i, "pear pear") for i in range(40)]
        + [(200 + i, "rare rare rare") for i in range(12)], "doc_id long, text string").coalesce(1))
    n, t = ranked_search.corpus_counts(index)
    words = ranked_search.query_terms(index, spark.createDataFrame([(1, "apple pear rare")], "item_id long, text string"), n)
    pairs = ranked_search.pair_lists(index, words, n, t).collect()
    assert pairs == []     # no neighbours meet
    rows = [(r["term"], None, r["docs"], r["counts"], r["ids"], None) for r in index.collect()]
    shard = ranked_search._Shard(rows, n, t)
    ws = [(x["w"], x["term"]) for x in words.first()["words"]]
    top = {w: w * shard.posts[w_t][2] for w, w_t in ws}
    least = max(top.values())
    assert sum(sorted(top.values())[:2]) > least * 0.5
    places, scores = shard.search(ws, least)
    assert set(shard.ids[places]) == set(range(200, 212)) and set(scores) == {least}


def test_search_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(ranked_search.build_index(none), some).collect() == []
    index = ranked_search.build_index(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert ranked_search.search(index, some.filter("false")).collect() == []


def test_op11_equals_its_sql(spark, con):
    con.execute(f"CREATE OR REPLACE VIEW benchmark AS SELECT * FROM read_parquet('{SF_MID}/benchmark.parquet')")
    res = con.execute(Q.OP11)
    columns = [d[0] for d in res.description]
    want = sorted(tuple(r) for r in res.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in Q.op11_ranked_search(spark, SF_MID).collect()) == want


# ------------------------------------------------------------------ suffix arrays


def symbols(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 200))
    if seed % 3 == 0:       # periodic
        s = np.tile(rng.integers(1, 4, int(rng.integers(1, 5))), 200)[:n]
    else:
        s = rng.integers(1, int(rng.integers(2, 40)), n)
    return np.append(s, 0).astype(np.uint16)


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array_and_common_prefixes(seed):
    t = symbols(seed)
    b = t.astype(">u2").tobytes()
    want = sorted(range(len(t)), key=lambda i: b[2 * i:])
    sa = suffix_array(t)
    assert sa.tolist() == want
    before, length = common_prefixes(t, sa)
    for x, y in zip(want, want[1:]):
        k = 0
        while x + k < len(t) and y + k < len(t) and t[x + k] == t[y + k]:
            k += 1
        assert (before[y], length[y]) == (x, k)


def without_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    met = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if met[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((bytes(x for x, g in zip(b, gone) if not g),
                    sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))))
    return out


@pytest.mark.parametrize("length,group_bytes", [(16, 1_000_000), (16, 300), (5, 200), (1, 50), (40, 2000)])
def test_repeats_equal_brute_force(spark, monkeypatch, length, group_bytes):
    """Small group bounds force every narrowing of hot k-grams."""
    monkeypatch.setattr(passage_dedup, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(passage_dedup, "SHARD_BYTES", 2 * group_bytes)
    monkeypatch.setattr(passage_dedup, "SCAN_BYTES", 700)
    rnd = random.Random(length)
    vocabulary = ["".join(rnd.choice("abé") for _ in range(rnd.randint(1, 5))) for _ in range(30)]
    shared = [" ".join(rnd.choices(vocabulary, k=40)) for _ in range(4)]
    texts = [None, "", "é" * 900, shared[0], shared[0]]
    for _ in range(120):
        parts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30)))]
        if rnd.random() < .5:
            s = rnd.choice(shared)
            a = rnd.randint(0, len(s) - 1)
            parts.append(s[a:a + rnd.randint(1, 120)] + "\x00x" * rnd.randint(0, 1))
        if rnd.random() < .2:
            parts.append("xyz" * rnd.randint(1, 30))
        parts.append(" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30))))
        rnd.shuffle(parts)
        texts.append("".join(parts))
    rows = [(None if i == 7 else i // 2, t, i, [1], "y") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, spans array<long>, start string").repartition(3)
    got = passage_dedup.remove_repeats(df, length)
    assert got.columns == ["doc_id", "text", "row", "start", "kept", "spans"]
    got = sorted(got.collect(), key=lambda r: r["row"])
    assert [(bytes(r["kept"]), len(r["spans"])) for r in got] == without_repeats(texts, length)
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]


def test_repeats_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert passage_dedup.remove_repeats(none).collect() == []


def test_op12_equals_brute_force(spark, documents):
    import xxhash

    met = Counter(xxhash.xxh3_64_intdigest(b[i:i + 400]) for b in map(str.encode, documents.values())
                  for i in range(len(b) - 399))
    want = {}
    for i, text in documents.items():
        b = text.encode()
        change = np.zeros(len(b) + 1, np.int64)
        for j in range(len(b) - 399):
            if met[xxhash.xxh3_64_intdigest(b[j:j + 400])] > 1:
                change[j] += 1
                change[j + 400] -= 1
        gone = np.cumsum(change)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in Q.op12_suffix_dedup(spark, SF_MID).collect()}
    assert got == want


# ------------------------------------------------------------------ prefix trie


def nodes_of(rows):
    turns = defaultdict(list)
    for c, at, role, text in rows:
        if c is not None:
            turns[c].append(((0, 0) if at is None else (1, at), role or "", text or ""))
    turns = {c: [(r, t) for _, r, t in sorted(x)] for c, x in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    members, children = defaultdict(list), Counter()
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    below = defaultdict(lambda: [0, 0])
    for p in sorted(members, key=len, reverse=True):
        below[p][0] += not children[p]
        below[p][1] += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        if p:
            below[p[:-1]][0] += below[p][0]
            below[p[:-1]][1] += below[p][1]
    return [(m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], *below[p],
             hashlib.sha256(",".join(str(c) for c in m if len(paths[c]) == len(p)).encode()).hexdigest())
            for p, m in members.items()]


@pytest.mark.parametrize("width", [1, 3, 8])
def test_trie_equals_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    rnd = random.Random(width)
    rows = []
    for c in [*range(-12, 60), 10**12]:
        kind = rnd.random()
        n = 40 if kind < .1 else rnd.randint(1, 12)
        for i in range(n):
            rows.append((c, None if i == 0 and kind < .3 else i * 3, "user" if i % 2 else None,
                         None if rnd.random() < .05 else f"é{rnd.randint(0, 2 if i < 4 else 9)}"))
    rows += [(c, i, "user", "same") for c in range(1000, 1030) for i in range(9)]      # copies: a long list of ends
    rows += [(None, 1, "user", "nobody"), (7, 3, "user", "again"), (7, 3, "user", "again"), (2000, 0, "a", "x" * 200_000)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows],
                               "conv_id long, turn long, role string, text string, pos int, block string").repartition(5)
    # rows that tie are equal here but for (7, 3): its place among them is by digest
    rows = [(c, t, r, x) if (c, t) != (7, 3) else (c, t, "user", "again") for c, t, r, x in rows]
    df = df.filter("not (conv_id <=> 7 and turn <=> 3)").unionByName(spark.createDataFrame(
        [(*r, 1, "k") for r in rows if (r[0], r[1]) == (7, 3)],
        "conv_id long, turn long, role string, text string, pos int, block string"))
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.positions(df)), width).collect()
    assert order(got) == order(nodes_of(rows))


def test_trie_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.positions(none))).collect() == []


def test_op13_equals_brute_force_and_its_sql(spark, con):
    got = Q.op13_prefix_trie(spark, SF_MID)
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert order(got.collect()) == order(nodes_of(rows))
    res = con.execute(Q.OP13)
    columns = [d[0] for d in res.description]
    assert order(res.fetchall()) == order(got.select(*columns).collect())
