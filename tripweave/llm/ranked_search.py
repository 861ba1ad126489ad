"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

The index is split by document: a shard is a bounded number of documents with
the postings of every term in them, one row per shard and term, so a term of
every document adds a bounded row to each shard and nothing is ever gathered per
term.  Weights need counts over all documents; they are sums over the shards.

``pair_lists`` stores, per shard and pair of terms, the documents that hold both
and their highest joint impact.  The pairs are neighbours of a workload of
queries: the terms of a query in ascending order of weight, each with the next.

A query runs on every shard.  Its terms are taken in the same order; the bound
of the first i terms is the least sum over ways to split them into single terms
(their highest impact) and neighbouring pairs (the highest of both and of their
joint impact), which is never above the sum of single bounds and far below it
where two terms seldom meet.  Terms whose bound stays below the k-th best score
so far need no scan: documents come from the other terms' postings, and one is
looked up in the rest only while its score and the bound left can reach the k
best, with the lower bound of the pair for documents outside its list.  A task
keeps the k best of a query over its shards; the k best of all tasks follow.
Scores are 64-bit integers, so results are exact and ties are real ties.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.llm.common import prepare, record_batch, text_slices, written
from tripweave.operators.running import running

#: A shard ends with the document that reaches one of these.
SHARD_TERMS = 1_000_000
SHARD_DOCS = 16_384
#: Queries of a block, which every task receives, and about how many terms they hold at most.
BLOCK = 500
BLOCK_TERMS = 200_000

_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
               for c in range(256))

INDEX = "shard long, term string, docs binary, counts binary, df long, ids binary"
PAIRS = "shard long, a string, b string, docs binary, joint long"


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and anything beyond ASCII, with A-Z
    lower-cased, as UTF-8 (null: none)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class _Numbers(dict):
    """A number for each new term."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def build_index(docs: DataFrame) -> DataFrame:
    """Shards of ``docs`` (doc_id, text): for each term of a shard the documents
    (uint32 places, ascending), counts (uint32) and their number, and under term
    null the documents' ids and lengths (int64; null ids as the smallest int64).
    Whole texts; documents without a term take part in nothing; every row counts
    as a document, repeated ids too; other columns are ignored."""
    prepare(docs.sparkSession)
    schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("docs", pa.binary()), ("counts", pa.binary()),
                        ("df", pa.int64()), ("ids", pa.binary())])

    def shard_rows(number: int, names: _Numbers, parts: list, ids: list, lengths: list) -> Iterator[pa.RecordBatch]:
        doc, term, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(term, kind="stable")
        doc, term, count = doc[order], term[order], count[order]
        ends = np.flatnonzero(np.append(term[1:] != term[:-1], True)) + 1
        starts = np.concatenate([[0], ends[:-1]])
        words = list(names)
        docs_bytes, count_bytes = doc.astype("<u4").tobytes(), count.astype("<u4").tobytes()
        yield record_batch({"shard": [number], "term": [None], "docs": [np.array(lengths, "<i8").tobytes()], "counts": [None],
                            "df": [len(ids)], "ids": [np.array(ids, "<i8").tobytes()]}, schema)
        for at in range(0, len(ends), 10_000):
            s, e = starts[at:at + 10_000].tolist(), ends[at:at + 10_000].tolist()
            yield record_batch({
                "shard": [number] * len(s), "term": [words[t].decode("utf-8", "surrogatepass") for t in term[s].tolist()],
                "docs": [docs_bytes[4 * x:4 * y] for x, y in zip(s, e, strict=True)],
                "counts": [count_bytes[4 * x:4 * y] for x, y in zip(s, e, strict=True)],
                "df": [y - x for x, y in zip(s, e, strict=True)], "ids": [None] * len(s)}, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        names, parts, ids, lengths, held = _Numbers(), [], [], [], 0
        for doc_ids, texts in text_slices(batches, ("doc_id",), chars=200_000):
            found = [[names[t] for t in terms(text)] for text in texts]
            sizes = np.array([len(f) for f in found])
            if not sizes.any():
                continue
            kept = np.flatnonzero(sizes)
            places = np.repeat(np.arange(len(ids), len(ids) + len(kept)), sizes[kept])
            numbers = np.fromiter((x for f in found for x in f), np.int64, int(sizes.sum()))
            key, count = np.unique(places << 32 | numbers, return_counts=True)
            parts.append((key >> 32, key & 0xFFFFFFFF, count))
            ids += [-1 << 63 if doc_ids[i] is None else int(doc_ids[i]) for i in kept]
            lengths += sizes[kept].tolist()
            held += len(numbers)
            if held >= SHARD_TERMS or len(ids) >= SHARD_DOCS:
                yield from shard_rows(base + n, names, parts, ids, lengths)
                names, parts, ids, lengths, held, n = _Numbers(), [], [], [], 0, n + 1
        if held:
            yield from shard_rows(base + n, names, parts, ids, lengths)

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .mapInArrow(run, INDEX), "search-index")


def corpus_counts(index: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""
    lengths = index.filter("term is null").select("df", "docs")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({
                "n": b.column("df"), "l": [int(np.frombuffer(x, "<i8").sum()) for x in b.column("docs").to_pylist()]})

    row = lengths.mapInArrow(run, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return row[0] or 0, row[1] or 0


def query_terms(index: DataFrame, items: DataFrame, n_docs: int) -> DataFrame:
    """(block, item_id, words): the terms of each item that the index holds, each
    once, as (weight, term) in ascending order.  An item is a row; rows of a block
    are few enough to be sent to every task.  Rows that repeat an item_id are items
    of their own, and a null item_id stays null."""
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                             "abcdefghijklmnopqrstuvwxyz"),
                                 F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    rows = written(items.select("item_id", "text").select(
        F.monotonically_increasing_id().alias("row"), "item_id", F.array_distinct(words).alias("words")), "items")
    single = rows.select("row", F.explode("words").alias("term"))
    df = (index.filter("term is not null").join(single.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = single.join(df.select("term", weight.alias("w")), "term").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("w", "term"))).alias("words"))   # the words of one item
    done = written(rows.select("row", "item_id").join(weighted, "row"), "weighted")
    # blocks of BLOCK rows and about BLOCK_TERMS terms at most
    ranked = running(done.withColumn("all", F.lit(0)), ["all"], ["row"], {
        "at": ("sum", F.lit(1).cast("long")), "upto": ("sum", F.size("words").cast("long"))})
    return ranked.select((F.floor((F.col("at") - 1) / BLOCK) + F.floor(F.col("upto") / BLOCK_TERMS)).cast("long").alias("block"),
                         "row", "item_id", "words")


def neighbours(words: DataFrame) -> DataFrame:
    """The workload's pairs (a, b, wa, wb): terms of an item next to each other by weight."""
    w = F.col("words")
    pairs = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.struct(
        F.element_at(w, i).alias("x"), F.element_at(w, i + 1).alias("y")))
    return words.filter(F.size(w) > 1).select(F.explode(pairs).alias("p")).select(
        F.col("p.x.term").alias("a"), F.col("p.y.term").alias("b"), F.col("p.x.w").alias("wa"), F.col("p.y.w").alias("wb")).distinct()


def _impacts(docs: np.ndarray, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to the score of each of its documents."""
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m[docs])


def _sizes(lengths: bytes, n_docs: int, n_terms: int) -> np.ndarray:
    return 50 + (50 * np.frombuffer(lengths, "<i8") * n_docs) // n_terms


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows (without the shard) of one shard after another; they arrive sorted by shard."""
    now, rows = None, []
    for batch in batches:
        for shard, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard != now:
                if rows:
                    yield now, rows
                now, rows = shard, []
            rows.append(row)
    if rows:
        yield now, rows


def _needed(index: DataFrame, names: DataFrame) -> DataFrame:
    """Postings of the terms ``names`` and the lengths of every shard."""
    return index.join(names, "term", "left_semi").unionByName(index.filter("term is null"))


def pair_lists(index: DataFrame, words: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """For every shard and pair of ``neighbours(words)`` that meets there: the
    documents with both terms and their highest joint impact.  Pairs that do not
    meet in a shard have no row there."""
    pairs = written(neighbours(words), "pairs")
    spark = index.sparkSession
    blocks = _blocks(pairs.withColumn("block", F.pmod(F.xxhash64("a", "b"), F.lit(pairs.count() // BLOCK_TERMS + 1))))
    schema = pa.schema([("shard", pa.int64()), ("a", pa.string()), ("b", pa.string()), ("docs", pa.binary()),
                        ("joint", pa.int64())])
    out = None
    for _, block in blocks:
        wanted = [(r["a"], r["b"], r["wa"], r["wb"]) for r in block]

        def run(batches: Iterable[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            for shard, rows in _shards(batches):
                held = {t: (np.frombuffer(d, "<u4"), np.frombuffer(c, "<u4").astype(np.int64))
                        for t, d, c, _, _ in rows if t is not None}
                m = _sizes(next(d for t, d, *_ in rows if t is None), n_docs, n_terms)
                held = {t: (d, _impacts(d, c, m)) for t, (d, c) in held.items()}
                found = []
                for a, b, wa, wb in wanted:
                    if a in held and b in held:
                        (da, ia), (db, ib) = held[a], held[b]
                        both, x, y = np.intersect1d(da, db, assume_unique=True, return_indices=True)
                        if len(both):
                            found.append((shard, a, b, both.astype("<u4").tobytes(), int((wa * ia[x] + wb * ib[y]).max())))
                if found:
                    yield record_batch(dict(zip(schema.names, zip(*found, strict=True), strict=True)), schema)

        names = spark.createDataFrame([(t,) for t in sorted({x for p in wanted for x in p[:2]})], "term string")
        part = (_needed(index, names).select("shard", "term", "docs", "counts", "df", "ids")
                .repartition("shard").sortWithinPartitions("shard").mapInArrow(run, PAIRS))
        out = part if out is None else out.unionByName(part)
    return written(out if out is not None else spark.createDataFrame([], PAIRS), "pair-lists")


def _blocks(df: DataFrame) -> Iterator[tuple[int, list]]:
    """The rows of each block, which are few by construction."""
    for b in sorted(r[0] for r in df.select("block").distinct().toLocalIterator()):
        yield b, df.filter(F.col("block") == b).collect()


class _Shard:
    """Postings, bounds and pair lists of one shard, ready to score."""

    def __init__(self, rows: list[tuple], n_docs: int, n_terms: int):
        _, _, lengths, _, ids, _ = next(r for r in rows if r[0] is None and r[1] is None)
        self.ids = np.frombuffer(ids, "<i8")
        m = _sizes(lengths, n_docs, n_terms)
        self.posts, self.pairs = {}, {}
        for a, b, docs, counts, _, joint in rows:
            d = np.frombuffer(docs, "<u4")
            if b is not None:
                self.pairs[a, b] = (d, joint)
            elif a is not None:
                g = _impacts(d, np.frombuffer(counts, "<u4").astype(np.int64), m)
                self.posts[a] = (d, g, int(g.max()))

    def search(self, words: list[tuple[int, str]], least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of every document that can reach ``least`` (above 0)."""
        held = [i for i, (w, t) in enumerate(words) if t in self.posts and w > 0]
        if not held:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # only neighbours of the whole query have a list, or none because they do not meet here
        beside = [i and held[i - 1] + 1 == held[i] for i in range(len(held))]
        words = [words[i] for i in held]
        top = [w * self.posts[t][2] for w, t in words]
        bound, joined = [0], [False]
        for i, (_, t) in enumerate(words):
            single, pair = bound[i] + top[i], None
            if beside[i]:
                joint = self.pairs.get((words[i - 1][1], t), (None, 0))[1]
                pair = bound[i - 1] + max(top[i - 1], top[i], joint)
            joined.append(pair is not None and pair < single)
            bound.append(pair if joined[-1] else single)
        skipped = max(i for i in range(len(words) + 1) if i == 0 or bound[i] < least)
        score = np.zeros(len(self.ids), np.int64)
        for w, t in words[skipped:]:
            docs, g, _ = self.posts[t]
            score[docs] += w * g
        places = np.flatnonzero(score)
        i = skipped
        while i and len(places):
            places = places[score[places] + bound[i] >= least]
            if joined[i] and len(places):
                # outside the pair's list a document holds one of the two at most
                (_, x), (_, y) = words[i - 2], words[i - 1]
                docs, _ = self.pairs.get((x, y), (np.empty(0, np.uint32), 0))
                outside = ~np.isin(places, docs, assume_unique=True)
                limit = np.where(outside, bound[i - 2] + max(top[i - 2], top[i - 1]), bound[i])
                places = places[score[places] + limit >= least]
            w, t = words[i - 1]
            docs, g, _ = self.posts[t]
            at = np.searchsorted(docs, places)
            hit = at < len(docs)
            hit[hit] = docs[at[hit]] == places[hit]
            score[places[hit]] += w * g[at[hit]]
            i -= 1
        places = places[score[places] >= max(least, 1)]
        return places, score[places]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores; ties by ascending id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search(index: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` highest-scoring documents above score 0 of each item (item_id,
    text): item_id, rank from 1, doc_id, score; equal scores by ascending doc_id (a
    null doc_id first).  Texts of any length; an empty index or item gives no row."""
    spark: SparkSession = index.sparkSession
    prepare(spark)
    n_docs, n_terms = corpus_counts(index)
    words = written(query_terms(index, items, n_docs), "queries")
    pairs = pair_lists(index, words, n_docs, n_terms)
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    out = None
    for _, block in _blocks(words):
        queries = [(r["row"], [(x["w"], x["term"]) for x in r["words"]]) for r in block]

        def run(batches: Iterable[pa.RecordBatch], queries=queries) -> Iterator[pa.RecordBatch]:
            best = {row: (np.empty(0, np.int64), np.empty(0, np.int64)) for row, _ in queries}
            for _, rows in _shards(batches):
                shard = _Shard(rows, n_docs, n_terms)
                for row, ws in queries:
                    ids, scores = best[row]
                    least = int(scores[-1]) if len(scores) == k else 1
                    places, found = shard.search(ws, least)
                    if len(places):
                        best[row] = _best(np.concatenate([ids, shard.ids[places]]), np.concatenate([scores, found]), k)
            for row, (ids, scores) in best.items():
                yield record_batch({"row": np.full(len(ids), row), "doc_id": ids, "score": scores}, schema)

        names = spark.createDataFrame([(t,) for t in sorted({t for _, ws in queries for _, t in ws})], "term string")
        postings = _needed(index, names).select("shard", F.col("term").alias("a"), F.lit(None).cast("string").alias("b"),
                                                "docs", "counts", "ids", F.lit(None).cast("long").alias("joint"))
        lists = (pairs.join(names.withColumnRenamed("term", "a"), "a", "left_semi")
                 .select("shard", "a", "b", "docs", F.lit(None).cast("binary").alias("counts"),
                         F.lit(None).cast("binary").alias("ids"), "joint"))
        part = (postings.unionByName(lists).repartition("shard").sortWithinPartitions("shard")
                .mapInArrow(run, "row long, doc_id long, score long"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # each task sends k rows a query at most
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return (ranked.join(words.select("row", "item_id"), "row")
            .select("item_id", "rank", F.nullif("doc_id", F.lit(-1 << 63)).alias("doc_id"), "score"))
