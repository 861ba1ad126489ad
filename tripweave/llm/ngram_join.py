"""N-gram Jaccard join (operator 5): rare-first prefix filtering.

A document is its set of distinct word shingles.  Shingles are ordered from rare
to frequent by the frequencies of their words, and behind all others come those
whose own count stands out (tables of hashed counters, summed from all tasks, of
a fixed size: in a large corpus they tell only frequent shingles apart, and words
are what keeps shingles that meet by chance out of the prefixes).  Two sets that reach the threshold share one of
the first ``n - ceil(t n) + 1`` shingles of each, so only these prefixes are
shuffled: documents meet on a prefix shingle.  Sorted by size within a shingle,
documents are parted where the next one is too long for the one before (length
filter).  Prefixes are longer by ``n // EXTRA``: the first ``k`` shingles that two
linked sets share lie in prefixes longer by ``k - 1``, so a document that meets
others on fewer shingles than its smallest partner would force is out, as one
is that shares a chance shingle.  The rest form families.  Those of more than a
tile fall apart: pairs that share too few prefix shingles for their two sizes are
not linked, so a family holds together by what links may hold (a shingle of more
than ``PAIRED`` documents keeps them together, without pairs).

Each family is verified in cells.  A cell joins the documents of two tiles of a
family (small families: one cell) by their prefixes, with the length, positional
and suffix filters, and each pair that is left is verified once by its exact
overlap.  A cell reports the links that hold its components together, or all of
them on request.  Hot families are thereby spread over many tasks, and no pair
is emitted before it is verified.  A family of more than ``PIVOT_TILES`` tiles is
first compared with one of its tiles.  Documents which those links join into one
component are not compared with each other again (unless all links are asked
for), so a large group of near copies costs two cells a document.  What is left of
a family of more than ``MAX_TILES`` tiles is joined shingle by shingle, so that
chains of unrelated documents which happen to share rare shingles cost in
proportion to what they share.

Exact copies send one prefix per task.  Shingles are compared by 64-bit hashes.

Rows: texts without words (null, empty, white space) have an empty set and link
with nothing; texts shorter than a shingle are one shingle; null doc_ids are
returned unlinked; repeated doc_ids are one document whose texts all count;
extra columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import discard, prepare, record_batch, released, text_slices, written
from tripweave.llm.components import components

#: Counters: one for about 16 shingles, at most 2 ** 24 (16 MB when sent).
TABLE_BITS = (16, 24)
#: Counters of words: 2 ** 20.
WORD_BITS = 20
BLOCK = 4096
FILTER_BITS = 22
#: Shingles of a tile, and tiles of a family that is joined as a whole.
TILE = 20_000
MAX_TILES = 64
#: Families of more tiles are first compared with one of their tiles.
PIVOT_TILES = 4
#: Documents of a shingle that are compared in pairs.
PAIRED = 64
#: Prefixes are longer by one shingle for so many shingles of a set.
EXTRA = 50


class WordHash(dict):
    """64-bit hash of each word; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        self[word] = got = xxhash.xxh3_64_intdigest(word)
        return got


_WORDS = WordHash()


def _released(run: Callable) -> Callable:
    """``run`` with this module's word cache emptied when its task ends; looked up
    there, so the cache is never part of the function that Spark ships."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from released(run, _WORDS)(batches)

    return task


_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words in turn.  ``bytes.lower`` changes A-Z only, and
    ``bytes.split`` parts at space and the ASCII controls 9 to 13."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def _windows(h: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the shingles of words ``h`` in turn."""
    width = min(width, len(h))
    out = np.full(len(h) - width + 1 if width else 0, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k:len(h) - width + 1 + k]) * _MIX
        out ^= out >> np.uint64(31)
    return out


def _distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values: a sort is quicker here than np.unique's hash table."""
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    return _distinct(_windows(word_hashes(text), width))


def slot(hashes: np.ndarray, size: int) -> np.ndarray:
    """Counter of each hash, in a table of ``size``, a power of two."""
    return (hashes >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _summed(rows: DataFrame, counters: Callable[[pa.RecordBatch], Iterable[np.ndarray]], size: int,
            finish: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``size`` counters, bumped by every task at the places ``counters`` gives
    for its batches, summed block by block and reduced to a byte each.  Memory
    is bounded by the table in every task, and on the driver by ``size`` bytes."""
    schema = pa.schema([("block", pa.int32()), ("digit", pa.int32()), ("counts", pa.binary())])
    reduced = pa.schema([("block", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for batch in batches:
            for places in counters(batch):
                at, n = np.unique(places, return_counts=True)
                total[at] += n.astype(np.uint32)
        blocks = total.reshape(-1, BLOCK)
        for digit in range(4):   # a byte a counter at a time, from the lowest
            part = blocks.view(np.uint8).reshape(-1, BLOCK, 4)[:, :, digit if sys.byteorder == "little" else 3 - digit]
            met = np.flatnonzero(part.any(axis=1))
            # mostly zeros and ones: a quarter of a byte a counter
            yield record_batch({"block": met, "digit": np.full(len(met), digit),
                                "counts": [zlib.compress(part[m].tobytes(), 1) for m in met]}, schema)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, digit, counts in zip(batch.column("block").to_pylist(), batch.column("digit").to_pylist(),
                                            batch.column("counts"), strict=True):
                total = totals.setdefault(block, np.zeros(BLOCK, np.int64))
                total += np.frombuffer(zlib.decompress(counts.as_buffer()), np.uint8).astype(np.int64) << (8 * digit)
        for block, total in totals.items():
            yield record_batch({"block": [block], "counts": [finish(total).astype(np.uint8).tobytes()]}, reduced)

    out = np.zeros((size // BLOCK, BLOCK), np.uint8)
    counted = rows.mapInArrow(count, "block int, digit int, counts binary").repartition("block")
    for r in counted.mapInArrow(add, "block int, counts binary").collect():
        out[r["block"]] = np.frombuffer(r["counts"], np.uint8)
    return out.ravel()


def rarity(docs: DataFrame, width: int) -> np.ndarray:
    """A byte for each counter of shingles, then for each of words: about 8 log2 of
    how many documents hold a shingle that falls there, or of how often its words
    are there.  The number of shingle counters follows the characters of the corpus
    (six to a word) within ``TABLE_BITS``; where many shingles share a counter, most
    counts are chance, and those no higher than chance makes them become 0."""
    texts = docs.select("text").filter("text is not null")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 1
    size = 1 << min(max(round(np.log2(chars / 6 / 16)), TABLE_BITS[0]), TABLE_BITS[1])
    words = 1 << WORD_BITS

    def places(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for texts, in text_slices([batch], ()):
            hashes = [word_hashes(t) for t in texts]
            yield slot(np.concatenate([_distinct(_windows(h, width)) for h in hashes]), size)
            yield slot(np.concatenate(hashes), words) + size

    def level(total: np.ndarray) -> np.ndarray:
        return np.where(total > 0, np.minimum(255, 1 + 8 * np.log2(np.maximum(total, 1))), 0)

    out = _summed(texts, places, size + words, level)
    usual = 2 ** ((np.median(out[:size]) - 1) / 8)
    out[:size][out[:size] <= level(np.array(max(1, usual + 3 * usual ** 0.5))).astype(np.uint8)] = 0
    return out


def _id_place(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.int64).view(np.uint64) * _MIX
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def maybe_in(ids: DataFrame) -> Column:
    """A filter on doc_id, of fixed size, that holds for every doc_id in ``ids``
    and few others: a join with ``ids`` then need not shuffle all texts.  Only
    doc_ids go through Python."""
    found = _summed(ids.select("doc_id"), lambda b: [_id_place(np.asarray(b.column("doc_id")))], 1 << FILTER_BITS,
                    lambda total: total > 0)
    sent = ids.sparkSession.sparkContext.broadcast(np.packbits(found))   # 2 ** FILTER_BITS bits

    def maybe(doc_id: pd.Series) -> pd.Series:
        at = _id_place(doc_id.to_numpy())
        return pd.Series((sent.value[at >> 3] >> (7 - (at & 7))) & 1 == 1)

    return F.pandas_udf(maybe, "boolean")(F.coalesce(F.col("doc_id"), F.lit(0)))


def prefix_length(n: int, pct: int) -> int:
    return n - -(-n * pct // 100) + 1


def must_meet(n: Column, pct: int) -> Column:
    """Shared shingles that a set of ``n`` has in its longer prefix if it has a
    link: a partner has at least ``ceil(t n)`` shingles, and so has the overlap."""
    return 1 + F.floor(F.ceil(n * pct / 100) / EXTRA)


def rare_first(words: np.ndarray, levels: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text's words, and their names from rare to frequent:
    those whose counter stands out come last; others go by the frequencies of their
    words, whose product tells how often chance makes a shingle, however large the
    corpus.  A name is both (19 bits), then 45 bits of the hash: names sort as they
    should in every text."""
    h = _windows(words, width)
    if not len(h):
        return h, h
    shingle_levels, word_levels = levels[:-1 << WORD_BITS], levels[-1 << WORD_BITS:]
    total = np.concatenate([[0], np.cumsum(word_levels[slot(words, len(word_levels))], dtype=np.uint64)])
    chance = np.minimum(total[len(total) - len(h):] - total[:len(h)], 2047).astype(np.uint64)
    high = shingle_levels[slot(h, len(shingle_levels))].astype(np.uint64) << np.uint64(11) | chance
    return _distinct(h), _distinct(high << np.uint64(45) | h >> np.uint64(19))


def _prefixes(docs: DataFrame, levels, width: int, pct: int) -> DataFrame:
    """(doc_id, n, s1, s2, token): one row per prefix shingle of the first copy of
    a set in each task, and one without a token for every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, met = levels.value, set()
        for ids, texts in text_slices(batches, ("doc_id",)):
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                h, ordered = rare_first(word_hashes(text), table, width)
                s = xxhash.xxh3_128_intdigest(h.tobytes())
                s1, s2 = (s & (1 << 63) - 1), s >> 65
                tokens: list = []
                if len(h) and (s1, s2) not in met and doc_id is not None:
                    met.add((s1, s2))
                    tokens = ordered[:prefix_length(len(h), pct) + len(h) // EXTRA].view(np.int64)
                rows.append((doc_id, len(h), s1, s2, tokens))
            yield record_batch(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    return docs.select("doc_id", "text").mapInArrow(
        _released(run), "doc_id long, n long, s1 long, s2 long, tokens array<long>")


def must_share(n: Column, m: Column, pct: int) -> Column:
    """Shingles that the longer prefixes of two linked sets of ``n`` and ``m`` share
    at least: of their overlap, no more than what one of the sets has behind its
    prefix is missing."""
    behind = lambda n: F.ceil(n * pct / 100) - 1 - F.floor(n / EXTRA)
    return F.greatest(F.lit(1), F.ceil((n + m) * pct / (100 + pct)) - F.greatest(behind(n), behind(m)))


def _close(rows: DataFrame, pct: int) -> DataFrame:
    """(a, b) edges between documents of rows (token, leader, doc_id, n) that hold
    together all that can be linked: pairs that share enough shingles held by at
    most ``PAIRED`` documents, and the documents of every other shingle."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("m", pa.int64())])
    columns = ("token", "leader", "doc_id", "n")

    def edges(token: np.ndarray, leader: np.ndarray, doc: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (leader[1:] != leader[:-1])]))
        size = np.diff(np.append(start, len(token)))
        end, held = np.repeat(start + size, size), np.repeat(size, size)
        star = np.flatnonzero(held > PAIRED)
        x, at, found = np.flatnonzero(held <= PAIRED), 0, []
        while len(x):     # each with the next, the next but one ...; the next ones are no smaller
            at += 1
            x = x[x + at < end[x]]
            x = x[100 * n[x] >= pct * n[x + at]]
            found.append((x, x + at))
        x, y = (np.concatenate([f[i] for f in found] or [star[:0]]) for i in (0, 1))
        x, y = np.where(doc[x] < doc[y], x, y), np.where(doc[x] < doc[y], y, x)
        x, y = x[doc[x] != doc[y]], y[doc[x] != doc[y]]
        none = np.zeros(len(star), np.int64)
        return record_batch({"a": np.concatenate([doc[x], leader[star]]), "b": np.concatenate([doc[y], doc[star]]),
                             "n": np.concatenate([n[x], none]), "m": np.concatenate([n[y], none])}, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            now = [np.concatenate([r, np.asarray(batch.column(c))]) for r, c in zip(rest, columns, strict=True)]
            if not len(now[0]):
                continue
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            last = last[-1] + 1 if len(last) else 0      # from here on the group may go on
            if len(now[0]) - last > PAIRED:              # it is a large one: some of its rows keep saying so
                yield edges(*now)
                rest = [c[-PAIRED - 1:] for c in now]
            else:
                if last:
                    yield edges(*(c[:last] for c in now))
                rest = [c[last:] for c in now]
        if len(rest[0]):
            yield edges(*rest)

    found = (rows.select(*columns).repartition("token", "leader").sortWithinPartitions("token", "leader", "n")
             .mapInArrow(run, "a long, b long, n long, m long"))
    return (found.groupBy("a", "b", "n", "m").agg(F.count("*").alias("met"))
            .filter((F.col("m") == 0) | (F.col("met") >= must_share(F.col("n"), F.col("m"), pct))).select("a", "b"))


def _cell_links(ids: np.ndarray, tiles: np.ndarray, sets: list[np.ndarray], across: bool, pct: int,
                every: bool) -> list[tuple[int, int]]:
    """Links in one cell, by a prefix join in memory.  ``across``: only pairs of
    different tiles."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, tiles, sets = ids[order], tiles[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    _, inverse, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.cumsum(sizes)
    # ranks from rare to frequent within the cell
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    tokens = [np.sort(rank[inverse[e - n:e]]) for e, n in zip(ends, sizes, strict=True)]
    alone = int((df == 1).sum())        # ranks below occur once and match nothing
    mark = np.zeros(len(df), bool)
    lists: dict[int, list[tuple[int, int]]] = {}
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    out = []
    for y, own in enumerate(tokens):
        n = len(own)
        least = -(-n * pct // 100)                     # length filter: a partner has as many
        head = own[:prefix_length(n, pct)]
        partners: dict[int, tuple[int, int]] = {}      # first shared place in x and in y
        for j, t in enumerate(head.tolist()):
            if t < alone:
                continue
            for x, i in lists.get(t, ()):
                if sizes[x] >= least and x not in partners and (not across or tiles[x] != tiles[y]):
                    partners[x] = (i, j)
            lists.setdefault(t, []).append((y, j))
        if not partners:
            continue
        xs = np.array(list(partners))
        at = np.array(list(partners.values()))
        need = -(-pct * (sizes[xs] + n) // (100 + pct))
        # positional filter: what is left after the first shared shingle
        rest_x, rest_y = sizes[xs] - at[:, 0] - 1, n - at[:, 1] - 1
        ok = 1 + np.minimum(rest_x, rest_y) >= need
        xs, at, need = xs[ok], at[ok], need[ok]
        if len(xs):
            # suffix filter: both suffixes are cut at y's middle shingle; the halves
            # overlap by no more than the smaller of each
            pivot = own[(n + 1) // 2 if n > 1 else 0]
            low_x = np.array([np.searchsorted(tokens[x], pivot) for x in xs]) - at[:, 0] - 1
            low_y = np.searchsorted(own, pivot) - at[:, 1] - 1
            low_x, low_y = np.maximum(low_x, 0), np.maximum(low_y, 0)
            after_x, after_y = sizes[xs] - at[:, 0] - 1 - low_x, n - at[:, 1] - 1 - low_y
            ok = 1 + np.minimum(low_x, low_y) + np.minimum(after_x, after_y) >= need
            xs, need = xs[ok], need[ok]
        if not every:
            here = find(y)
            ok = np.array([find(x) != here for x in xs], bool)
            xs, need = xs[ok], need[ok]
        if not len(xs):
            continue
        mark[own] = True
        overlap = np.add.reduceat(mark[np.concatenate([tokens[x] for x in xs])].astype(np.int64),
                                  np.cumsum(sizes[xs]) - sizes[xs])
        mark[own] = False
        for x in xs[overlap >= need].tolist():
            a, b = find(x), find(y)
            if every or a != b:
                root[max(a, b)] = min(a, b)
                if ids[x] != ids[y]:
                    out.append((int(min(ids[x], ids[y])), int(max(ids[x], ids[y]))))
    return out


def deal(groups: DataFrame) -> DataFrame:
    """(key, doc_id, tile, lo, hi): the cells of each document of groups (key,
    doc_id, n, part).  Documents of one ``part`` are in one component already
    (null: unknown).  A part of more than a tile has tiles of its own, which meet
    those of other parts only; all other documents of a key share mixed tiles,
    which meet every tile.  Tiles are named by hashes: should two have the same
    name, their documents meet in one cell, and no pair is missed."""
    open_keys = (groups.groupBy("key")
                 .agg(F.count("*").alias("docs"), F.count("part").alias("known"), F.min("part").alias("low"),
                      F.max("part").alias("high"))
                 .filter("docs > 1 and not (known = docs and low = high)").select("key"))
    large = (groups.filter("part is not null").groupBy("key", "part").agg(F.sum("n").alias("total"))
             .filter(F.col("total") > TILE).select("key", "part", F.col("part").cast("string").alias("label")))
    labelled = (groups.join(open_keys, "key", "left_semi").join(large, ["key", "part"], "left")
                .select("key", "doc_id", "n", F.coalesce("label", F.lit("")).alias("label")))
    labels = labelled.groupBy("key", "label").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("n") / TILE)).cast("int").alias("tiles"))
    met = labels.select("key", F.col("label").alias("other"), F.col("tiles").alias("others"))
    name = lambda label, number: F.xxhash64(label, number.cast("int"))
    return (labelled.join(labels, ["key", "label"])
            .withColumn("tile", name(F.col("label"), F.pmod(F.xxhash64("doc_id"), F.col("tiles"))))
            .join(met, "key").filter((F.col("label") == "") | (F.col("label") != F.col("other")))
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
            .withColumn("o", name(F.col("other"), F.col("o")))
            .select("key", "doc_id", "tile", F.least("tile", "o").alias("lo"), F.greatest("tile", "o").alias("hi")))


def deal_pivots(groups: DataFrame) -> DataFrame:
    """Cells, as ``deal`` gives them, of one tile of each key with every tile of
    the key: a document outside the first tile is in one cell."""
    tiles = groups.groupBy("key").agg(F.ceil(F.sum("n") / TILE).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("doc_id"), F.col("tiles"))
    all_tiles = F.sequence(F.lit(0).cast("long"), F.col("tiles").cast("long") - 1)
    return (groups.join(tiles, "key").withColumn("tile", tile)
            .select("key", "doc_id", "tile", F.explode(
                F.when(F.col("tile") == 0, all_tiles).otherwise(F.array(F.lit(0).cast("long")))).alias("o"))
            .select("key", "doc_id", "tile", F.least("tile", "o").alias("lo"), F.greatest("tile", "o").alias("hi")))


def _verify(dealt: DataFrame, docs: DataFrame, width: int, pct: int, every: bool) -> DataFrame:
    """(a, b) links between documents that meet in a cell of ``dealt``."""
    cell = ["key", "lo", "hi"]
    # texts are merged, never broadcast, at every size
    texts = docs.select("doc_id", "text").filter("text is not null").filter(maybe_in(dealt)).hint("merge")
    rows = (dealt.join(texts, "doc_id")
            .select(*cell, "tile", "doc_id", "text").repartition(*cell).sortWithinPartitions(*cell))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []

        def flush() -> pa.RecordBatch:
            ids, tiles, sets = (list(x) for x in zip(*held, strict=True))
            found = _cell_links(np.array(ids), np.array(tiles), sets, cell[1] != cell[2], pct, every)
            return record_batch({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema)

        for keys, los, his, tiles, ids, texts in text_slices(batches, ("key", "lo", "hi", "tile", "doc_id")):
            for *at, tile, doc_id, text in zip(keys, los, his, tiles, ids, texts, strict=True):
                if at != cell:
                    if len(held) > 1:
                        yield flush()
                    cell, held = at, []
                h = shingles(text, width)
                if len(h):
                    held.append((doc_id, tile, h))
        if len(held) > 1:
            yield flush()

    return rows.mapInArrow(_released(run), "a long, b long")


def join(docs: DataFrame, threshold_pct: int = 80, width: int = 5, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, links) of (doc_id, text): documents are (doc_id, n_shingles,
    copy_of), links (a, b) pairs of documents that hold every component together,
    or with ``every`` all links between first copies, where copy_of is the
    smallest doc_id with the same set."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    levels = spark.sparkContext.broadcast(rarity(docs, width))     # a byte a counter
    sets = written(_prefixes(docs, levels, width, threshold_pct), "prefixes")
    first = sets.filter("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("copy_of"))
    listed = written(sets.select("doc_id", "n", "s1", "s2").join(first, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "copy_of"), "sets")
    # documents that meet on a prefix shingle, parted where sizes leap
    by_size = Window.partitionBy("token").orderBy("n", "doc_id")
    met = (sets.select("doc_id", "n", F.explode("tokens").alias("token"))
           .withColumn("last_n", F.lag("n").over(by_size)).withColumn("next_n", F.lead("n").over(by_size))
           .withColumn("opens", F.coalesce(100 * F.col("last_n") < threshold_pct * F.col("n"), F.lit(True)))
           .withColumn("closes", F.coalesce(100 * F.col("n") < threshold_pct * F.col("next_n"), F.lit(True)))
           .withColumn("leader", F.last(F.when(F.col("opens"), F.col("doc_id")), ignorenulls=True).over(by_size))
           .filter(~(F.col("opens") & F.col("closes"))).select("token", "leader", "doc_id", "n"))
    shared = written(met, "shared")
    discard(sets)
    chains = written(shared.groupBy("leader", "doc_id", "n").agg(F.count("*").alias("met")), "chains")
    ids = chains.groupBy("doc_id", "n").agg(F.sum("met").alias("met")).filter(
        F.col("met") >= must_meet(F.col("n"), threshold_pct)).select("doc_id", "n")
    family = components(chains.join(ids, ["doc_id", "n"], "left_semi").select("leader", "doc_id").distinct()).toDF(
        "doc_id", "family")
    members = written(ids.join(family, "doc_id"), "members")
    sizes = lambda members: members.groupBy("family").agg(
        F.sum("n").alias("total"), F.count("*").alias("docs")).filter("docs > 1")
    large = written(members.join(sizes(members).filter(F.col("total") > TILE).select("family"), "family", "left_semi")
                    .select("doc_id", "n"), "large")
    if not large.isEmpty():
        # families of more than a tile fall apart into documents that share as much as linked ones must
        family = components(written(_close(shared.join(large, ["doc_id", "n"]), threshold_pct), "close")).toDF(
            "doc_id", "family")
        members = written(members.join(large, ["doc_id", "n"], "left_anti").select("doc_id", "n", "family")
                          .unionByName(large.join(family, "doc_id")), "members")
    totals = sizes(members)
    linked = None
    if not every:
        # families of many tiles: the links to one tile first, as what these hold together is not compared again
        several = (members.join(totals.filter(F.col("total") > TILE * PIVOT_TILES), "family", "left_semi")
                   .select(F.col("family").alias("key"), "doc_id", "n"))
        if not several.isEmpty():
            linked = written(_verify(written(deal_pivots(several), "pivots"), docs, width, threshold_pct, False),
                             "pivot-links")
    if linked is None:
        members = members.withColumn("part", F.lit(None).cast("long"))
    else:
        members = written(members.join(components(linked).toDF("doc_id", "part"), "doc_id", "left"), "parts")
    wide = totals.filter(F.col("total") > TILE * MAX_TILES).select("family")
    whole = (members.join(totals.filter(F.col("total") <= TILE * MAX_TILES), "family", "left_semi")
             .select(F.col("family").alias("key"), "doc_id", "n", "part"))
    by_token = (shared.join(members.join(wide, "family", "left_semi").select("doc_id", "n", "part"), ["doc_id", "n"])
                .select(F.xxhash64("token", "leader").alias("key"), "doc_id", "n", "part").distinct())
    found = _verify(written(deal(whole), "cells"), docs, width, threshold_pct, every)
    if not wide.isEmpty():
        found = found.union(_verify(written(deal(by_token), "token-cells"), docs, width, threshold_pct, every))
    if linked is not None:
        found = found.union(linked)
    return listed, written(found.distinct(), "jaccard-links")


def classes(docs: DataFrame, threshold_pct: int = 80, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id reachable by links."""
    listed, links = join(docs, threshold_pct, width)
    copies = listed.filter("copy_of is not null and doc_id <> copy_of").select("doc_id", "copy_of")
    found = components(links.union(copies)).toDF("doc_id", "component")
    return (listed.join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
