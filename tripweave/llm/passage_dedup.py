"""Repeated passages: every byte covered by a string of ``length`` bytes that also
starts somewhere else.

A window is a string of ``length`` bytes at one place.  Each is assigned to the
place of its smallest k-gram hash (the leftmost one), which depends on nothing
but its bytes, so equal windows have the same k-gram at the same offset.  The
windows in a row with one such place, and the bytes they cover, are a region;
equal regions are one class with a count, and only classes that share their k-gram
with another class can hold a repeat that the count does not show.  Their texts,
one per class, are dealt to shards by k-gram, all of one k-gram to one shard.  A
shard's suffix array is made by induced sorting (``induced_sort``); a window is
repeated where the common prefix with a neighbour has ``length`` or more.

A k-gram of very many classes (a passage in a third of all documents, each with
other text around it) is parted by what its windows share: windows whose k-gram
lies within the same few offsets share a core longer than the k-gram, and the
core is the new key.  Three narrowings end at single windows, which are their own
core, so that counting equal ones decides.  No step needs all texts of one k-gram.

Joins that carry texts are merge joins at every size: the disk and memory they
need then grow in proportion.  Hashes only choose what is compared and name equal regions (128 bits).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tripweave.llm.common import prepare, record_batch, written
from tripweave.llm.induced_sort import common_prefixes, suffix_array
from tripweave.llm.membership import maybe_in

#: Bytes of texts scanned at a time; longer ones are scanned in overlapping parts.
SCAN_BYTES = 400_000
#: Bytes of a shard, about, and of one k-gram's texts in it at most.
SHARD_BYTES = 1_500_000
GROUP_BYTES = 1_000_000
#: Ways in which the regions of one class are dealt when they are told apart from others.
SALTS = 8

_PLACE = np.uint64(0xFFFFF)
_SYMBOLS = np.random.default_rng(12).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_size(length: int) -> int:
    return 1 << max((length // 4).bit_length() - 1, 0)


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes (a power of two) at every place."""
    h, base, m = _SYMBOLS[b], 0x9E3779B97F4A7C15, 1
    while m < gram:
        h = h[:-m] * np.uint64(base) + h[m:]
        base, m = base * base % (1 << 64), 2 * m
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(h: np.ndarray, windows: int) -> np.ndarray:
    """Place of the smallest hash (44 bits; the leftmost) among each ``windows`` in a row."""
    x, m = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * m <= windows:
        x = np.minimum(x[:-m], x[m:])
        m *= 2
    rest = windows - m
    x = np.minimum(x[:len(x) - rest], x[rest:]) if rest else x
    return (x & _PLACE).astype(np.int64)


REGION = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()), ("lead", pa.int32()),
                    ("anchor", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())])


def _regions(parts: list[tuple[int, int, bytes]], length: int) -> pa.RecordBatch:
    """Regions of some (row, first byte, bytes), each of ``length`` bytes or more."""
    gram = gram_size(length)
    buf = b"".join(p for _, _, p in parts)
    sizes = np.array([len(p) for _, _, p in parts])
    begins = np.cumsum(sizes) - sizes
    h = gram_hashes(np.frombuffer(buf, np.uint8), gram)
    at = anchors(h, length - gram + 1)
    inside = np.ones(len(at) + length, bool)
    for e in (begins + sizes).tolist():
        inside[max(e - length + 1, 0):e] = False
    w = np.flatnonzero(inside[:len(at)])
    a = at[w]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (np.diff(w) != 1)]))
    lo, hi = w[new], w[np.append(new[1:], len(w)) - 1]
    own = np.searchsorted(begins, lo, side="right") - 1
    view = memoryview(buf)
    digest = b"".join(xxhash.xxh3_128_digest(view[x:y]) for x, y in zip(lo.tolist(), (hi + length).tolist(), strict=True))
    d = np.frombuffer(digest, ">i8").astype(np.int64).reshape(-1, 2)
    rows, firsts = np.array([r for r, _, _ in parts]), np.array([f for _, f, _ in parts])
    return record_batch({"row": rows[own], "start": firsts[own] + lo - begins[own], "windows": (hi - lo + 1).astype(np.int32),
                         "lead": (a[new] - lo).astype(np.int32), "anchor": h[a[new]].view(np.int64), "d1": d[:, 0],
                         "d2": d[:, 1]}, REGION)


def find_regions(docs: DataFrame, length: int) -> DataFrame:
    """(row, start, windows, lead, anchor, d1, d2) of every region of ``docs`` (row,
    text): ``lead`` is the place of the k-gram in it, d1 and d2 its digest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or b""
                for first in range(0, max(len(text) - length + 1, 0), SCAN_BYTES):
                    part = text[first:first + SCAN_BYTES + length - 1]
                    held.append((row, first, part))
                    size += len(part)
                    if size >= SCAN_BYTES:
                        yield _regions(held, length)
                        held, size = [], 0
        if held:
            yield _regions(held, length)

    return docs.select("row", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "row long, start long, windows int, lead int, anchor long, d1 long, d2 long")


PART = "key long, row long, start long, windows int, lead int, n long, text binary"
_PART = pa.schema([("key", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()),
                   ("lead", pa.int32()), ("n", pa.int64()), ("text", pa.binary())])


def _texts(docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """The bytes of one region of each class, as parts: (key, row, start, windows, lead, n, text)."""
    wanted = classes.groupBy("row").agg(F.collect_list(F.struct("anchor", "start", "windows", "lead", "n")).alias("regions"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, regions in zip(*(batch.column(c) for c in ("row", "text", "regions")), strict=True):
                text, row, regions = text.as_py(), row.as_py(), regions.as_py()
                yield record_batch({
                    "key": [r["anchor"] for r in regions], "row": [row] * len(regions), "start": [r["start"] for r in regions],
                    "windows": [r["windows"] for r in regions], "lead": [r["lead"] for r in regions],
                    "n": [r["n"] for r in regions],
                    "text": [text[r["start"]:r["start"] + r["windows"] + length - 1] for r in regions]}, _PART)

    some = docs.select("row", F.col("text").cast("binary").alias("text")).filter(maybe_in(wanted.select("row"), "row"))
    return some.join(wanted.hint("merge"), "row").mapInArrow(run, PART)


def _narrower(parts: DataFrame, width: int, length: int) -> DataFrame:
    """Parts cut where the offset of their k-gram passes a multiple of ``width``;
    the key is a hash of what all windows with such an offset share."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first = 0
                while first < r["windows"]:
                    cell = (r["lead"] - first) // width          # offset of the k-gram in window ``first``
                    end = min(r["windows"], r["lead"] - cell * width + 1)
                    lo, hi = r["lead"] - cell * width, r["lead"] - cell * width - width + 1 + length
                    key = xxhash.xxh3_64_intdigest(r["text"][lo:hi], seed=cell) - (1 << 63)
                    out.append((key, r["row"], r["start"] + first, end - first, r["lead"] - first, r["n"],
                                r["text"][first:end + length - 1]))
                    first = end
            if out:
                yield record_batch(dict(zip(_PART.names, zip(*out, strict=True), strict=True)), _PART)

    return parts.mapInArrow(run, PART)


def _merged(parts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Parts of equal text as one, with a count of two or more, and the spans of
    those that were met once so far."""
    parts = written(parts.withColumn("same", F.md5("text")), "parts")
    counts = parts.groupBy("key", "same").agg(F.count("*").alias("met"), F.max("n").alias("n"), F.first(
        F.struct("row", "start", "windows", "lead", "text")).alias("x"))
    counts = written(counts, "merged")
    again = counts.filter("met > 1").select("key", "same")
    spans = parts.filter("n = 1").join(again, ["key", "same"], "left_semi").select(
        "row", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("end"))
    return counts.select("key", "x.row", "x.start", "x.windows", "x.lead",
                         F.greatest("n", F.least("met", F.lit(2))).alias("n"), "x.text"), spans


def _by_suffix_array(parts: DataFrame, length: int) -> DataFrame:
    """(row, start, end) of the windows met once that occur in another part."""
    total = parts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1
    schema = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        texts, n = table.column("text").to_pylist(), table.column("n").to_pylist()
        sizes = np.array([len(x) + 1 for x in texts])
        begins = (np.cumsum(sizes) - sizes).tolist()
        t = np.zeros(int(sizes.sum()) + 1, np.uint16)
        for at, text in zip(begins, texts, strict=True):
            t[at:at + len(text)] = np.frombuffer(text, np.uint8)
            t[at:at + len(text)] += 2
            t[at + len(text)] = 1
        before, prefix = common_prefixes(t, suffix_array(t))
        long = np.flatnonzero(prefix >= length)
        hit = np.zeros(len(t), bool)
        hit[long] = True
        hit[before[long]] = True
        out = []
        windows = table.column("windows").to_pylist()
        for i, (row, start) in enumerate(zip(table.column("row").to_pylist(), table.column("start").to_pylist(), strict=True)):
            if n[i] > 1:
                continue
            h = np.concatenate([[False], hit[begins[i]:begins[i] + windows[i]], [False]])
            ends = np.flatnonzero(h[1:] != h[:-1]).reshape(-1, 2)
            out += [(row, start + x, start + y + length - 1) for x, y in ends.tolist()]
        return pa.Table.from_batches([record_batch(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)]
                                     if out else [], schema=schema)

    return (parts.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard")
            .applyInArrow(run, "row long, start long, end long"))


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(row, start, end) of bytes to remove, in no order and overlapping, of ``docs``
    (row, text) with unique rows.  ``docs`` is read several times."""
    regions = written(find_regions(docs, length), "regions")
    key = ["anchor", "d1", "d2"]
    # a k-gram met once takes part in no repeat, and most are
    shared = written(regions.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "shared")
    regions = regions.filter(maybe_in(shared, "anchor"))
    classes = regions.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("row", "start")).alias("first"),
                                        F.max("windows").alias("windows"), F.max("lead").alias("lead"))
    classes = written(classes.select(*key, "n", "first.row", "first.start", "windows", "lead"), "classes")
    groups = classes.groupBy("anchor").agg(F.count("*").alias("k"), F.min("n").alias("least"))
    single = classes.join(groups.filter("k > 1 and least = 1").select("anchor").hint("merge"), "anchor", "left_semi")
    parts, spans, w = written(_texts(docs, single, length), "parts"), [], length - gram_size(length) + 1
    for width in (max(w // 7, 1), max(w // 56, 1), 1):
        sizes = written(parts.groupBy("key").agg(F.sum(F.length("text")).alias("bytes"), F.count("*").alias("k")), "sizes")
        # written, so that few keys are broadcast and the texts are not shuffled for them
        hot = written(sizes.filter(f"bytes > {GROUP_BYTES}").select("key"), "hot")
        alone = sizes.filter("k = 1").select("key")
        # most often neither is there, and the texts need no join
        rest = parts if hot.isEmpty() else parts.join(hot, "key", "left_anti")
        spans.append(_by_suffix_array(rest if alone.isEmpty() else rest.join(alone, "key", "left_anti"), length))
        if hot.isEmpty():
            break
        parts, met = _merged(_narrower(parts.join(hot, "key", "left_semi"), width, length), length)
        spans.append(met)
    # copies of a class are repeated as a whole
    copies = written(classes.filter("n > 1").select("d1", "d2"), "copies")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    again = (regions.filter(maybe_in(copies, "d1")).select("d1", "d2", "row", "start", "windows", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
             .join(copies.select("d1", "d2", salts).hint("merge"), ["d1", "d2", "salt"], "left_semi")
             .select("row", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("end")))
    for s in spans:
        again = again.unionByName(s)
    return again


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``docs`` (doc_id, text) with ``kept`` (binary: the UTF-8 bytes of text without
    those covered by a repeated string of ``length`` bytes) and ``spans`` (the
    maximal removed runs, start and end in bytes).  Every row is a document, also
    with a null or repeated doc_id; null text is empty and keeps nothing.  Other
    columns are passed on, but for ``kept`` and ``spans``.  An empty table stays empty."""
    prepare(docs.sparkSession)
    row = "_row"
    docs = docs.drop("kept", "spans", row)
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    texts = keyed.select(F.col(row).alias("row"), "text")
    spans = written(repeated_spans(texts, length), "spans")
    per = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    per = written(per.withColumnRenamed("row", row), "per-document")
    columns = [c for c in keyed.columns if c != row]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for text, found in zip(batch.column("text"), batch.column("found"), strict=True):
                text, runs, at, left = (text.as_py() or "").encode("utf-8", "surrogatepass"), [], 0, []
                for x in sorted(found.as_py() or [], key=lambda x: x["start"]):
                    if runs and x["start"] <= runs[-1]["end"]:
                        runs[-1]["end"] = max(runs[-1]["end"], x["end"])
                    else:
                        runs.append(x)
                for x in runs:
                    left.append(text[at:x["start"]])
                    at = x["end"]
                kept.append(b"".join([*left, text[at:]]))
                spans.append(runs)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(kept, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[*columns, "kept", "spans"])

    maybe = maybe_in(per, row)
    out = StructType([*(keyed.schema[c] for c in columns), StructField("kept", BinaryType()), StructField(
        "spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())])))])
    whole = keyed.filter(~maybe).select(*columns, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("kept"),
                                        F.array().cast(out["spans"].dataType).alias("spans"))
    return whole.unionByName(keyed.filter(maybe).join(per.hint("merge"), row, "left").mapInArrow(run, out))
