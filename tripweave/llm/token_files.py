"""Token-id files in Simple-8b coding (operator 8).

Ids are packed into 64-bit words: the top four bits select how many ids of how
many bits the other 60 hold.  Ids of more than 60 bits go to a side list, and a
word with selector 0 holds the place in it (an escape).  Every ``STRIDE`` words
a block notes how many ids come before, so a document is read without decoding
its whole block, and decoding is a few numpy operations per selector.

A file is a Parquet table of blocks in ascending (doc_id, text) order; each row
has the block's place and its bytes:

    magic "TID1" | uint32 stride | uint64 documents, ids, words, escapes
    int64 doc_id[documents] | uint8 doc_id is null[documents] | uint64 ids of each document[documents]
    uint64 words[words] | uint64 escapes[escapes] | uint64 ids before each STRIDE words

Blocks are written by range-partitioned tasks through Spark's commit protocol to
shared storage, so a retried task leaves no half file.

Rows: a null text is an empty one (its end id alone is written); a null doc_id
sorts first; repeated ids are kept, ordered by text hash.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.llm.common import prepare, record_batch, text_slices
from tripweave.llm.token_cache import library_ids, tokenizer_text
from tripweave.session import scratch_path

MAGIC = b"TID1"
STRIDE = 1024
BLOCK_IDS = 1 << 18
#: Chunks in each of the two generations of a worker's cache, of about 200 bytes.
CACHE_CHUNKS = 800_000
#: Ids per word and bits per id of each selector; 0 is the escape.
COUNT = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


_WIDTHS = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def bit_widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each of some unsigned 64-bit ids takes."""
    out = np.zeros(len(ids), np.uint8)
    for part in range(4 if len(ids) and int(ids.max()) >> 16 else 1):
        x = _WIDTHS[(ids >> np.uint64(16 * part)).astype(np.uint16)]
        out = np.where(x > 0, x + np.uint8(16 * part), out)
    return out


def pack_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of unsigned ids.  Each word takes the most ids that fit;
    the last may be filled up with zeros."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    choice = np.zeros(n, np.uint8)   # selector of a word that starts at each id
    # the widest of 1, 2, 4 ... ids in a row; zeros follow the last id
    widths = [np.concatenate([bit_widths(ids), np.zeros(240, np.uint8)])]
    for s in range(15, 0, -1):       # from one id a word to the most
        power = int(COUNT[s]).bit_length() - 1
        while len(widths) <= power:
            x, m = widths[-1], 1 << (len(widths) - 1)
            widths.append(np.maximum(x[:-m], x[m:]))
        x, rest = widths[power], int(COUNT[s]) - (1 << power)
        np.copyto(choice, np.uint8(s), where=np.maximum(x[:n], x[rest:rest + n]) <= np.uint8(BITS[s]))
    step = COUNT[choice].astype(np.uint8).tobytes()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    first = np.array(starts, np.int64)
    selector = choice[first] if n else choice
    words = selector.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([ids, np.zeros(240, np.uint64)])
    for s in range(2, 16):
        rows = np.flatnonzero(selector == s)
        if len(rows):
            at, some = first[rows], words[rows]
            for k in range(COUNT[s]):
                some |= padded[at + k] << np.uint64(k * BITS[s])
            words[rows] = some
    escaped = np.flatnonzero(selector == 0)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    return words, ids[first[escaped]]


def unpack_words(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNT[selector]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in range(2, 16):
        rows = np.flatnonzero(selector == s)
        if len(rows):
            mask = np.uint64((1 << int(BITS[s])) - 1)
            at, some = first[rows], words[rows]
            for k in range(COUNT[s]):
                out[at + k] = (some >> np.uint64(k * BITS[s])) & mask
    escaped = np.flatnonzero(selector == 0)
    out[first[escaped]] = escapes[(words[escaped] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:n]


def write_block(doc_ids: Sequence[int | None], arrays: Sequence[np.ndarray]) -> bytes:
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).astype(np.uint64)
    words, escapes = pack_words(flat)
    counts = COUNT[(words >> np.uint64(60)).astype(np.int64)]
    before = (np.cumsum(counts) - counts)[::STRIDE].astype("<u8")
    return b"".join((
        MAGIC, struct.pack("<IQQQQ", STRIDE, len(doc_ids), len(flat), len(words), len(escapes)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids),
        np.array([len(a) for a in arrays], "<u8").tobytes(),
        words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes(), before.tobytes()))


class Block:
    """Reader of one block: all ids at once, or one document's."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token-id block")
        self.stride, docs, self.n_ids, n_words, n_escapes = struct.unpack_from("<IQQQQ", data, 4)
        at = 4 + struct.calcsize("<IQQQQ")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, n, at)
            at += got.nbytes
            return got

        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if x else int(i) for i, x in zip(ids, null, strict=True)]
        self.sizes = take("<u8", docs).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words, self.escapes = take("<u8", n_words), take("<u8", n_escapes)
        self.before = take("<u8", -(-n_words // self.stride)).astype(np.int64)

    def all_ids(self) -> np.ndarray:
        return unpack_words(self.words, self.escapes, self.n_ids)

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i`` of the block, decoding only the strides it lies in."""
        start, end = int(self.starts[i]), int(self.starts[i] + self.sizes[i])
        if start == end:
            return np.zeros(0, np.uint64)
        lo = int(np.searchsorted(self.before, start, side="right")) - 1
        hi = int(np.searchsorted(self.before, end, side="left"))
        base = int(self.before[lo])
        ids = unpack_words(self.words[lo * self.stride:hi * self.stride], self.escapes, end - base)
        return ids[start - base:end - base]


_BLOCKS = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("start", pa.int64()),
                     ("n_ids", pa.int64()), ("payload", pa.binary())])
_BLOCKS_DDL = "shard long, block long, start long, n_ids long, payload binary"


def write_files(docs: DataFrame, path: str | None = None, end_id: int = 0, tokenizer_path: str | None = None,
                block_ids: int = BLOCK_IDS) -> str:
    """Tokenize and write ``docs`` (doc_id, text) in ascending order; returns the
    folder.  ``start`` of a block counts the ids before it in its shard."""
    spark = docs.sparkSession
    prepare(spark)
    path = path or scratch_path(spark, "token-files")
    spec = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, shard = library_ids(spec.value, CACHE_CHUNKS), TaskContext.get().partitionId()
        block = start = size = 0
        ids: list[int | None] = []
        arrays: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            return record_batch({"shard": [shard], "block": [block], "start": [start], "n_ids": [size],
                                 "payload": [write_block(ids, arrays)]}, _BLOCKS)

        for doc_ids, texts in text_slices(batches, ("doc_id",)):
            for doc_id, text in zip(doc_ids, texts, strict=True):
                ids.append(doc_id)
                arrays.append(np.frombuffer(cache.packed(text) + end, "<u4"))
                size += len(arrays[-1])
                if size >= block_ids:
                    yield flush()
                    block, start, size = block + 1, start + size, 0
                    ids.clear()
                    arrays.clear()
        if ids:
            yield flush()

    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text"), F.xxhash64("text").alias("h"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h"))
    ordered.select("doc_id", "text").mapInArrow(run, _BLOCKS_DDL).write.parquet(path)
    return path


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, start, n_ids, payload); shards and blocks are in document order."""
    return spark.read.schema(_BLOCKS_DDL).parquet(path)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    blocks = read_files(spark, path)
    # one row per shard, that is per task of the writing stage
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    schema = pa.schema([(n, pa.int64()) for n in ("shard", "doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, payload in zip(*(batch.column(n) for n in ("shard", "start", "payload")), strict=True):
                block = Block(payload.as_py())
                ids = block.all_ids().astype("<u4")
                ends = block.starts + block.sizes
                yield record_batch({
                    "shard": [shard.as_py()] * len(ends), "doc_id": block.doc_ids,
                    "start": block.starts + start.as_py(), "n_tokens": block.sizes,
                    "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(block.starts, ends, strict=True)],
                }, schema)

    docs = blocks.select("shard", "start", "payload").mapInArrow(
        run, "shard long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
