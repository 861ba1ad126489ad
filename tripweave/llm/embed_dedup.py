"""Near-duplicate embeddings (operator 10): random-hyperplane sign hashing,
exact cosine verification, distributed connected components.

Vectors with equal components are collapsed to one class first.  A class has one
signature per table, the signs of its dot products with the table's hyperplanes;
two classes meet in a table if their signatures are equal.  Bits per table grow
with the logarithm of the number of classes, so buckets of unrelated vectors
keep their size; the number of tables follows from the bits and ``miss``, the
chance that a pair just at the threshold meets nowhere.

A bucket is dealt out in tiles of about ``tile`` classes, and each pair of tiles
is one small matrix product, so a hot bucket is spread over many tasks.  A pair
whose cosine, in double precision, has passed counts in the first table in which
it meets.  A cell returns link counts and one root for each class, not the pairs.

Rows: vectors that are null, zero, or hold null or non-finite components link
with nothing; vectors of different length are never compared; of a repeated
vec_id with different components the usable vector with the smallest hash
counts, and every row returns its result; null vec_ids are returned unlinked;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import prepare, record_batch, written
from tripweave.llm.components import components



def shape(n: int, threshold: float, miss: float = 1e-3, bucket: int = 24) -> tuple[int, int]:
    """(bits, tables) for ``n`` classes: buckets of about ``bucket`` unrelated
    classes, and a pair at the threshold missed with probability ``miss``."""
    bits = max(6, min(60, math.ceil(math.log2(max(n, 1) / bucket)) if n > bucket else 6))
    agree = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of vectors that can link."""
    v = F.col("v")
    return (embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
            .filter(v.isNotNull() & (F.size(v) > 0) & F.col("vec_id").isNotNull())
            .filter(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .filter(F.exists(v, lambda x: x != 0)))


def classes(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, h1, h2, rep): vectors with equal components share a class,
    named after its smallest id.  Only a 128-bit hash is shuffled."""
    keyed = vectors.select("vec_id", F.struct(
        F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), F.size("v").alias("dim")).alias("k"))
    one = keyed.groupBy("vec_id").agg(F.min("k").alias("k")).select("vec_id", "k.*")
    low = one.groupBy("dim", "h1", "h2").agg(F.min("vec_id").alias("rep"))
    return one.join(low, ["dim", "h1", "h2"])


def _signatures(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    dim = vectors.shape[1]
    planes = np.random.default_rng((seed, dim)).standard_normal((dim, tables * bits))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _hashed(reps: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """One row per class: its unit vector and its hash in each table."""
    schema = pa.schema([("rep", pa.int64()), ("dim", pa.int32()), ("copies", pa.int64()), ("vector", pa.binary()),
                        ("sigs", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies = np.asarray(batch.column("vec_id")), np.asarray(batch.column("copies"))
            sizes = np.asarray(batch.column("v").value_lengths())
            flat = np.asarray(batch.column("v").flatten())
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x = flat[starts[rows][:, None] + np.arange(dim)]
                x = x / np.abs(x).max(axis=1, keepdims=True)        # no overflow in the norm
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                sigs = _signatures(x, bits, tables, seed)
                yield record_batch({"rep": ids[rows], "dim": np.full(len(rows), dim), "copies": copies[rows],
                                    "vector": [r.astype("<f8").tobytes() for r in x],
                                    "sigs": [s.astype("<i8").tobytes() for s in sigs], "keys": list(sigs)}, schema)

    return reps.select("vec_id", "v", "copies").mapInArrow(
        run, "rep long, dim int, copies long, vector binary, sigs binary, keys array<long>")


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest place in the component of each of ``n`` places linked by (i, j)."""
    root = np.arange(n)
    while True:
        low, now = np.minimum(root[i], root[j]), root.copy()
        np.minimum.at(now, i, low)
        np.minimum.at(now, j, low)
        now = now[now]
        if (now == root).all():
            return root
        root = now


def compare_cells(cells: DataFrame, threshold: float, pairs: bool = False) -> DataFrame:
    """(rep, root, others) from rows sorted by cell: for each class with a link
    in a cell, one class of its component there, and the vectors of the classes
    that it is linked with.  A link counts in the first table where both meet.
    With ``pairs`` the links themselves, (a, b) with a < b."""
    names = ("a", "b") if pairs else ("rep", "root", "others")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def links(rows: list[tuple]) -> pa.RecordBatch:
        (table, _, lo, hi, *_), same = rows[0], rows[0][2] == rows[0][3]
        tile, ids, copies = (np.array([r[k] for r in rows]) for k in (4, 5, 7))
        x = np.frombuffer(b"".join(r[8] for r in rows), "<f8").reshape(len(rows), -1)
        sigs = np.frombuffer(b"".join(r[9] for r in rows), "<i8").reshape(len(rows), -1)
        left = np.arange(len(rows)) if same else np.flatnonzero(tile == lo)
        right = left if same else np.flatnonzero(tile == hi)
        i, j = np.nonzero(x[left] @ x[right].T >= threshold)
        i, j = left[i], right[j]
        keep = ids[i] < ids[j] if same else ids[i] != ids[j]
        i, j = i[keep], j[keep]
        if table and len(i):
            met = np.zeros(len(i), bool)
            for t in range(table):
                met |= sigs[i, t] == sigs[j, t]
            i, j = i[~met], j[~met]
        if pairs:
            return record_batch({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j])}, schema)
        others = np.zeros(len(rows), np.int64)
        np.add.at(others, i, copies[j])
        np.add.at(others, j, copies[i])
        at, root = np.flatnonzero(others), _roots(len(rows), i, j)
        return record_batch({"rep": ids[at], "root": ids[root[at]], "others": others[at]}, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = (*row[:4], row[6])
                if key != cell:
                    if len(rows) > 1:
                        yield links(rows)
                    cell, rows = key, []
                rows.append(row)
        if len(rows) > 1:
            yield links(rows)

    return cells.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def near_pairs(reps: DataFrame, n: int, threshold: float = 0.95, miss: float = 1e-3, tile: int = 256,
               seed: int = 11) -> DataFrame:
    """(a, b) class pairs of reps (vec_id, v) with cosine >= threshold, each once:
    quadratic in the size of a group, so ``dedup`` asks for ``near_links``."""
    return compare_cells(_cells(reps.withColumn("copies", F.lit(1).cast("long")), n, threshold, miss, tile, seed),
                         threshold, pairs=True)


def near_links(reps: DataFrame, n: int, threshold: float = 0.95, miss: float = 1e-3, tile: int = 256,
               seed: int = 11) -> DataFrame:
    """(rep, root, others) of ``compare_cells`` for all classes (vec_id, v,
    copies) with cosine >= threshold: no more rows than classes times the cells
    they are in, however many links a group has."""
    return compare_cells(_cells(reps, n, threshold, miss, tile, seed), threshold)


def _cells(reps: DataFrame, n: int, threshold: float, miss: float, tile: int, seed: int) -> DataFrame:
    """Rows of ``compare_cells``, sorted by cell."""
    bits, tables = shape(n, threshold, miss)
    # written: a class computed twice could fall into two buckets of a table
    signed = written(_hashed(reps, bits, tables, seed), "signed")
    # sizes of the buckets: a count that combines map-side, of hashes alone
    sizes = (signed.select("dim", F.posexplode("keys").alias("table", "sig")).groupBy("table", "sig", "dim")
             .agg(F.count("*").alias("n")).filter("n > 1")
             .select("table", "sig", "dim", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    dealt = (signed.select("rep", "dim", "copies", "vector", "sigs", F.posexplode("keys").alias("table", "sig"))
             .join(sizes, ["table", "sig", "dim"])
             .withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    cells = dealt.select("*", other.alias("o")).select(
        "table", "sig", F.least("tile", "o").alias("lo"), F.greatest("tile", "o").alias("hi"), "tile", "rep", "dim",
        "copies", "vector", "sigs")
    cell = ["table", "sig", "dim", "lo", "hi"]
    return cells.repartition(*cell).sortWithinPartitions(*cell)


def dedup(embeddings: DataFrame, threshold: float = 0.95, miss: float = 1e-3) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    prepare(embeddings.sparkSession)
    vectors = usable(embeddings)
    member = written(classes(vectors), "classes")
    sizes = member.groupBy("rep").agg(F.count("*").alias("copies"))
    n = sizes.count()
    own = member.filter("vec_id = rep").select("vec_id", "h1")
    reps = (vectors.withColumn("h1", F.xxhash64("v")).join(own, ["vec_id", "h1"], "left_semi")
            .dropDuplicates(["vec_id"]).join(sizes.withColumnRenamed("rep", "vec_id"), "vec_id")
            .select("vec_id", "v", "copies"))
    found = written(near_links(reps, n, threshold, miss), "links")
    linked = found.groupBy("rep").agg(F.sum("others").alias("others"))
    groups = components(found.select("rep", "root")).toDF("rep", "component")
    per_class = (sizes.join(linked, "rep", "left").join(groups, "rep", "left")
                 .select("rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    known = member.join(per_class, "rep").select("vec_id", "n_links", "component_id")
    ids = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"))
    return (ids.join(known, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
