"""Connected components of an edge table, on Spark throughout.

Edges are rewired round by round (large star, then small star): every node's
larger neighbours move to its smallest neighbour, then its smaller ones do,
until nothing moves and every node hangs on the smallest of its component.  Each
round is a few shuffles with map-side minima; a node with very many neighbours
is a hot join key that skew handling splits.  Before it is written each task
contracts the edges it holds to stars, which shortens long paths.  Rounds are
written to shared storage, so lineage stays short.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import prepare, record_batch, written

#: Edges that a task contracts at a time; bounds its memory.
CHUNK = 1_000_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with a > b; the result points each moved node at a smaller one."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def _contract(edges: DataFrame) -> DataFrame:
    """The same components from stars: union-find over the edges of a task."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = list(range(len(nodes)))   # ascending nodes: the smallest place is the smallest node
        for x, y in zip(at[:len(a)].tolist(), at[len(a):].tolist(), strict=True):
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x < y:
                root[y] = x
            else:
                root[x] = y
        up = np.array(root)
        while (up[up] != up).any():
            up = up[up]
        moved = np.flatnonzero(up != np.arange(len(up)))
        return record_batch({"a": nodes[moved], "b": nodes[up[moved]]}, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append((np.asarray(batch.column("a")), np.asarray(batch.column("b"))))
            n += batch.num_rows
            if n >= CHUNK:
                yield stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield stars(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node on an edge
    of ``edges`` (two long columns, any names; loops and repeats are harmless,
    nulls are ignored)."""
    x, y = (F.col(f"`{c}`").cast("long") for c in edges.columns)
    prepare(edges.sparkSession)
    now = written(edges.select(x.alias("x"), y.alias("y")).filter("x is not null and y is not null")
                  .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    loops = now.filter("a = b").select("a")
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    kept = written(_contract(now.filter("a > b")), "edges")
    before = state(kept)
    while before[0]:
        kept = written(_contract(_star(_star(kept, large=True), large=False)), "edges")
        after = state(kept)
        if after == before:
            break
        before = after
    roots = kept.select(F.col("b").alias("a")).union(loops)
    return (kept.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(roots.distinct().join(kept.select("a").distinct(), "a", "left_anti")
                   .select(F.col("a").alias("node"), F.col("a").alias("component"))))
