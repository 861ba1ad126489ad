"""Best-fit packing by bin completion (operator 7).

A text becomes its ids and the end id.  Only documents longer than a sequence
are cut: into full pieces, of which the first may be shorter.  Pieces are packed
into as few sequences as possible.

Packing needs only how many pieces of each length there are, at most
``capacity`` numbers whatever the size of the corpus.  The driver solves that
histogram; tasks count pieces and place them.  The plan that goes back to the
tasks is bounded too: one row per length in each kind of sequence.

The solver is bin completion: the next sequence holds the longest piece left,
completed by one of the undominated fillings of the room beside it.  A kind of
sequence is repeated while its pieces last, so the search is over kinds, not
pieces.  A first descent that always takes the best-fitting filling gives the
incumbent; branch and bound goes on for better ones, cutting branches whose
waste reaches the incumbent's, until the lower bound is met or ``max_nodes``
more nodes are searched.  The limit bounds the time spent on proving; every piece is
placed whatever it is.

Rows: a null text is an empty one (its end id alone is packed); doc_id may be
null or repeated, each row's pieces are packed; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import prepare, record_batch, released, text_slices, written
from tripweave.llm.token_cache import library_ids, tokenizer_text

Filling = tuple[tuple[int, int], ...]   # (length, how many), longest first


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


# ---------------------------------------------------------------- the solver
def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: by total length, and by pieces over half a
    sequence, which never share one, with what cannot join them."""
    best = -(-sum(k * n for k, n in counts.items()) // capacity)
    lengths = np.array(sorted(counts), np.int64)
    number = np.array([counts[int(k)] for k in lengths], np.int64)
    for small in lengths[2 * lengths <= capacity]:
        big = lengths > capacity - small
        half = (2 * lengths > capacity) & ~big
        rest = (lengths >= small) & (2 * lengths <= capacity)
        room = int(number[half].sum()) * capacity - int((number * lengths)[half].sum())
        over = int((number * lengths)[rest].sum()) - room
        best = max(best, int(number[big].sum() + number[half].sum()) + max(0, -(-over // capacity)))
    return max(best, sum(n for k, n in counts.items() if 2 * k > capacity))


def dominates(a: Filling, b: Filling) -> bool:
    """Whether the pieces of ``b`` fit inside those of ``a``, several to one."""
    rooms = sorted((k for k, n in a for _ in range(n)), reverse=True)
    for k, n in b:
        for _ in range(n):
            fits = [i for i, r in enumerate(rooms) if r >= k]
            if not fits:
                return False
            rooms[min(fits, key=rooms.__getitem__)] -= k
    return True


def fillings(counts: dict[int, int], room: int, waste_left: int, width: int = 6, effort: int = 500) -> list[Filling]:
    """Undominated fillings of ``room`` that waste ``waste_left`` at most, the
    best-fitting first; the best fit is always among them.  ``width`` fillings
    are kept and ``effort`` steps taken."""
    lengths = sorted(k for k, n in counts.items() if n and k <= room)
    if not lengths:
        return [()]
    if lengths[-1] == room:
        return [((room, 1),)]   # one piece that fills it dominates all others
    found: dict[Filling, int] = {}
    steps = exact = 0
    stack: list[tuple[int, int, Filling]] = [(room, len(lengths) - 1, ())]
    while stack and steps < effort and exact < width:
        left, top, used = stack.pop()
        steps += 1
        top = min(top, bisect_right(lengths, left) - 1)
        # the longest piece that still fits and is left, at or below `top`
        while top >= 0 and used and lengths[top] == used[-1][0] and used[-1][1] >= counts[lengths[top]]:
            top -= 1
        if top < 0:
            taken = dict(used)
            smallest = next((k for k in lengths[:bisect_right(lengths, left)] if counts[k] > taken.get(k, 0)), None)
            if smallest is None and (left <= waste_left or not found):
                exact += not left and used not in found
                found[used] = left
            continue
        k = lengths[top]
        stack.append((left, top - 1, used))          # without this length
        more = (*used[:-1], (k, used[-1][1] + 1)) if used and used[-1][0] == k else (*used, (k, 1))
        stack.append((left - k, top, more))          # with one more piece of it
    ranked = sorted(found, key=lambda f: (found[f], [(-k, -n) for k, n in f]))
    keep: list[Filling] = []
    for f in ranked:
        if not any(dominates(g, f) for g in keep):
            keep.append(f)
        if len(keep) == width:
            break
    return keep or [_best_fit(counts, room)]


def _best_fit(counts: dict[int, int], room: int) -> Filling:
    out: Counter[int] = Counter()
    for k in sorted(counts, reverse=True):
        n = min(counts[k], room // k)
        if n:
            out[k] += n
            room -= n * k
    return tuple(out.items())


def solve(counts: dict[int, int], capacity: int, max_nodes: int = 1_500) -> list[tuple[Filling, int]]:
    """Kinds of sequences and how often each is used, holding every piece."""
    counts = {k: n for k, n in counts.items() if n}
    total, bound = sum(k * n for k, n in counts.items()), lower_bound(counts, capacity)
    best: list[tuple[Filling, int]] | None = None
    best_n = sum(counts.values()) + 1
    plan: list[tuple[Filling, int]] = []
    used = wasted = nodes = 0
    # one frame per open choice: longest piece, fillings still to try, whether one
    # is in force, and the first one while the others have not been looked for
    stack: list[list] = []

    def undo() -> None:
        nonlocal used, wasted
        kind, times = plan.pop()
        used -= times
        wasted -= times * (capacity - sum(k * n for k, n in kind))
        for k, n in kind:
            counts[k] = counts.get(k, 0) + n * times

    descend = True
    while True:
        if descend:
            nodes += 1
            allowed = (best_n - 1) * capacity - total - wasted
            longest = max((k for k, n in counts.items() if n), default=None)
            if longest is None:
                if best is None:
                    nodes = 0   # the search for better ones starts here
                if used < best_n:
                    best, best_n = list(plan), used
                descend = False
                continue
            if allowed < 0:
                descend = False
                continue
            counts[longest] -= 1
            options = fillings(counts, capacity - longest, allowed, width=1)
            counts[longest] += 1
            stack.append([longest, options, False, options[0]])
        if best_n <= bound or nodes >= max_nodes and best is not None or not stack:
            return best or []
        longest, options, in_force, first = stack[-1]
        if in_force:
            undo()
            stack[-1][2] = False
            if first is not None:   # back here for the first time: look for the other fillings
                counts[longest] -= 1
                allowed = (best_n - 1) * capacity - total - wasted
                options[:] = [f for f in fillings(counts, capacity - longest, allowed)[::-1] if f != first]
                counts[longest] += 1
                stack[-1][3] = None
        if not options:
            stack.pop()
            descend = False
            continue
        kind = Counter({longest: 1})
        for k, n in options.pop():
            kind[k] += n
        times = min(counts[k] // n for k, n in kind.items())
        filling = tuple(sorted(kind.items(), reverse=True))
        for k, n in filling:
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
        plan.append((filling, times))
        used += times
        wasted += times * (capacity - sum(k * n for k, n in filling))
        stack[-1][2] = True
        descend = True


def slots(plan: list[tuple[Filling, int]]) -> np.ndarray:
    """Rows (length, first rank, end rank, per sequence, first sequence, offset),
    sorted: which ranks of a length go to which sequences."""
    taken: Counter[int] = Counter()
    rows, sequence = [], 0
    for kind, times in plan:
        offset = 0
        for k, n in kind:
            rows.append((k, taken[k], taken[k] + n * times, n, sequence, offset))
            taken[k] += n * times
            offset += n * k
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


# ------------------------------------------------------------------ on Spark
_PIECES = pa.schema([(n, pa.int64()) for n in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "rank")])
_DDL = ", ".join(f"{f.name} long" for f in _PIECES)


def pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer_path: str | None = None,
           cache_chunks: int = 500_000, keep_cache: bool = True) -> DataFrame:
    """One row per piece, with its task (part) and its rank among the pieces of
    its length in that task.  ``cache_chunks`` bounds a worker's token cache,
    which lasts from task to task unless ``keep_cache`` is false."""
    spark = docs.sparkSession
    prepare(spark)
    spec = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, seen = library_ids(spec.value, cache_chunks), TaskContext.get().partitionId(), Counter()
        for doc_ids, texts in text_slices(batches, ("doc_id",)):
            rows = []
            for doc_id, text in zip(doc_ids, texts, strict=True):
                ids = cache.packed(text) + end
                for i, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, i, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), part, seen[n]))
                    seen[n] += 1
            yield record_batch(dict(zip(_PIECES.names, zip(*rows, strict=True), strict=True)), _PIECES)

    def emptied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from released(run, library_ids(spec.value, cache_chunks))(batches)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run if keep_cache else emptied, _DDL)


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer_path: str | None = None,
         cache_chunks: int = 500_000, keep_cache: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    spark = docs.sparkSession
    table = written(pieces(docs, capacity, end_id, tokenizer_path, cache_chunks, keep_cache), "pieces")
    # pieces of a length in each task, and how many of them lie in tasks before
    counts = written(table.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()   # `capacity` rows at most
    plan = slots(solve({r["length"]: r["n"] for r in histogram}, capacity))
    ranked = table.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    return place(ranked, plan)


def place(ranked: DataFrame, plan: np.ndarray) -> DataFrame:
    """Look up every piece's sequence and offset from its length and rank."""
    sent = ranked.sparkSession.sparkContext.broadcast(plan)   # at most sqrt(2 capacity) rows per kind
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    schema = pa.schema([(n, pa.int32() if n == "piece" else pa.int64()) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        reach = int(p[:, 2].max()) + 1 if len(p) else 1
        keys = p[:, 0].astype(object) * reach + p[:, 1] if len(p) and int(p[:, 0].max()) * reach >= 2**62 \
            else p[:, 0] * reach + p[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(n)) for n in ("length", "rank"))
            at = p[np.searchsorted(keys, length * reach + rank, side="right") - 1]
            index = rank - at[:, 1]
            cols = {n: batch.column(n) for n in names[:5]}
            cols["piece"] = cols["piece"].cast(pa.int32())
            yield record_batch(cols | {"sequence_id": at[:, 4] + index // at[:, 3],
                                       "offset": at[:, 5] + index % at[:, 3] * length}, schema)

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")
