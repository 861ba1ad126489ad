"""Prefix trie of conversations: ROLLUP over positional turn-id columns.

A conversation is laid out as blocks of ``WIDTH`` turn-id columns, one row per
block.  ``GROUP BY block, key, ROLLUP(t1, ..., tn)`` then aggregates every prefix
of every conversation together: ``grouping_id`` tells the length of the prefix
within its block, and the key names the node at which the block before ended, so
that long conversations go on in further blocks of the same statement.  A node
is named by its depth and two 64-bit hashes, the exclusive or over its turns of
(position, turn id): such a name can be summed up in any order, so that one very
long conversation needs no task of its own.

Sums over subtrees need no walk up the tree.  Every node is represented by its
smallest member; the nodes that a conversation represents are the lower end of
its path.  So a subtree's leaves are those that its members represent, and its
saved tokens are what its members' nodes save, less what the node's own
representative saves above it.  A second ROLLUP adds these up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import prepare, record_batch, written
from tripweave.operators.running import running

#: Turn-id columns of a block.
WIDTH = 8
#: Ids of a piece of a node's list of conversations.
CHUNK = 1024

_NODE = ["depth", "k1", "k2"]


def positions(rows: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, turn): turns of each conversation in order of
    ``turn`` (null first; ties by role and text).  ``turn`` names role and text
    (null: empty) by a digest and the text's bytes.  Rows without conv_id belong
    to no conversation; other columns are ignored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"),
        F.concat(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")),
                 F.lit(":"), F.octet_length(text).cast("string")).alias("turn"),
        role.alias("role"), F.xxhash64(text).alias("text"))
    # equal turns of one number are interchangeable, so ties need no more than a fixed order
    return running(named, ["conv_id"], ["at", "role", "text"], {"pos": ("sum", F.lit(1).cast("long"))}).select(
        "conv_id", "pos", "turn")


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Conversations that branch off: the first h turns of conversation
    ``c - c % group`` as far as it has them, then c's own after its first h;
    ``h = crc32(decimal c) % heads``.  (conv_id, pos, turn); a conversation left
    without turns has one row with null pos."""
    c = F.col("conv_id")
    turns = written(turns, "turns")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", (c - c % group).alias("base"),
        (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"))
    convs = written(convs, "convs")
    has = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    moved = (convs.filter("base <> conv_id").join(has, "base", "left")
             .select("conv_id", "base", "n", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")))
    # at most heads - 1 turns of a base, for at most group - 1 conversations each
    first = turns.filter((c % group == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
    taken = moved.join(first, "base").filter("pos <= taken").select("conv_id", "pos", "turn")
    own = (turns.filter(c % group != 0).join(moved.select("conv_id", "h", "taken"), "conv_id").filter("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn"))
    empty = moved.filter("taken = 0 and n <= h").select(
        "conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("turn"))
    return turns.filter(c % group == 0).unionByName(taken).unionByName(own).unionByName(empty)


def _terms(pos, turn):
    """Two hashes of a turn at its place, 0 without a turn."""
    return (F.when(turn.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(pos, turn)),
            F.when(turn.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(turn, pos, F.lit("b"))))


def _blocks(turns: DataFrame, width: int) -> DataFrame:
    """(conv_id, block, k1, k2, t1..tn): the keys name the node before the block."""
    pos = F.col("pos")
    x1, x2 = _terms(pos, F.col("turn"))
    place = (pos - 1) % width
    rows = turns.select("*", F.floor(F.coalesce(pos - 1, F.lit(0)) / width).cast("long").alias("block"),
                        x1.alias("x1"), x2.alias("x2")).groupBy("conv_id", "block").agg(
        *[F.max(F.when(place == i, F.col("turn"))).alias(f"t{i + 1}") for i in range(width)],
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    done = running(rows, ["conv_id"], ["block"], {"k1": ("xor", F.col("x1")), "k2": ("xor", F.col("x2"))})
    return done.select("conv_id", "block", F.col("k1").bitwiseXOR(F.col("x1")).alias("k1"),
                       F.col("k2").bitwiseXOR(F.col("x2")).alias("k2"), *[f"t{i + 1}" for i in range(width)])


def _rollup(blocks: DataFrame, width: int, aggregates: str) -> DataFrame:
    """Every prefix: its node name, its parent's, its last turn and ``aggregates``.
    A prefix whose last column is null is a shorter conversation met again, and a
    later block's empty prefix is the node before it met again: both go."""
    columns = ", ".join(f"t{i + 1}" for i in range(width))
    found = blocks.sparkSession.sql(
        f"SELECT block, k1, k2, {columns}, {width} - bit_count(grouping_id()) AS level, {aggregates} "
        f"FROM {{blocks}} GROUP BY block, k1, k2, ROLLUP({columns})", blocks=blocks)
    found = found.withColumn("last", F.when(F.col("level") > 0, F.element_at(
        F.array(*[f"t{i + 1}" for i in range(width)]), F.greatest("level", F.lit(1)))))
    found = found.filter("(level = 0 and block = 0) or last is not null")
    terms = [_terms(F.col("block") * width + (i + 1), F.col(f"t{i + 1}")) for i in range(width)]
    end = _terms(F.col("block") * width + F.col("level"), F.col("last"))
    names = []
    for j, k in enumerate(("k1", "k2")):
        whole = F.col(k)
        for t in terms:
            whole = whole.bitwiseXOR(t[j])
        names += [whole.alias(k), whole.bitwiseXOR(end[j]).alias(f"p{k}")]
    own = [c for c in found.columns if c not in {"block", "k1", "k2", "level", *[f"t{i + 1}" for i in range(width)]}]
    return found.select((F.col("block") * width + F.col("level")).alias("depth"), *names, *own)


def _hash_lists(chunks: DataFrame) -> DataFrame:
    """SHA-256 over the chunks of each node, in order, as one stream."""
    schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None
        for batch in batches:
            out = []
            for *key, text in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True):
                if key == node:
                    digest.update(b"," + text.encode())
                else:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(text.encode())
            if out:
                yield record_batch(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)
        if node:
            yield record_batch(dict(zip(schema.names, [[x] for x in (*node, digest.hexdigest())], strict=True)), schema)

    return chunks.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def _ends(turns: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end: their ids,
    ascending, hashed chunk by chunk."""
    x1, x2 = _terms(F.col("pos"), F.col("turn"))
    last = turns.groupBy("conv_id").agg(F.count("pos").alias("depth"), F.bit_xor(x1).alias("k1"), F.bit_xor(x2).alias("k2"))
    numbered = running(last, _NODE, ["conv_id"], {"n": ("sum", F.lit(1).cast("long"))})
    chunks = (numbered.withColumn("chunk", F.floor((F.col("n") - 1) / CHUNK)).groupBy(*_NODE, "chunk")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))
    chunks = written(chunks, "ends")
    # only nodes with more than one chunk need a stream; a row of it is CHUNK ids
    long = chunks.filter("chunk = 1").select(*_NODE)
    short = chunks.join(long, _NODE, "left_anti").select(*_NODE, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    return short.unionByName(_hash_lists(chunks.join(long, _NODE, "left_semi").repartition(*_NODE)
                                         .sortWithinPartitions(*_NODE, "chunk").select(*_NODE, "ids")))


def trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, pos from 1 without gaps, turn as
    ``positions`` names it; a turnless conversation has one row with null pos).

    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.  Without conversations there
    is no row, not even a root."""
    prepare(turns.sparkSession)
    turns = written(turns, "rebuilt")
    blocks = written(_blocks(turns, width), "blocks")
    nodes = written(_rollup(blocks, width, "min(conv_id) AS rep, count(*) AS n_convs").select(
        *_NODE, "pk1", "pk2", "rep", "n_convs",
        ((F.col("n_convs") - 1) * F.coalesce(F.substring_index("last", ":", -1).cast("long"), F.lit(0))).alias("saves")),
        "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pk1").alias("k1"),
                                                 F.col("pk2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, _NODE, "left").na.fill(0, ["n_children"]), "nodes")
    own = nodes.groupBy(F.col("rep").alias("conv_id")).agg(
        F.sum("saves").alias("saves"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    sums = _rollup(blocks.join(own, "conv_id", "left").na.fill(0, ["saves", "leaf"]), width,
                   "sum(saves) AS all_saved, sum(leaf) AS n_leaves").select(*_NODE, "all_saved", "n_leaves")
    # a node with one member saves nothing below it: only shared ones need the sum above them
    shared = nodes.filter("n_convs > 1")
    above = running(shared.select(*_NODE, "rep", "saves"), ["rep"], ["depth"], {"upto": ("sum", F.col("saves"))}).select(
        *_NODE, (F.col("upto") - F.col("saves")).alias("above"))
    # the parent of a node without a sibling member has the same representative
    parents = shared.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"),
                            F.col("rep").alias("parent"))
    return (nodes.join(parents, ["depth", "pk1", "pk2"], "left")
            .join(sums, _NODE, "left").join(above, _NODE, "left").join(_ends(turns), _NODE, "left")
            .select(F.col("rep").alias("conv_id"), "depth",
                    F.when(F.col("depth") > 0, F.coalesce("parent", "rep")).alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", F.when(F.col("n_convs") == 1, F.lit(0)).otherwise(F.col("all_saved") - F.col("above")).cast("long")
                    .alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
