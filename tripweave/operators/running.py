"""Running aggregates per key where one key may hold any share of the rows.

A window over the key alone would sort such a key in one task.  Here the rows
are range-partitioned by key and order, so a hot key spreads over consecutive
pieces; each piece runs its own window, and what the earlier pieces of a key hold
is added from a table of one row per key and piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import scratch_path

_JOIN = {"sum": lambda a, b: a + b, "xor": lambda a, b: a.bitwiseXOR(b)}
_AGG = {"sum": F.sum, "xor": F.bit_xor}


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends
    there, and a lost executor never repeats the work before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return read_back(df, path)


def read_back(df: DataFrame, path: str) -> DataFrame:
    """What ``df`` wrote to ``path``, whose schema is known, so that a table
    without rows or files is read too."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(df: DataFrame, key: Sequence[str], order: Sequence[str | Column],
            values: dict[str, tuple[str, Column]]) -> DataFrame:
    """``df`` with a column per entry of ``values``, name -> (``sum`` or ``xor``,
    a never-null long): the aggregate over the rows of the same key up to and
    with this one, by ``order`` (column names, nulls first, or sort expressions).
    Rows that tie in ``order`` take turns in no defined order, so ties must be
    interchangeable to the caller."""
    # the last column parts rows that are equal in all others, which no range could
    spread = (df.select("*", *[v.alias(f"_v_{n}") for n, (_, v) in values.items()])
              .withColumn("_tie", F.monotonically_increasing_id()))
    rows = written(spread.repartitionByRange(*key, *order, "_tie").withColumn("_piece", F.spark_partition_id()), "ranged")
    within = (Window.partitionBy(*key, "_piece").orderBy(*order, "_tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = rows.select("*", *[_AGG[how](f"_v_{n}").over(within).alias(n) for n, (how, _) in values.items()])
    earlier = Window.partitionBy(*key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*key, "_piece").agg(*[_AGG[how](f"_v_{n}").alias(n) for n, (how, _) in values.items()])
    # a row for each piece of a key but its first: fewer than there are pieces
    before = (totals.select(*key, "_piece", F.row_number().over(Window.partitionBy(*key).orderBy("_piece")).alias("_at"),
                            *[_AGG[how](n).over(earlier).alias(f"_b_{n}") for n, (how, _) in values.items()])
              .filter("_at > 1").drop("_at"))
    return (local.join(before, [*key, "_piece"], "left")
            .select(*df.columns, *[_JOIN[how](F.col(n), F.coalesce(F.col(f"_b_{n}"), F.lit(0))).alias(n)
                                   for n, (how, _) in values.items()]))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "row_rank") -> DataFrame:
    """``df`` with its place in the total ``order``, from 1: places within range
    partitions plus the sizes of those before, so no task sorts all rows and the
    order outlives any later shuffle or write.  Rows equal in all of ``order`` must
    be equal in all columns."""
    return running(df, [], order, {name: ("sum", F.lit(1).cast("bigint"))})
