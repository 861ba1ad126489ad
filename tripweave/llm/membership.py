"""A broadcast filter of row keys, sized from their number up to a fixed bound.

A join with few keys then need not shuffle every text: rows the filter turns
away cannot match.  Beyond the bound it lets more rows through, never fewer."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 ** 27 bits are 16 MB when sent.
MAX_BITS = 27
_PAGE = 1 << 15


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)


def maybe_in(keys: DataFrame, column: str) -> Column:
    """Holds for every value of the long ``column`` that ``keys`` has, and for few
    others.  Pages of the filter are made in the tasks and joined on the way."""
    n = keys.count()
    bits = min(MAX_BITS, max(15, int(n * 16).bit_length()))
    schema = pa.schema([("page", pa.int64()), ("bits", pa.binary())])

    def pages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = _place(np.asarray(batch.column(0)), bits)
            for page in np.unique(at // _PAGE).tolist():
                held.setdefault(page, np.zeros(_PAGE, bool))[at[at // _PAGE == page] % _PAGE] = True
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int64()), pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary())],
                schema=schema)

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        out = np.zeros(_PAGE // 8, np.uint8)
        for b in table.column("bits").to_pylist():
            out |= np.frombuffer(b, np.uint8)
        return pa.table({"page": [key[0].as_py()], "bits": [out.tobytes()]}, schema=schema)

    made = (keys.select(F.col(column).cast("long").alias("key")).mapInArrow(pages, "page long, bits binary")
            .groupBy("page").applyInArrow(merged, "page long, bits binary"))
    full = np.zeros((1 << bits) // 8, np.uint8)
    for row in made.toLocalIterator():     # 2 ** bits / 8 bytes at most
        at = row["page"] * (_PAGE // 8)
        full[at:at + _PAGE // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    sent = keys.sparkSession.sparkContext.broadcast(full)

    def maybe(key: pd.Series) -> pd.Series:
        at = _place(key.to_numpy(), bits)
        return pd.Series((sent.value[at >> 3] >> (7 - (at & 7))) & 1 == 1)

    return F.pandas_udf(maybe, "boolean")(F.col(column))
