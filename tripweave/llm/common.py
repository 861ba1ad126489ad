"""Helpers shared by the operators: table access, written intermediates, Arrow batches."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.running import written  # noqa: F401 - for the operators
from tripweave.plans import storage
from tripweave.session import scratch_path

#: Rows of one Arrow batch at most.  Texts are long, so batches stay short; the
#: Python side works through a batch in slices of about ``SLICE_CHARS``.
BATCH_ROWS = 1000
SLICE_CHARS = 250_000

#: Words: runs of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_ROWS`` rows (never raises a lower setting),
    and send this package's source to the executors, as ``--py-files`` would."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted((root / "tripweave").rglob("*.py")):
            z.write(p, p.relative_to(root))
    target = sc._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "code") + ".zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target.toString())
    _SHIPPED.add(sc.applicationId)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``written`` that no later step reads."""
    storage.delete(df.sparkSession, df.inputFiles()[0].rpartition("/")[0]) if df.inputFiles() else None


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``divisor`` (null id: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def text_slices(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], text: str = "text",
                chars: int = SLICE_CHARS) -> Iterator[tuple[list, ...]]:
    """Columns ``keys`` and then ``text`` (null: None) of consecutive rows,
    about ``chars`` characters at a time."""
    for batch in batches:
        texts = batch.column(text).to_pylist()
        others = [batch.column(k).to_pylist() for k in keys]
        start = size = 0
        for i, t in enumerate(texts):
            size += len(t) if t else 0
            if size >= chars or i + 1 == len(texts):
                yield (*(o[start:i + 1] for o in others), texts[start:i + 1])
                start, size = i + 1, 0


def give_back() -> None:
    """Return freed memory of this worker process to the system: it outlives the
    task, and the next stage needs the memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # of the GNU C library alone
    if trim is not None:
        trim(0)


def released(run: Callable, *caches: dict) -> Callable:
    """``run`` with ``caches`` emptied and their memory given back when its task ends."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for cache in caches:
                cache.clear()
            give_back()

    return task


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
