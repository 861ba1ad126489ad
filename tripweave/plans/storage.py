"""File-system operations on the cluster's storage (HDFS, object stores, local)
through Hadoop's FileSystem API, as any Spark job does for housekeeping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    """Recursive delete; a missing path is not an error."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def last_modified(spark: SparkSession, path: str) -> dt.datetime:
    """Time of the newest file under ``path``, or of the folder if it has none."""
    fs, p = _fs(spark, path)
    newest = fs.getFileStatus(p).getModificationTime()
    files = fs.listFiles(p, True)
    first = True
    while files.hasNext():
        at = files.next().getModificationTime()
        newest, first = at if first else max(newest, at), False
    return dt.datetime.fromtimestamp(newest / 1000, dt.timezone.utc)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()]
