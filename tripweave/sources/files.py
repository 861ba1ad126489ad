"""File sources.

Every reader returns a lazy DataFrame: Spark expands globs on any Hadoop
file system (no driver-side ``glob``), prunes columns to what the plan uses and
pushes range filters into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripweave.schemas import OBSERVATION_COLUMNS, ZONE_COLUMNS


class InputMissingError(FileNotFoundError):
    """Raised once, naming every required input that does not exist."""


def _as_list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _reader(spark: SparkSession, recursive: bool, glob_filter: str | None,
            merge_schema: bool):
    reader = spark.read
    if recursive:
        # Note that this turns off partition-column discovery.
        reader = reader.option("recursiveFileLookup", "true")
    if glob_filter:
        # File-name pattern, e.g. "*.parquet".
        reader = reader.option("pathGlobFilter", glob_filter)
    if merge_schema:
        # Union of the footers' schemas.
        reader = reader.option("mergeSchema", "true")
    return reader


def read_trips(spark: SparkSession, paths: str | Iterable[str], *,
               recursive: bool = False, glob_filter: str | None = None,
               merge_schema: bool = False,
               schema: StructType | str | None = None) -> DataFrame:
    """Parquet trips from files, globs or directories.

    A pattern that matches nothing is a hard error, reported with the pattern.
    A directory laid out as ``month=YYYY-MM/`` yields a ``month`` column that
    prunes partitions (S7).

    ``schema`` (a ``StructType`` or DDL string) is the read schema for files
    whose column types drifted between months: the Parquet reader widens
    int32 to int64 and float to double per file.  Narrowing, or int64 to
    double, is not widened and fails the read, naming the file.
    """
    paths = _as_list(paths)
    try:
        reader = _reader(spark, recursive, glob_filter, merge_schema)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(*paths)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise InputMissingError(f"no trip files match {paths}") from exc
        raise


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header; every column stays text."""
    return spark.read.option("header", "true").csv(path).select(*ZONE_COLUMNS)


def read_observations(spark: SparkSession, path: str,
                      extra_columns: Iterable[str] = ()) -> DataFrame:
    """Wide hourly-observation CSV; only the used columns are kept.

    No schema inference: every field is text and is typed later by tolerant
    casts.  An empty field and ``""`` both read as NULL.
    """
    cols = list(OBSERVATION_COLUMNS) + [c for c in extra_columns if c not in OBSERVATION_COLUMNS]
    return spark.read.option("header", "true").csv(path).select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def require_inputs(spark: SparkSession, paths: dict[str, str], fmt: dict[str, str] | None = None,
                   recursive: set[str] = frozenset()) -> None:
    """V1: every named input must exist; list all missing ones in one error.
    Inputs named in ``recursive`` are looked for in nested folders too.

    The check opens only file listings (and the first footer or header), not data.
    """
    fmt = fmt or {}
    missing = []
    for name, path in paths.items():
        kind = fmt.get(name, "parquet")
        try:
            if kind == "csv":
                spark.read.option("header", "true").csv(path).schema
            else:
                spark.read.option("recursiveFileLookup", str(name in recursive).lower()).parquet(path).schema
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise   # it is there, but something else is wrong with it
            missing.append(f"{name}: {path}")
    if missing:
        raise InputMissingError("missing required inputs: " + "; ".join(missing))


def infer_schema(spark: SparkSession, path: str, merge: bool = True):
    """Schema from the Parquet footers (union of them when ``merge``).
    Column matching elsewhere is case-insensitive (Spark's default)."""
    return _reader(spark, False, None, merge).parquet(path).schema


def set_split_size(spark: SparkSession, max_bytes: int = 128 * 1024 * 1024) -> None:
    """Input split size.  Only the session setting has an effect; the
    same key given as a reader option is ignored by the Parquet source."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_bytes))
