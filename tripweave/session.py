"""Session construction and the shared scratch location.

Work files (CSV round trips, staged tables, stream checkpoints) go under the
folder the cluster names in ``spark.checkpoint.dir``.  Only a local-mode
session (tests, a laptop) with none set gets a folder of our own; on a
cluster a machine-local folder would not be shared by the executors, so an
unset setting is an error there.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on.  Session time zone is UTC so
# that hour and day buckets of timestamp_ntz columns never shift.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffle outputs by size (advisory 64 MB), not to keep
    # many tiny tasks: the shuffles here carry partial states and are small
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "tripweave",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


class CheckpointDirMissing(RuntimeError):
    """A cluster session without ``spark.checkpoint.dir``."""


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a local one only for a
    local-mode session where none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise CheckpointDirMissing(
                "set spark.checkpoint.dir to a folder on shared storage (HDFS, object store): "
                "work files and stream checkpoints must be visible to every executor")
        configured = tempfile.mkdtemp(prefix="tripweave-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tripweave-{name}-{uuid.uuid4().hex[:12]}"
