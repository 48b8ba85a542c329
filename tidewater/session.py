"""Session construction and cluster-facing settings.

On a cluster the session is created by the platform; ``build_session`` only
fills settings that are unset, so cluster defaults (shuffle partitions,
checkpoint directory, memory) always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  They are applied with "set if unset"
# semantics so a cluster configuration is never overridden.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition counts as skewed once it is 4x the median and over Spark's
    # own size limit; AQE then splits it and replicates the matching side.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Partition values such as month=01 stay strings ("01"), not ints.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Get or create a session with the library's defaults.

    ``master`` and ``shuffle_partitions`` are meant for local runs and
    tests; on a cluster leave them ``None``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply SQL defaults to an existing session where they are unset."""
    for key, value in _DEFAULTS.items():
        if key.startswith("spark.ui") or key.startswith("spark.sql.execution.arrow"):
            continue
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    # The library's date logic is written against UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir``; only when the session has none (a
    local test) is a private folder created and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within this, a write's shuffle files go when it ends, and those of a stream that is
    started after each batch; Spark keeps them until the driver collects its garbage."""
    was = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, was)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, for a frame
    that is costly to make and used more than once."""
    path = scratch_path(df.sparkSession, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for job-owned tables."""
    return os.path.join(checkpoint_dir(spark), *parts)
