"""A stored table with a key, changed by batches of upserts and deletes.

Rows lie in buckets by the hash of their key.  A batch reads and rewrites only the
buckets that its keys fall into, each as new files under the batch's version; a
manifest a version says which version holds each bucket, so the other buckets'
files stay as they are and older versions stay readable.  A batch that is retried
reads what it read before and replaces its own files.  One writer at a time.

Layout: ``data/v=<version>/_bucket=<b>/``, ``manifest/v=<version>/`` (one JSON line).
Defined results: of several changes of a key the one of highest order counts, the
table's own row is older than any; rows with a null in a key column are a key like
others; a batch without rows makes a version with the same buckets; columns that
only the batch has are null in older rows and the other way round.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.keyed import upsert

BUCKETS = 64


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Versions with a finished manifest, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath() for s in fs.listStatus(path)]
    done = [p.getName() for p in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n[2:]) for n in done if n.startswith("v="))


def manifest(spark: SparkSession, root: str, version: int | None = None, below: int | None = None) -> dict | None:
    """The manifest of a version, or of the newest one (below another)."""
    known = [v for v in versions(spark, root) if (below is None or v < below) and (version is None or v == version)]
    if not known:
        return None
    return json.loads(spark.read.text(f"{root}/manifest/v={known[-1]}").first().value)


def _folders(root: str, found: dict, buckets: Sequence[int] | None = None) -> list[str]:
    return [f"{root}/data/v={v}/_bucket={b}" for b, v in sorted((int(b), v) for b, v in found["held"].items())
            if buckets is None or b in buckets]


def _rows(spark: SparkSession, root: str, found: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(found["schema"])
    folders = _folders(root, found, buckets)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as its newest version, or the one named, left it."""
    found = manifest(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"no such version of the table at {root}")
    return _rows(spark, root, found)


def read_keys(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """The rows of some keys; only their buckets are read."""
    found = manifest(spark, root)
    key = found["key"]
    wanted = keys.select(*key).distinct()
    buckets = [r[0] for r in wanted.select(bucket_of(key, found["buckets"])).distinct().collect()]    # so many at most
    return _rows(spark, root, found, buckets).join(wanted, key, "left_semi")


def apply_batch(changes: DataFrame, root: str, version: int, key: str | Sequence[str], order: str,
                deleted: str | None = None, buckets: int = BUCKETS) -> dict:
    """Upserts a batch as a new version; returns its manifest.

    ``order`` (not stored) says which change of a key is the last; where the boolean
    column ``deleted`` (not stored either) is true, the row goes.  ``buckets`` is
    fixed by the first batch.
    """
    spark = changes.sparkSession
    key = [key] if isinstance(key, str) else list(key)
    if later := [v for v in versions(spark, root) if v > version]:
        raise ValueError(f"version {version} can't be written again: {later[0]} was made from it")
    before = manifest(spark, root, below=version)
    buckets = before["buckets"] if before else buckets
    touched = [r[0] for r in changes.select(bucket_of(key, buckets)).distinct().collect()]    # ``buckets`` at most
    own = [c for c in changes.columns if c != order]
    state = _rows(spark, root, before, touched) if before else spark.createDataFrame([], changes.select(
        *[c for c in own if c != deleted]).schema)
    rows = upsert(state, changes, key, order)
    if deleted:
        rows = rows.where(F.coalesce(F.col(deleted), F.lit(False)) == F.lit(False)).drop(deleted)
    data = f"{root}/data/v={version}"
    # One shuffle by key folds (changes are combined before it), one by bucket makes a file a bucket.
    (rows.withColumn("_bucket", bucket_of(key, buckets)).repartition("_bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_bucket").parquet(data))
    written = spark.read.parquet(data).select("_bucket").distinct().collect() if touched and _has_rows(spark, data) else []
    held = {b: v for b, v in (before["held"] if before else {}).items() if int(b) not in set(touched)}
    held.update({str(int(r[0])): version for r in written})
    made = {"version": version, "key": key, "buckets": buckets, "schema": rows.schema.jsonValue(), "held": held, "touched": sorted(touched)}
    spark.createDataFrame([(json.dumps(made),)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/manifest/v={version}")
    return made


def _has_rows(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return any(s.getPath().getName().startswith("_bucket=") for s in fs.listStatus(path))


def unused(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Folders that none of the newest ``keep`` versions reads: what ``vacuum`` would delete."""
    known = versions(spark, root)
    kept = [manifest(spark, root, v) for v in known[-keep:]]
    held = {f for m in kept for f in _folders(root, m)}
    gone = [f for v in known[:-keep] for f in _folders(root, manifest(spark, root, v)) if f not in held]
    return sorted({*gone, *(f"{root}/manifest/v={v}" for v in known[:-keep])})


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes what ``unused`` lists; run again it finds nothing."""
    folders = unused(spark, root, keep)
    for f in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return folders


def batch_handler(root: str, key: str | Sequence[str], order: str, deleted: str | None = None, buckets: int = BUCKETS):
    """A ``foreachBatch`` function: each batch of a stream is a version."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            apply_batch(kept, root, batch_id, key, order, deleted, buckets)
        finally:
            kept.unpersist()
    return handle
