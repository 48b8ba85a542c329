"""Spark helpers of the corpus operators: shared tables, bounded sums."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can read, so a lost
    executor costs only the tasks that were running on it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables of ``materialise`` that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    release_finished(frames[0].sparkSession)


BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of ``BATCH_BYTES`` or less (one row, if it
    is longer), so long texts don't multiply by the rows of a batch."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().rstrip("b")
    scale = {"k": 10, "m": 20, "g": 30}.get(now[-1:], 0)
    size = int(now.rstrip("kmg")) << scale
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def release_finished(spark: SparkSession) -> None:
    """Let the driver drop the shuffle files of frames nobody refers to.

    Spark removes them when the driver's JVM notices; between two steps of a
    long job it has no other reason to look.  What the first look finalises,
    the second one finds unreferenced.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


SUM_SCHEMA = "slot int, part int, data binary"
_SLOT_BYTES = 1 << 16
_FAN_IN = 64


def array_rows(array: np.ndarray, part: int) -> pa.RecordBatch:
    """One task's array cut into slots, as rows for ``sum_arrays``."""
    raw = np.ascontiguousarray(array, dtype=np.float64).tobytes()
    slots = [raw[i:i + _SLOT_BYTES] for i in range(0, len(raw), _SLOT_BYTES)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(slots)), pa.int32()), pa.array([part % _FAN_IN] * len(slots), pa.int32()),
         pa.array(slots, pa.binary())], names=["slot", "part", "data"])


def _sum_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for slot, part, data in zip(*(c.to_pylist() for c in batch.columns)):
            value = np.frombuffer(data, np.float64)
            have = sums.get((slot, part))
            sums[slot, part] = value.copy() if have is None else have + value
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums], pa.int32()), pa.array([0] * len(sums), pa.int32()),
             pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["slot", "part", "data"])


def sum_arrays(rows: DataFrame, size: int) -> np.ndarray:
    """Element-wise sum of every task's array of ``size`` numbers.

    Two shuffled rounds, so no task adds up more than a share of the slots;
    only the total, whose size is fixed, comes to the driver.
    """
    first = rows.repartition("slot", "part").mapInArrow(_sum_slots, SUM_SCHEMA)
    total = np.zeros(size, np.float64)
    parts: dict[int, np.ndarray] = {}
    for r in first.repartition("slot").mapInArrow(_sum_slots, SUM_SCHEMA).toLocalIterator():
        have = parts.get(r.slot)
        value = np.frombuffer(bytes(r.data), np.float64)
        parts[r.slot] = value if have is None else have + value
    for slot, value in parts.items():
        at = slot * (_SLOT_BYTES // 8)
        total[at:at + len(value)] = value
    return total


def keyed_hash(*cols: str) -> F.Column:
    """A row key that tells rows of equal id and different text apart."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in cols])


def free_prefix(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores before it until no column of ``df`` begins so."""
    while any(c.lower().startswith(stem) for c in df.columns):
        stem = "_" + stem
    return stem


def one_text_each(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """The picked rows (_id and more) with the text of that id in ``docs``.

    Where an id is repeated, one of its texts counts, that of lowest hash; so there
    are no more rows than were picked.
    """
    extra = [c for c in picked.columns if c != "_id"]
    found = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(picked), "_id")
    lowest = F.struct(F.xxhash64("text").alias("hash"), "text")
    return found.groupBy("_id", *extra).agg(F.min(lowest).alias("_low")).select("_id", *extra, F.col("_low.text").alias("text"))


def crc_mod(col: str, n: int) -> F.Column:
    """crc32 of the id's text modulo n (null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A ``mapInArrow`` function from one that maps a single batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return run
