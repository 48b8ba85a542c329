"""Structured Streaming jobs.

Every ``foreachBatch`` handler is idempotent per batch id: outputs are
written under ``batch_id=<n>`` with overwrite, so a batch retried after an
executor or driver loss rewrites the same files.  State between batches is in
Spark's state store (``stateful``), checkpointed with the query.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators import events, lake, metrics
from tidewater.session import shuffles_freed
from tidewater.sources.shards import MAX_RECORDS, read_shards
from tidewater.sources.stream import read_stream
from tidewater.streaming import stateful


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


# ---------------------------------------------------------------- I1


Clock = str | datetime | Callable[[], datetime]


def batch_clock(as_of: Clock):
    """The clock of one batch: a fixed value, or what a callable returns now."""
    return as_of() if callable(as_of) else as_of


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def metrics_batch_handler(out_root: str, as_of: Clock = utc_now):
    """Per micro-batch -- decode once (cached), archive valid records,
    quarantine the rest, store one metric row per key for the batch.  A
    retried batch replaces its own files."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = metrics.decode_records(batch).persist()
        try:
            ok, bad = metrics.split_records(decoded)
            metrics.write_archive(metrics.archive_layout(ok), f"{out_root}/archive", batch_id)
            bad.select("data", "partitionKey", "sequenceNumber", "reasons").write.mode("overwrite").parquet(
                f"{out_root}/quarantine/batch_id={batch_id}")
            metrics.batch_metrics(decoded, batch_clock(as_of)).write.mode("overwrite").parquet(
                f"{out_root}/metrics/batch_id={batch_id}")
        finally:
            decoded.unpersist()
    return handle


def start_metrics_stream(spark: SparkSession, source: str, out_root: str, checkpoint: str,
                         as_of: Clock = utc_now, max_files: int | None = None,
                         trigger: dict | None = None) -> StreamingQuery:
    env = read_stream(spark, source, max_files=max_files)
    w = env.writeStream.foreachBatch(metrics_batch_handler(out_root, as_of)).option(
        "checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


#: A live job's trigger.
EVERY_5_S = {"processingTime": "5 seconds"}


def start_record_stream(spark: SparkSession, log: str, out_root: str, checkpoint: str, as_of: Clock = utc_now,
                        max_records: int = MAX_RECORDS, starting: str = "latest", trigger: dict | None = None) -> StreamingQuery:
    """I1 over a sharded record log: batches of ``max_records`` at most, every
    five seconds, from the end of the log on."""
    env = read_shards(spark, log, checkpoint, max_records, starting)
    w = env.writeStream.foreachBatch(metrics_batch_handler(out_root, as_of)).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger or EVERY_5_S).start()


# ---------------------------------------------------------------- I5


def windowed_stream(env: DataFrame, width: str, watermark: str) -> DataFrame:
    """Redelivered records removed within the watermark, then event-time
    windows per key.  Arrival time is cast to TIMESTAMP (a watermark needs
    it; TIMESTAMP_NTZ is rejected)."""
    d = metrics.decode_records(env).filter(F.col("decode_error").isNull())
    d = d.withColumn("arrival_ts", F.col("arrival").cast("timestamp"))
    d = d.withWatermark("arrival_ts", watermark).dropDuplicatesWithinWatermark(["partitionKey", "sequenceNumber"])
    return metrics.windowed_metrics(d, "arrival_ts", "partitionKey", "value_num", width)


# ---------------------------------------------------------------- I2


def start_file_ingest(spark: SparkSession, landing: str, processed: str, checkpoint: str,
                      as_of: Clock = utc_now, suffix: str = "*", trigger: dict | None = None) -> StreamingQuery:
    """New files under the landing prefix -> processed zone, in the layout
    of ``lake.write_processed`` (one catalog covers batches and streams)."""
    files = (spark.readStream.format("text").option("wholetext", True)
             .option("pathGlobFilter", suffix).option("recursiveFileLookup", True).load(landing)
             .select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("body")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        lake.write_processed(lake.ingest(batch, batch_clock(as_of)), processed, batch_id)

    w = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


# ---------------------------------------------------------------- I3 / I6


def routed_events(spark: SparkSession, bus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deliveries of bus events ``(event, seq)``, and rejected events with their reasons."""
    norm, bad = events.normalise(bus)
    known, unfit = events.split_events(events.parse_detail(norm))
    rejected = (bad.select(F.to_json(F.struct("_el")).alias("row"), "reasons")
                .unionByName(unfit.select(F.to_json("event").alias("row"), "reasons")))
    return events.route(known, events.rules_frame(spark)), rejected


def order_changes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Change rows for ``stateful.order_stream``, and those without an order."""
    ok, bad = events.order_changes(routed.filter(F.col("target") == "order_processor"))
    return ok.withColumns({"items": F.to_json("items"), "total": F.col("total").cast("string")}), bad


def inventory_changes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Change rows for ``stateful.inventory_stream``, and those without an item."""
    ok, bad = events.inventory_changes(routed.filter(F.col("target") == "inventory_processor"))
    return ok.withColumn("quantity", F.col("quantity").cast("string")), bad


def start_order_stream(spark: SparkSession, bus: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Order state kept in the state store; each batch writes the orders it changed."""
    changes, _ = order_changes(routed_events(spark, bus)[0])
    return _start_changes(stateful.order_stream(changes), f"{out_root}/orders", checkpoint, trigger)


def start_inventory_stream(spark: SparkSession, bus: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The same for inventory."""
    changes, _ = inventory_changes(routed_events(spark, bus)[0])
    return _start_changes(stateful.inventory_stream(changes), f"{out_root}/inventory", checkpoint, trigger)


def _start_changes(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None, mode: str = "update") -> StreamingQuery:
    stateful.use_state_store(rows.sparkSession)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch_id={batch_id}")

    with shuffles_freed(rows.sparkSession):
        return _trigger(rows.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint), trigger).start()


def order_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows of ``events.fold_orders``, from the state of an order stream."""
    s = stateful.order_table(spark, checkpoint)
    return s.select("order_id", "status", "customer_id", F.from_json("items", events.ITEMS).alias("items"),
                    F.col("total").cast(events.AMOUNT).alias("total"), "created_at")


def inventory_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows of ``events.fold_latest`` by item, from the state of an inventory stream."""
    s = stateful.inventory_table(spark, checkpoint)
    return s.select("item_id", F.col("quantity").cast(events.AMOUNT).alias("quantity"), "updated_at")


def outbox_batch_handler(spark: SparkSession, out_root: str):
    """One batch of bus events gives two outputs, the orders' notifications
    and the rejected events; a retried batch replaces its own files."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            routed, rejected = routed_events(spark, kept)
            ord_changes, no_order = order_changes(routed)
            _, no_item = inventory_changes(routed)
            for bad, cols in ((no_order, ["order_id", "kind", "seq"]), (no_item, ["item_id", "seq"])):
                rejected = rejected.unionByName(bad.select(F.to_json(F.struct(*cols)).alias("row"), "reasons"))
            rejected.write.mode("overwrite").parquet(f"{out_root}/quarantine/batch_id={batch_id}")
            events.order_outbox(ord_changes).select("subject", "message").write.mode("overwrite").parquet(
                f"{out_root}/outbox/batch_id={batch_id}")
        finally:
            kept.unpersist()
    return handle


# ---------------------------------------------------------------- I4


def start_presence_stream(spark: SparkSession, marks: DataFrame, out_root: str, checkpoint: str,
                          delay: str = "1 hour", trigger: dict | None = None) -> StreamingQuery:
    """I4: connects, disconnects and expiries as they happen; live connections in the state store."""
    stateful.use_state_store(spark)
    return _start_changes(stateful.presence_stream(marks, delay), f"{out_root}/presence", checkpoint, trigger, "append")
