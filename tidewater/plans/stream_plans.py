"""Registered plans that run a stream to its end and read what it left.

The input is first written as a log or as files, which the jobs of
``streaming.jobs`` then read in several batches; state comes from the queries'
checkpoints.  Everything is written below the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans.common import EVENTS_AS_OF, t, ts_text
from tidewater.plans.events_plans import bus_events
from tidewater.session import scratch_path, shuffles_freed
from tidewater.sources.shards import append_records, drain, read_shards
from tidewater.sources.stream import envelopes_from_events
from tidewater.streaming import jobs, stateful


def _fresh(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"{label}-{uuid.uuid4().hex}")


def _segment(n: int) -> int:
    """Records of a segment: 32 segments or so, none so long that it fills a task."""
    return min(max(100, -(-n // 32)), 100_000)


def _log(spark: SparkSession, sf_dir: str, label: str, shard: Column, delivered: Column | None = None) -> tuple[str, int]:
    """The events as a record log, in order of delivery; its folder and its records."""
    rows = t(spark, sf_dir, "events")
    env = envelopes_from_events(rows.withColumn("event_id", delivered) if delivered is not None else rows)
    root = f"{_fresh(spark, label)}/log"
    n = rows.count()
    append_records(env, root, shard, _segment(n))
    return root, n


def stream_record_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + A1: metrics of a two-shard log read in batches of a sixth of its
    records at most, added up; ``over`` counts batches beyond that bound."""
    root, n = _log(spark, sf_dir, "record-metrics", F.pmod(F.col("partitionKey").cast("long"), F.lit(2)))
    base, bound = root.removesuffix("/log"), -(-n // 6)
    drain(jobs.start_record_stream(spark, root, f"{base}/out", f"{base}/checkpoint", EVENTS_AS_OF, bound, "earliest",
                                   {"processingTime": "0 seconds"}))
    rows = spark.read.parquet(f"{base}/out/metrics")
    over = rows.groupBy("batch_id").agg(F.sum("count").alias("n")).where(F.col("n") > bound).agg(F.count("*").alias("over"))
    # Exact sums of a batch have at most 8 decimals, so they add up exactly as decimals.
    sums = rows.groupBy("partition_key").agg(F.sum("count").alias("count"), F.sum(F.col("total_value").cast("decimal(28,8)")).alias("total"))
    return sums.crossJoin(F.broadcast(over)).select("partition_key", "count", F.col("total").cast("double").alias("total_value"), "over")


#: Every 25th event is delivered late, by a quarter of all events; every 10th once more, at the end.
_LATE, _AGAIN = 25, 10


def windowed_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows per key that a watermark of two days has closed, over a
    log with late and redelivered records, read in eight batches."""
    n = t(spark, sf_dir, "events").count()
    place = F.col("event_id") + F.when(F.col("event_id") % _LATE == 3, n // 4).otherwise(0)
    delivered = place * 10 + F.when(F.col("event_id") % _LATE == 3, 1).otherwise(0)
    root, n = _log(spark, sf_dir, "windows", F.lit(0), delivered)
    base = root.removesuffix("/log")
    again = t(spark, sf_dir, "events").where(F.col("event_id") % _AGAIN == 0)
    append_records(envelopes_from_events(again.withColumn("event_id", delivered)), root, F.lit(0), _segment(n))
    stateful.use_state_store(spark)
    env = read_shards(spark, root, f"{base}/checkpoint", -(-n // 7), "earliest")
    out = jobs.windowed_stream(env, "1 day", "2 days")
    drain(jobs._start_changes(out, f"{base}/out", f"{base}/checkpoint", {"processingTime": "0 seconds"}, "append"))
    rows = spark.read.parquet(f"{base}/out")
    return rows.select(ts_text("window_start").alias("window_start"), ts_text("window_end").alias("window_end"),
                       F.col("partitionKey").alias("partition_key"), "count", "total_value")


def _place(seq: Column) -> Column:
    """A sequence of the bus as sortable text."""
    return F.concat_ws("/", F.date_format(seq["t"], "yyyyMMddHHmmss"), seq["phase"].cast("string"),
                       F.lpad(seq["k"].cast("string"), 19, "0"), F.lpad(seq["line"].cast("string"), 9, "0"))


def _bus(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, DataFrame]:
    """The bus as a stream of files, three in eight a batch, which go when theirs is
    done; its sequence as sortable text."""
    root = _fresh(spark, label)
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    events = bus_events(spark, sf_dir, lambda rows, seq: rows.repartition(n, _place(seq)))
    with shuffles_freed(spark):
        events.select("event", _place(F.col("seq")).alias("seq")).write.option("compression", "zstd").parquet(f"{root}/bus")
    files = spark.readStream.schema("event variant, seq string").options(maxFilesPerTrigger=-(-n * 3 // 8), cleanSource="delete")
    return root, files.parquet(f"{root}/bus")


def order_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order state of a stream of bus events in any order, read from its state store."""
    root, bus = _bus(spark, sf_dir, "orders")
    jobs.start_order_stream(spark, bus, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    st = jobs.order_state(spark, f"{root}/checkpoint")
    return st.select("order_id", "status", "customer_id", F.size("items").alias("n_items"), F.col("total").cast("double").alias("total"), "created_at")


def inventory_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory state of the same stream."""
    root, bus = _bus(spark, sf_dir, "inventory")
    jobs.start_inventory_stream(spark, bus, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    st = jobs.inventory_state(spark, f"{root}/checkpoint")
    return st.select("item_id", F.col("quantity").cast("double").alias("quantity"), "updated_at")


def chat_presence_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: presence at the clock from a stream that was stopped and started
    again every ten days; a row a room, and the connections that timers ended."""
    from tidewater.plans.chat_plans import _marks_and_clicks

    marks, _ = _marks_and_clicks(spark, sf_dir)
    marks = marks.where(F.col("ts") <= F.lit(EVENTS_AS_OF).cast("timestamp_ntz"))
    root = _fresh(spark, "presence")
    for first, last in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")):
        within = (F.col("ts") >= F.lit(first).cast("timestamp_ntz")) & (F.col("ts") < F.lit(last).cast("timestamp_ntz"))
        marks.where(within).write.mode("append").parquet(f"{root}/marks")
        source = spark.readStream.schema(marks.schema).parquet(f"{root}/marks")
        jobs.start_presence_stream(spark, source, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return stateful.present_at(spark, f"{root}/checkpoint", EVENTS_AS_OF)
