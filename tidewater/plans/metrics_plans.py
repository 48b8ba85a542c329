"""Registered plans for the keyed-stream metrics application.

Input shape: ``events`` rows become stream envelopes (key = user, sequence =
event id, arrival = event time, payload = ``{sensorId, value, timestamp,
location}``) which then go through the real decoding path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import metrics, quality
from tidewater.plans.common import EVENTS_AS_OF, day_text, t, ts_text
from tidewater.sources.stream import envelopes_from_events


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return metrics.decode_records(envelopes_from_events(events))


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of which 6 in 20, by event id, are broken or extreme: bad
    base64, text after the document, a value too large, a tiny value, an
    arrival time out of range, a value that is no number."""
    events = t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    case = F.col("event_id") % 20
    json = F.concat(F.lit('{"sensorId":"'), F.col("user_id"), F.lit('","value":'),
                    F.when(case == 2, "1e300").when(case == 3, "4e-9").when(case == 5, '"abc"')
                    .otherwise(F.col("value").cast("string")), F.lit("}"))
    text = F.when(case == 1, F.concat(json, F.lit(" junk"))).otherwise(json)
    return events.select(
        F.when(case == 0, "%%%").otherwise(F.base64(F.encode(text, "UTF-8"))).alias("data"),
        F.col("user_id").cast("string").alias("partitionKey"), F.col("event_id").cast("string").alias("sequenceNumber"),
        F.when(case == 4, F.lit(9223372036854775807)).otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).alias("approximateArrivalTimestamp"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records of a dirty stream per reason, and the valid ones."""
    tagged = quality.with_reasons(metrics.decode_records(_dirty(spark, sf_dir)), metrics.record_rules())
    reason = F.when(F.size("reasons") == 0, F.array(F.lit("valid"))).otherwise(
        F.transform("reasons", lambda r: F.when(r == "decode", F.col("decode_error")).when(r == "value", F.col("value_error")).otherwise(r)))
    return tagged.select(F.explode(reason).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def stream_dirty_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 over the dirty stream: bad values count but add nothing."""
    m = metrics.batch_metrics(metrics.decode_records(_dirty(spark, sf_dir)), EVENTS_AS_OF)
    return m.select("partition_key", "count", "total_value", "average_value")


def stream_dirty_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 over the dirty stream."""
    tagged = quality.with_reasons(metrics.decode_records(_dirty(spark, sf_dir)), metrics.record_rules())
    return quality.audit_tagged(tagged, key="partitionKey", counted=F.col("decode_error").isNull())


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + B1 + A1: per-key metrics of one batch holding the whole table."""
    m = metrics.batch_metrics(_decoded(spark, sf_dir), EVENTS_AS_OF)
    return m.withColumns({"first_arrival": ts_text("first_arrival"),
                          "last_arrival": ts_text("last_arrival")})


def stream_metrics_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with arrival-hour batches: one metric row per key per batch."""
    d = _decoded(spark, sf_dir).withColumn("batch_hour", F.date_trunc("hour", "arrival"))
    m = metrics.batch_metrics(d, EVENTS_AS_OF, batch_cols=("batch_hour",))
    return m.withColumns({"batch_hour": ts_text("batch_hour"),
                          "first_arrival": ts_text("first_arrival"),
                          "last_arrival": ts_text("last_arrival")})


def windowed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-day event-time windows per event type."""
    ev = t(spark, sf_dir, "events").select("ts", "event_type", "value")
    w = metrics.windowed_metrics(ev, "ts", "event_type", "value", "1 day")
    return w.withColumns({"window_start": ts_text("window_start"), "window_end": ts_text("window_end")})


def error_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows with at least 5 error events."""
    ev = t(spark, sf_dir, "events").select("ts", "event_type")
    a = metrics.error_alerts(ev, "ts", F.col("event_type") == "error", "1 hour", 5)
    return a.withColumns({"window_start": ts_text("window_start"), "window_end": ts_text("window_end")})


def archive_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: archive layout -- records and key count per arrival-hour folder."""
    ok, _ = metrics.split_records(_decoded(spark, sf_dir))
    arc = metrics.archive_layout(ok)
    return (arc.groupBy("year", "month", "day", "hour")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.count_distinct("partition_key").alias("keys")))


def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed / aggregated / error counts of the metrics run."""
    tagged = quality.with_reasons(_decoded(spark, sf_dir), metrics.record_rules())
    return quality.audit_tagged(tagged, key="partitionKey", counted=F.col("decode_error").isNull())


def metrics_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly metric rows still live (30-day TTL from their arrival
    hour) at the clock; TTL is computed per row from the batch hour."""
    d = _decoded(spark, sf_dir).withColumn("batch_hour", F.date_trunc("hour", "arrival"))
    m = metrics.batch_metrics(d, EVENTS_AS_OF, batch_cols=("batch_hour",))
    m = m.withColumn("ttl", F.unix_seconds(F.col("batch_hour").cast("timestamp")) + F.lit(86400 * metrics.METRICS_TTL_DAYS).cast("long"))
    return (metrics.live(m, "ttl", EVENTS_AS_OF)
            .groupBy("partition_key").agg(F.count(F.lit(1)).alias("live_rows"),
                                          F.sum("count").alias("live_records")))


def archive_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage tier and expiry (60 days) per arrival-day partition."""
    ev = t(spark, sf_dir, "events").select("ts")
    r = metrics.tier_report(ev, "ts", "2024-03-15 00:00:00", expire_days=60)
    return r.withColumn("day", day_text("day"))
