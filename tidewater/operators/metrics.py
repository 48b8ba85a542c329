"""Keyed stream metrics (B1, D1, D2, D6, B22, B23, A5 layout).

Input is the envelope DataFrame of ``sources.stream``.  Every aggregate here
is decomposable (count / sum / min_by / max_by), so Spark combines map-side
before the single shuffle on the key: a key holding a third of all records
costs one partial row per map task, not a third of the data in one reducer.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import decode_base64_json, decode_stage, has_key, lit_ts, once, vget
from tidewater.operators.quality import split_valid

METRICS_TTL_DAYS = 30
# Exact decimal used for metric sums: order-independent totals.  Values of
# this size or more are quarantined, so the cast cannot fail.
METRIC_DECIMAL = "decimal(38,18)"
MAX_VALUE = 1e15
# Epoch milliseconds that a timestamp holds (years 1 to 9999).
ARRIVAL_RANGE = (-62135596800000, 253402300799999)


def seq_order(seq: Column | str = "sequenceNumber") -> Column:
    """Total order of digit-string sequence numbers (they exceed decimal(38)):
    shorter strings first, then lexicographic."""
    s = F.col(seq) if isinstance(seq, str) else seq
    return F.struct(F.length(s).alias("len"), s.alias("seq"))


def decode_records(env: DataFrame) -> DataFrame:
    """B1: decode the payload and derive arrival time.

    Adds ``payload`` (variant), ``decode_error`` (stage name or NULL),
    ``arrival`` (TIMESTAMP_NTZ from epoch millis), ``raw_value`` (the
    ``value`` field as variant when present), ``value_num`` (DOUBLE when the
    value casts and is finite) and ``value_error``.
    """
    millis = F.col("approximateArrivalTimestamp")
    df = once(env.select(
        "*",
        decode_base64_json("data").alias("payload"),
        F.when(millis.between(*ARRIVAL_RANGE), F.timestamp_millis(millis).cast("timestamp_ntz")).alias("arrival"),
    ))
    df = once(df.withColumns({"decode_error": decode_stage("data", "payload"), "_present": has_key("payload", "value"),
                              "_number": vget("payload", "$.value", "double")}))
    present, num = F.col("_present"), F.col("_number")
    number = num.isNotNull() & ~F.isnan(num)
    fits = number & (F.abs(num) < MAX_VALUE)
    return df.select(
        *[c for c in df.columns if c not in ("_present", "_number")],
        present.alias("has_value"),
        F.when(present & fits, num).alias("value_num"),
        F.when(present & ~number, F.lit("bad_value")).when(present & ~fits, F.lit("value_range")).alias("value_error"),
    )


def record_rules() -> dict:
    """Quarantine rules of a decoded record (Q4)."""
    return {"decode": F.col("decode_error").isNotNull(),
            "value": F.col("value_error").isNotNull(),
            "arrival": F.col("arrival").isNull()}


def split_records(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(archivable records, quarantined records) -- Q4.

    Quarantined: undecodable records, a ``value`` that is no number or too
    large for an exact sum, an arrival time that no timestamp holds.  Only
    the first are excluded from the metrics.
    """
    return split_valid(decoded, record_rules())


def batch_metrics(decoded: DataFrame, as_of: str | datetime,
                  batch_cols: tuple[str, ...] = ()) -> DataFrame:
    """Per (batch, key) ``count``, ``total_value``, ``average_value``,
    ``first_arrival`` (Q2), ``last_arrival`` and ``ttl``.

    Counted: every decodable record (Q4), even one with a bad value, which
    then adds 0.  The average divides by all counted records (Q3).
    """
    counted = decoded.filter(F.col("decode_error").isNull())
    seq = seq_order()
    total = F.try_sum(F.coalesce(F.col("value_num"), F.lit(0.0)).try_cast(METRIC_DECIMAL))
    agg = (counted.groupBy(*batch_cols, F.col("partitionKey").alias("partition_key"))
           .agg(F.count(F.lit(1)).alias("count"),
                total.alias("_total"),
                F.min_by("arrival", seq).alias("first_arrival"),
                F.max_by("arrival", seq).alias("last_arrival")))
    ttl = F.unix_seconds(lit_ts(as_of).cast("timestamp")) + F.lit(86400 * METRICS_TTL_DAYS).cast("long")
    return agg.select(
        *batch_cols, "partition_key", "count",
        F.col("_total").cast("double").alias("total_value"),
        (F.col("_total").cast("double") / F.col("count")).alias("average_value"),
        "first_arrival", "last_arrival",
        ttl.alias("ttl"),
    )


def windowed_metrics(df: DataFrame, ts: str, key: str, value: str, width: str) -> DataFrame:
    """Event-time tumbling windows per key (batch or streaming input)."""
    total = F.try_sum(F.coalesce(F.col(value), F.lit(0.0)).try_cast(METRIC_DECIMAL))
    return (df.groupBy(F.window(ts, width).alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).alias("count"), total.alias("_total"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    F.col(key), "count",
                    F.col("_total").cast("double").alias("total_value"),
                    (F.col("_total").cast("double") / F.col("count")).alias("average_value")))


def error_alerts(df: DataFrame, ts: str, is_error: Column, width: str,
                 threshold: int = 5) -> DataFrame:
    """Windows whose error count reaches ``threshold`` (alarm condition:
    count >= threshold over one period)."""
    return (df.groupBy(F.window(ts, width).alias("w"))
            .agg(F.count_if(is_error).alias("errors"), F.count(F.lit(1)).alias("records"))
            .filter(F.col("errors") >= threshold)
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "errors", "records"))


def live(df: DataFrame, ttl: str, as_of: str | datetime) -> DataFrame:
    """Rows whose epoch-second ``ttl`` is still in the future."""
    return df.filter(F.col(ttl) > F.unix_seconds(lit_ts(as_of).cast("timestamp")))


def archive_layout(decoded: DataFrame) -> DataFrame:
    """A5: archive partition columns ``year/month/day/hour`` of the arrival
    time plus the archived JSON body."""
    body = F.to_json(F.struct(
        F.date_format("arrival", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("partitionKey").alias("partition_key"),
        F.col("payload").alias("data"),
    ))
    return decoded.select(
        F.date_format("arrival", "yyyy").alias("year"),
        F.date_format("arrival", "MM").alias("month"),
        F.date_format("arrival", "dd").alias("day"),
        F.date_format("arrival", "HH").alias("hour"),
        F.col("partitionKey").alias("partition_key"),
        F.col("sequenceNumber").alias("sequence_number"),
        body.alias("body"),
    )


def write_archive(archive: DataFrame, path: str, batch_id: int | str) -> None:
    """A5 sink: JSON lines by arrival hour and batch; a retried batch replaces
    its own files and no others."""
    (archive.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "day", "hour", "batch_id").json(path))


# Storage tiers by age in days (metrics archive: 30 d to the
# infrequent-access tier, 120 d to the archive tier; raw lake tier: 90 d).
ARCHIVE_TIERS = [(120, "GLACIER"), (30, "STANDARD_IA"), (0, "STANDARD")]


def tier_report(df: DataFrame, day_col: str, as_of: str | datetime,
                tiers=ARCHIVE_TIERS, expire_days: int | None = None) -> DataFrame:
    """Per day partition: rows, age in days, storage tier, expired flag."""
    days = (df.groupBy(F.to_date(F.col(day_col)).alias("day"))
            .agg(F.count(F.lit(1)).alias("rows")))
    age = F.datediff(F.to_date(lit_ts(as_of)), F.col("day"))
    expired = (F.col("age_days") >= expire_days) if expire_days is not None else F.lit(False)
    return (days.select("day", "rows", age.alias("age_days"))
            .select("day", "rows", "age_days", _tier_expr("age_days", tiers).alias("tier"),
                    expired.alias("expired")))


def _tier_expr(age_col: str, tiers) -> Column:
    age = F.col(age_col)
    expr = None
    for min_age, name in tiers:
        expr = F.when(age >= min_age, F.lit(name)) if expr is None else expr.when(age >= min_age, F.lit(name))
    return expr
