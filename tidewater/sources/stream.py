"""Keyed record stream source (A1).

A record is an envelope ``(data, partitionKey, sequenceNumber,
approximateArrivalTimestamp)`` where ``data`` is base64 of a JSON payload and
the arrival time is epoch milliseconds.  Envelopes arrive as JSON-lines
files; a message-bus connector can be plugged in by format name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("partitionKey", T.StringType()),
    T.StructField("sequenceNumber", T.StringType()),
    T.StructField("approximateArrivalTimestamp", T.LongType()),
])


def read_envelopes(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Batch read of envelope files (no schema inference)."""
    return spark.read.format(fmt).schema(ENVELOPE_SCHEMA).load(path)


def read_stream(spark: SparkSession, path: str, max_files: int | None = None,
                fmt: str = "json", options: dict | None = None) -> DataFrame:
    """Streaming read of envelope files; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(ENVELOPE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def envelopes_from_events(events: DataFrame) -> DataFrame:
    """Encode driver ``events`` rows as stream envelopes.

    Payload: ``{sensorId, value, timestamp, location}`` as in the sensor
    producer; key = user, sequence = event id (digit string), arrival = event
    time in epoch millis.
    """
    payload = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("sensorId"),
        F.col("value").alias("value"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_type").alias("location"),
    ))
    return events.select(
        F.base64(F.encode(payload, "UTF-8")).alias("data"),
        F.col("user_id").cast("string").alias("partitionKey"),
        F.col("event_id").cast("string").alias("sequenceNumber"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("approximateArrivalTimestamp"),
    )


def write_envelopes(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write envelopes as JSON lines (test and replay helper)."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").json(path)
