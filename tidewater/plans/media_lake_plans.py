"""Registered plans for the media and data-lake applications.

Media: every ``embeddings`` row is an uploaded asset whose extension follows
its label; its detections are the embedding components (label
``label-NN`` = component NN, confidence = value).
Lake: part rows arrive as one JSON file each, pages as HTML files; events
arrive as JSON files partitioned by event hour.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import lake, media
from tidewater.plans.common import LAKE_AS_OF, t
from tidewater.session import scratch_path

# Upload extension by embedding label 0..9.
ASSET_EXTENSIONS = ["jpg", "png", "jpeg", "mp4", "mov", "avi", "gif", "JPG", "MP4", "txt"]


def _media(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings")
    ext = F.element_at(F.array(*[F.lit(e) for e in ASSET_EXTENSIONS]), F.col("label") + 1)
    files = media.media_files(emb.select(
        F.col("vec_id").alias("asset"),
        F.concat(F.lit("media/"), F.col("label"), F.lit("/asset-"), F.col("vec_id"), F.lit("."), ext).alias("key"),
        F.col("vec_id").alias("seq")))
    det = emb.select(F.col("vec_id").alias("asset"), F.posexplode("embedding").alias("pos", "confidence"))
    det = det.select("asset", F.concat(F.lit("label-"), F.lpad(F.col("pos").cast("string"), 2, "0")).alias("label"),
                     "confidence")
    return media.upsert_results(media.manifest(files, det))


def media_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M2 + E7: one result per file name."""
    r = _media(spark, sf_dir)
    return r.select("fileName", "type", "status", F.size("labels").alias("n_labels"),
                    F.array_join("labels", "|").alias("labels"))


def media_notification_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications published, per status."""
    r = _media(spark, sf_dir)
    n = media.notifications(r).select("subject", F.get_json_object("message", "$.status").alias("status"))
    return n.groupBy("subject", "status").agg(F.count(F.lit(1)).alias("messages"))


def _landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(part files, page files) as whole-file bodies."""
    part = t(spark, sf_dir, "part")
    pages = t(spark, sf_dir, "pages")
    part_files = part.select(
        F.concat(F.lit("data/part/"), F.col("p_partkey"), F.lit(".json")).alias("source_file"),
        F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
                           F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
                           F.col("p_retailprice").alias("price"), F.col("p_size").alias("size"))).alias("body"))
    page_files = pages.select(
        F.concat(F.lit("data/pages/"), F.col("page_id"), F.lit(".html")).alias("source_file"),
        F.col("html").alias("body"))
    return part_files, page_files


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    part_files, page_files = _landed(spark, sf_dir)
    return lake.ingest(part_files.unionByName(page_files), LAKE_AS_OF)


def lake_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + A11 + B20: two batches of one hour, the first one written twice
    (a retry), read back through SQL over the registered table."""
    zone = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    part_files, page_files = _landed(spark, sf_dir)
    for batch, files in (("1", part_files), ("2", page_files), ("1", part_files)):
        lake.write_processed(lake.ingest(files, LAKE_AS_OF), zone, batch)
    lake.register(spark, "lake_processed", zone)
    return spark.sql("""SELECT batch_id AS batch, is_json, COUNT(*) AS files, COUNT(DISTINCT source_file) AS names,
                               COUNT(try_variant_get(data, '$.price', 'double')) AS prices
                        FROM lake_processed_typed GROUP BY batch_id, is_json""")


def lake_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition predicates over an hourly zone; only the folders of one
    day are read."""
    zone = scratch_path(spark, f"lake-events-{uuid.uuid4().hex}")
    ev = t(spark, sf_dir, "events").select("event_id", "ts", "props")
    files = ev.select(
        F.concat(F.lit("data/events/"), F.col("event_id"), F.lit(".json")).alias("source_file"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_timestamp"), lake.parse_strict("props").alias("data"),
        F.date_format("ts", "yyyy-MM-dd").alias("partition_date"), F.date_format("ts", "HH").alias("partition_hour"))
    lake.write_processed(files.withColumn("is_json", F.col("data").isNotNull()), zone, "1")
    rows = lake.read_processed(spark, zone).where("year = '2024' AND month = '01' AND day = '15'")
    return rows.groupBy("hour").agg(F.count(F.lit(1)).alias("files"), F.sum(F.try_variant_get("data", "$.k", "bigint")).alias("k_total"))


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    ing = _ingested(spark, sf_dir).filter("is_json")
    return lake.curated_view(ing, {"id": "string", "name": "string", "category": "string", "price": "double"})


def lake_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + B4 + Q11: ingested files per kind (JSON vs raw content) and
    partition."""
    ing = lake.with_partitions(_ingested(spark, sf_dir))
    return ing.groupBy("is_json", "year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("files"))


def lake_category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 over the curated typed view (Q12)."""
    return lake.category_stats(_curated(spark, sf_dir))


def lake_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: ``SELECT COUNT(*)`` over the curated table."""
    _curated(spark, sf_dir).createOrReplaceTempView("lake_curated")
    return spark.sql("SELECT COUNT(*) AS n FROM lake_curated")


def lake_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT * ... LIMIT 10`` made deterministic by key order."""
    _curated(spark, sf_dir).createOrReplaceTempView("lake_curated")
    return spark.sql("SELECT id, name, category, price FROM lake_curated ORDER BY id LIMIT 10")


def lake_partition_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL with partition predicates over event files laid out by
    event hour (year/month/day/hour)."""
    ev = t(spark, sf_dir, "events").select("event_id", "ts", "props")
    files = ev.select(
        F.concat(F.lit("data/events/"), F.col("event_id"), F.lit(".json")).alias("source_file"),
        F.col("props").alias("body"),
        F.date_format("ts", "yyyy-MM-dd").alias("partition_date"),
        F.date_format("ts", "HH").alias("partition_hour"))
    ing = lake.with_partitions(files.select("source_file", lake.parse_strict("body").alias("data"),
                                            "partition_date", "partition_hour"))
    ing.createOrReplaceTempView("lake_events")
    return spark.sql("""SELECT day, COUNT(*) AS files,
                               SUM(try_variant_get(data, '$.k', 'bigint')) AS k_total
                        FROM lake_events WHERE year = '2024' AND month = '01'
                        GROUP BY day""")
