"""Media labelling results.

Detections ``(asset, label, confidence)`` stand in for the label detector.
Images keep their 5 most confident labels, videos keep every distinct label;
other files are ``UNSUPPORTED``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import basename, file_extension
from tidewater.operators import keyed

# Extensions per media type, and the image label limit.
IMAGE_TYPES = ["jpg", "jpeg", "png"]
VIDEO_TYPES = ["mp4", "mov", "avi"]
IMAGE_MAX_LABELS = 5
SUBJECT = "Media Processing Result"


def media_files(keys: DataFrame, key: str = "key") -> DataFrame:
    """B17 for media: URL-decoded key, base name, ``type``."""
    decoded = F.coalesce(F.try_url_decode(F.col(key)), F.col(key))
    ext = file_extension(basename(decoded))
    kind = F.when(ext.isin(*IMAGE_TYPES), F.lit("image")).when(ext.isin(*VIDEO_TYPES), F.lit("video"))
    return keys.withColumns({"fileName": basename(decoded), "type": kind})


def ranked_labels(detections: DataFrame) -> DataFrame:
    """The labels of each asset, best confidence first, then by name (one
    aggregate; an asset has a bounded number of detections)."""
    return (detections.groupBy("asset")
            .agg(F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "label"))).alias("_l"))
            .select("asset", F.transform("_l", lambda x: x.label).alias("_ranked")))


def labels_of(kind: Column, ranked: Column, k: int = IMAGE_MAX_LABELS) -> Column:
    """An image's ``k`` most confident labels, a video's distinct ones."""
    return F.when(kind == "image", F.slice(ranked, 1, k)).when(kind == "video", F.array_distinct(ranked))


def manifest(files: DataFrame, detections: DataFrame, failed_jobs: DataFrame | None = None) -> DataFrame:
    """M1: ``fileName, type, labels, status, error`` per file."""
    out = files.join(ranked_labels(detections), "asset", "left").withColumn("labels", labels_of(F.col("type"), F.col("_ranked")))
    if failed_jobs is not None:
        out = out.join(failed_jobs.select("asset", F.lit(True).alias("_failed")), "asset", "left")
    else:
        out = out.withColumn("_failed", F.lit(None).cast("boolean"))
    status = (F.when(F.col("type") == "image", F.lit("IMAGE_PROCESSED"))
              .when((F.col("type") == "video") & F.coalesce("_failed", F.lit(False)), F.lit("VIDEO_PROCESSING_FAILED"))
              .when(F.col("type") == "video", F.lit("VIDEO_PROCESSED"))
              .otherwise(F.lit("UNSUPPORTED")))
    empty = F.array().cast("array<string>")
    labels_col = (F.when(F.col("type") == "image", F.coalesce("labels", empty))
                  .when((F.col("type") == "video") & ~F.coalesce("_failed", F.lit(False)), F.coalesce("labels", empty)))
    return out.select("asset", "fileName", "type", labels_col.alias("labels"), status.alias("status"),
                      F.lit(None).cast("string").alias("error"), F.col("seq"))


def upsert_results(results: DataFrame) -> DataFrame:
    """M2: one row per file name, the last processed wins (Q10: files with
    the same base name in different folders collide, as in the reference)."""
    return keyed.latest(results, "fileName", ["seq"])


def notifications(results: DataFrame) -> DataFrame:
    """One message per processed file."""
    msg = F.to_json(F.struct("fileName", "type", "labels", "status"))
    return results.select(F.lit(SUBJECT).alias("subject"), msg.alias("message"))
