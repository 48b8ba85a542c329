"""Data lake zones: raw whole-file ingest, processed Hive-partitioned zone,
catalog registration and curated views (A2, A6, A11, B4, B20, B21, D3, D4,
Q11, Q12).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.core import lit_ts, strict_json

PARTITION_COLS = ["year", "month", "day", "hour"]


def read_raw_files(spark: SparkSession, root: str, glob: str = "data/**") -> DataFrame:
    """A2 source: one row per file, ``(source_file, body)``; new files only
    under the landing prefix.  What stands before ``**`` is the folder read
    (all levels), what stands after it a pattern of file names."""
    folder, deep, names = glob.partition("**")
    reader = spark.read
    if deep:
        reader = reader.option("recursiveFileLookup", True)
        if names.strip("/"):
            reader = reader.option("pathGlobFilter", names.strip("/"))
    # text() sets wholetext itself, so it must be passed there.
    df = reader.text(f"{root.rstrip('/')}/{folder.strip('/')}", wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("body"))


def parse_strict(body: str = "body"):
    """Q11: a body is JSON only when it is exactly one JSON document
    (trailing documents, NaN, duplicate keys are not)."""
    return strict_json(body)


def ingest(raw: DataFrame, as_of: str | datetime) -> DataFrame:
    """A2 + B4: ``source_file, ingestion_timestamp, data, is_json,
    partition_date, partition_hour``; non-JSON bodies become
    ``{"raw_content": body}``.  The full ``source_file`` is kept, so equal
    base names from different folders never collide (Q10)."""
    clock = lit_ts(as_of)
    parsed = parse_strict("body")
    data = F.coalesce(parsed, F.to_variant_object(F.struct(F.col("body").alias("raw_content"))))
    return raw.select(
        "source_file",
        F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_timestamp"),
        data.alias("data"),
        parsed.isNotNull().alias("is_json"),
        F.date_format(clock, "yyyy-MM-dd").alias("partition_date"),
        F.date_format(clock, "HH").alias("partition_hour"),
    )


def with_partitions(df: DataFrame) -> DataFrame:
    """A6 layout: ``year/month/day/hour`` as text (``01`` stays ``01``)."""
    d = F.col("partition_date")
    return df.withColumns({"year": F.substring(d, 1, 4), "month": F.substring(d, 6, 2),
                           "day": F.substring(d, 9, 2), "hour": F.col("partition_hour")})


def write_processed(df: DataFrame, path: str, batch_id: int | str) -> None:
    """Processed zone by hour and batch.  A retried batch replaces its own
    files; other batches of the hour stay.  Tasks write what they hold, so an
    ingest of one hour is not gathered in one task."""
    out = with_partitions(df).withColumn("data", F.to_json("data")).withColumn("batch_id", F.lit(str(batch_id)))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITION_COLS, "batch_id").parquet(path))


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The processed zone with ``data`` as VARIANT; partition values are text."""
    keys = ", ".join(f"{c} string" for c in [*PARTITION_COLS, "batch_id"])
    schema = f"source_file string, ingestion_timestamp string, data string, is_json boolean, partition_date string, partition_hour string, {keys}"
    return spark.read.schema(schema).parquet(path).withColumn("data", F.try_parse_json("data"))


def register(spark: SparkSession, table: str, path: str) -> None:
    """External table over the processed zone; columns and partitions are
    discovered from the files, of batches and streams alike.  ``table`` holds
    ``data`` as text, the view ``<table>_typed`` as VARIANT."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    keys = [*PARTITION_COLS, "batch_id"]
    found = [f for f in spark.read.parquet(path).schema.fields if f.name not in keys]
    columns = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in found), *(f"{k} STRING" for k in keys)])
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    typed = ", ".join("try_parse_json(data) AS data" if c == "data" else f"`{c}`" for c in spark.table(table).columns)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {table}_typed AS SELECT {typed} FROM {table}")


def split_ndjson(df: DataFrame) -> DataFrame:
    """Curated step for newline-delimited JSON kept as ``raw_content``:
    one row per non-empty line that is a JSON document."""
    raw = F.try_variant_get("data", "$.raw_content", "string")
    lines = df.select("source_file", F.posexplode(F.split(raw, r"\r?\n")).alias("line_no", "line"))
    lines = lines.filter(F.trim("line") != "")
    return lines.select("source_file", "line_no", parse_strict("line").alias("data")).filter(
        F.col("data").isNotNull())


def curated_view(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Q12: typed top-level columns from ``data`` (name -> SQL type)."""
    cols = [F.try_variant_get("data", f"$.{k}", t).alias(k) for k, t in fields.items()]
    return df.select("source_file", *cols)


def category_stats(curated: DataFrame, category: str = "category", price: str = "price") -> DataFrame:
    """``COUNT(*)`` and average price per category (exact decimal sum,
    so the average does not depend on addition order)."""
    return (curated.groupBy(category)
            .agg(F.count(F.lit(1)).alias("items"),
                 F.sum(F.col(price).cast("decimal(18,2)")).alias("_s"))
            .select(category, "items", (F.col("_s").cast("double") / F.col("items")).alias("avg_price")))
