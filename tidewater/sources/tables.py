"""Driver tables and other Parquet inputs.

Readers return lazy DataFrames; callers select what they need and Catalyst
prunes columns and pushes predicates into the Parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full-table read (A3).  Splits replace the reference's paginated scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every driver table as a temp view for ``spark.sql``."""
    for name in TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
