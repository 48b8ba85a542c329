"""Registered plan for the stored keyed table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import keyed_table
from tidewater.plans.common import t
from tidewater.session import scratch_path


def order_table_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table after a first load, a batch of changes that is
    applied twice, and a batch of deletes and new orders; older files removed."""
    root = scratch_path(spark, f"order-table-{uuid.uuid4().hex}")
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"),
                                          F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    first = o.withColumn("seq", F.lit(0))
    held = o.where(F.col("order_key") % 11 == 0).withColumn("seq", F.explode(F.array(F.lit(2), F.lit(1))))
    held = held.withColumn("status", F.when(F.col("seq") == 2, F.lit("released")).otherwise(F.lit("held")))
    gone = o.where(F.col("order_key") % 13 == 0).select("order_key", F.lit(1).alias("seq"), F.lit(True).alias("gone"))
    new = o.where(F.col("order_key") % 17 == 0).withColumns({"order_key": -F.col("order_key"), "status": F.lit("new"), "seq": F.lit(1)})
    keyed_table.apply_batch(first, root, 0, "order_key", "seq")
    for _ in range(2):
        keyed_table.apply_batch(held, root, 1, "order_key", "seq")
    keyed_table.apply_batch(gone.unionByName(new, allowMissingColumns=True), root, 2, "order_key", "seq", deleted="gone")
    keyed_table.vacuum(spark, root, keep=1)
    return keyed_table.read_table(spark, root).withColumn("total", F.col("total").cast("double"))
