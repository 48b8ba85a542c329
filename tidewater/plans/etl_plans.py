"""Registered plans for the daily ETL application.

Input shape: one record per order, ``{id, timestamp, value, count,
total_value, location, status}`` where ``count``/``total_value`` summarise
the order's line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import etl
from tidewater.plans.common import ETL_AS_OF, t
from tidewater.session import stored


def _records(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    # Line items are reduced per order before the join (partial aggregation).
    li = (lineitem.groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("cnt"),
               F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total")))
    joined = orders.join(li, orders.o_orderkey == li.l_orderkey, "left")
    record = F.to_variant_object(F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("timestamp"),
        F.col("o_totalprice").alias("value"),
        F.col("cnt").alias("count"),
        F.col("total").alias("total_value"),
        F.col("o_orderpriority").alias("location"),
        F.col("o_orderstatus").alias("status"),
    ))
    return joined.select(record.alias("record"))


def _flat(df: DataFrame) -> DataFrame:
    g = lambda p, ty: F.try_variant_get("data", p, ty)
    return df.select("id", "timestamp", "processed_at",
                     g("$.value", "double").alias("value"), g("$.count", "bigint").alias("count"),
                     g("$.average", "double").alias("average"),
                     g("$.location", "string").alias("location"), g("$.status", "string").alias("status"))


def etl_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B10 -> B5..B9 -> B13 -> B14: yesterday's orders, transformed and
    validated for load.  The day filter runs on the typed order date, so it
    reaches the Parquet scan."""
    orders = t(spark, sf_dir, "orders")
    day, _ = etl.extract_day(orders, "o_orderdate", ETL_AS_OF)
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    li = li.join(day.select("o_orderkey"), li.l_orderkey == F.col("o_orderkey"), "left_semi")
    records = _records(day, li)
    out, _ = etl.transform(records, ETL_AS_OF)
    ok, _ = etl.validate_for_load(out)
    return _flat(etl.to_storage_types(ok))


def etl_stage_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: the whole order history through the transform, summarised per
    staged day partition (year/month/day)."""
    records = _records(t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem"))
    out, _ = etl.transform(records, ETL_AS_OF)
    flat = _flat(out)
    day = F.to_timestamp(F.substring("timestamp", 1, 10), "yyyy-MM-dd")
    return (flat.withColumns({"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"),
                              "day": F.date_format(day, "dd")})
            .groupBy("year", "month", "day")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value_total"),
                 F.sum("count").alias("lines")))


def _load_steps(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Extract, transform and load over records with typed attributes, times
    in several forms, repeated keys and broken rows (by order key)."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    stamp = (F.when(k % 17 == 0, F.lit("not a time")).when(k % 4 == 0, F.concat(day, F.lit("T00:00:00Z")))
             .when(k % 4 == 1, F.concat(day, F.lit(" 00:00:00+00:00"))).when(k % 4 == 2, F.concat(day, F.lit("T00:00:00.000")))
             .otherwise(F.concat(day, F.lit(" 00:00:00"))))
    number = F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    # Every seventh key comes again with a later value.
    copies = F.when(k % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = o.select("*", stamp.alias("stamp"), number.alias("number"), F.explode(copies).alias("copy"))
    record = F.parse_json(F.to_json(F.struct(
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None)).otherwise(
            F.struct(F.col("o_orderkey").cast("string").alias("S"))).alias("id"),
        F.struct(F.col("stamp").alias("S")).alias("timestamp"),
        F.struct(F.col("number").alias("N")).alias("value"),
        F.struct(F.concat("o_orderpriority", F.lit("/"), F.col("copy").cast("string")).alias("S")).alias("location"),
        F.struct(F.lit("__bad_number__").alias("S")).alias("note")), {"ignoreNullFields": "false"}))
    records = rows.select((F.col("o_orderkey") * 2 + F.col("copy")).alias("seq"), record.alias("record"))
    extracted, bad_time = etl.extract_records(records, ETL_LOAD_AS_OF)
    # A day's records, which every later step reads; not made anew from all records for each.
    extracted = stored(extracted, "extracted")
    changed, bad_number = etl.transform(extracted, ETL_LOAD_AS_OF)
    valid, bad_row = etl.validate_for_load(changed)
    return {"extract": (extracted, bad_time), "transform": (changed, bad_number), "load": (valid, bad_row)}


# Fixed value: the clock of the load queries; its day before has orders.
ETL_LOAD_AS_OF = "1996-01-03 00:00:00"


def etl_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5-B14 and the keyed load (A8, E2): the last input of a key wins."""
    valid, _ = _load_steps(spark, sf_dir)["load"]
    loaded = etl.load_latest(etl.to_storage_types(valid))
    g = lambda p, ty: F.try_variant_get("data", p, ty)
    return loaded.select("id", "timestamp", "processed_at", g("$.value", "double").alias("value"),
                         g("$.location", "string").alias("location"), g("$.note", "string").alias("note"))


def etl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows of every step, by step and reason."""
    out = None
    for step, (_, bad) in _load_steps(spark, sf_dir).items():
        one = bad.select(F.lit(step).alias("step"), F.explode("reasons").alias("reason"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("step", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def etl_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and first error texts of extract, transform and load."""
    return etl.run_audit(_load_steps(spark, sf_dir))
