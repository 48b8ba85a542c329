"""Registered plans for the item catalogue and keyed-table reads.

Command log derived from the part tables: a ``create`` per part (name, type
as description, retail price, tags brand/type), an ``update`` per returned
line item (status ``returned``, price = line price) and a ``delete`` per
accepted-and-finished line item; ordered by ``(time, phase, order, line)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import items, keyed
from tidewater.plans.common import t, ts_text

CREATED_AT = "1994-06-01 00:00:00"


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    li = t(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_shipdate")
    t0 = F.to_timestamp_ntz(F.lit(CREATED_AT))
    create = part.select(
        F.col("p_partkey").cast("string").alias("id"), F.lit("create").alias("op"),
        F.to_variant_object(F.struct(
            F.col("p_name").alias("name"), F.col("p_type").alias("description"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
            F.array("p_brand", "p_type").alias("tags"))).alias("body"),
        F.struct(t0.alias("t"), F.lit(0).alias("phase"), F.col("p_partkey").alias("k"),
                 F.lit(0).alias("line")).alias("seq"),
        t0.alias("at"))
    seq = F.struct(F.col("l_shipdate").alias("t"), F.lit(1).alias("phase"),
                   F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"))
    update = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").cast("string").alias("id"), F.lit("update").alias("op"),
        F.to_variant_object(F.struct(
            F.lit("returned").alias("status"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))).alias("body"),
        seq.alias("seq"), F.col("l_shipdate").alias("at"))
    delete = li.filter((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")).select(
        F.col("l_partkey").cast("string").alias("id"), F.lit("delete").alias("op"),
        F.parse_json(F.lit("{}")).alias("body"), seq.alias("seq"), F.col("l_shipdate").alias("at"))
    return create.unionByName(update).unionByName(delete)


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = items.validate_commands(commands(spark, sf_dir))
    return items.fold_items(ok)


def _flat(df: DataFrame) -> DataFrame:
    return df.select("id", "name", "description", "status",
                     F.col("price").cast("double").alias("price"),
                     F.array_join("tags", ",").alias("tags"),
                     ts_text("created_at").alias("created_at"), ts_text("updated_at").alias("updated_at"))


def item_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current items after replaying the whole command log."""
    return _flat(_state(spark, sf_dir))


def items_active_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 100 items with status ``returned`` by id (filter,
    then limit)."""
    return _flat(keyed.list_rows(_state(spark, sf_dir), "id", status="returned", limit=100))


def item_delete_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: delete requests for every part named by an urgent order's line
    items: how many existed (deleted), how many were not found."""
    state = _state(spark, sf_dir).select("id")
    orders = t(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    keys = (li.join(orders, li.l_orderkey == orders.o_orderkey, "left_semi")
            .select(F.col("l_partkey").cast("string").alias("id")).distinct())
    out = keyed.delete_outcome(state, keys, "id")
    counts = out.agg(*[F.count_if(F.col("outcome") == o).alias(n) for o, n in
                       (("kept", "survivors"), ("deleted", "deleted"), ("missing", "not_found"))])
    return counts.unpivot([], ["survivors", "deleted", "not_found"], "outcome", "items")


def orders_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 newest open orders, newest first."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_custkey")
    top = keyed.list_by_creation(o, "O", "o_orderdate", "o_orderkey", status_col="o_orderstatus")
    return top.select("o_orderkey", "o_custkey", ts_text("o_orderdate").alias("created_at"))


def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user (ties on time broken by event id)."""
    ev = t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    out = keyed.latest(ev, "user_id", ["ts", "event_id"])
    return out.withColumn("ts", ts_text("ts"))


def user_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 newest events of every user, newest first (salted
    two-pass top-k)."""
    ev = t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    top = keyed.top_k(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3,
                      salt=F.col("event_id"))
    return top.withColumn("ts", ts_text("ts"))


def order_customer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B15 (bulk): each order's customer looked up, with a found flag."""
    keys = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    cust = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return keyed.lookup(cust, keys, "c_custkey")
