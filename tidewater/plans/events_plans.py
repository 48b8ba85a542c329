"""Registered plans for the event-routing application.

Input shape, derived from the order tables:
- ``Order Created`` for every order (detail as an object, items from its
  line items), ``Order Completed`` one day later for status ``F`` orders
  (detail as JSON text);
- ``Inventory Updated`` for every line item (item = part, quantity);
- ``Notification Sent`` for urgent orders, wrapped as ``Records[].body``.
The sequence is ``(time, phase, order, line)``, a total order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import events as ev
from tidewater.plans.common import t


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def bus_events(spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame, Column], DataFrame] | None = None) -> DataFrame:
    """All events of the bus with their sequence.

    ``deal`` shuffles them, if given: it gets the rows that the events are made of, and
    their sequence, since those take less room than the events themselves.
    """
    orders = t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    li = t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    # Items of an order: bounded by its line count (at most 7 lines per order).
    items = (li.groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.struct(
                 F.col("l_partkey").cast("string").alias("productId"),
                 F.col("l_quantity").cast("bigint").alias("quantity"),
                 F.col("l_extendedprice").cast("decimal(18,2)").alias("price")).alias("item")))).alias("lines"))
             .select("l_orderkey", F.col("lines.item").alias("items")))
    o = orders.repartition("o_orderkey").join(items, orders.o_orderkey == items.l_orderkey, "left")
    # What the events of either table are made of: all events of an order from one pass
    # over it, first which, then each one; and one of a line.
    which = F.array(F.lit(0), F.when(F.col("o_orderstatus") == "F", F.lit(1)),
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(3)))
    phase = F.col("phase")
    of_orders = (o.select("*", F.explode(F.array_compact(which)).alias("phase"))
                 .select("phase", F.col("o_orderkey").alias("k"), F.lit(0).alias("line"), F.col("o_orderdate").alias("at"),
                         *[F.when(phase == 0, F.col(c)).alias(name) for c, name in (("o_custkey", "who"), ("o_totalprice", "amount"), ("items", "items"))]))
    of_lines = li.select(F.lit(2).alias("phase"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.col("l_shipdate").alias("at"),
                         F.col("l_partkey").alias("who"), F.col("l_quantity").alias("amount"))

    key, done_at = F.col("k").cast("string"), F.col("at") + F.expr("INTERVAL 1 DAY")
    seq = F.struct(F.when(phase == 1, done_at).otherwise(F.col("at")).alias("t"), "phase", "k", "line")
    created_detail = (F.struct(
        F.lit("order.created").alias("eventType"),
        F.struct(key.alias("orderId"), F.col("who").cast("string").alias("customerId"),
                 F.coalesce("items", F.array().cast(items.schema["items"].dataType)).alias("items"),
                 F.col("amount").cast("decimal(18,2)").alias("total"),
                 _iso("at").alias("createdAt")).alias("data")))
    created = F.to_variant_object(F.struct(F.lit("orders").alias("source"),
                                           F.lit("Order Created").alias("detail-type"),
                                           created_detail.alias("detail")))

    completed = F.to_variant_object(F.struct(
        F.lit("orders").alias("source"), F.lit("Order Completed").alias("detail-type"),
        F.to_json(F.struct(
            F.lit("order.completed").alias("eventType"),
            F.struct(key.alias("orderId"), _iso(done_at).alias("completedAt")).alias("data")))
        .alias("detail")))

    updated = F.to_variant_object(F.struct(
        F.lit("inventory").alias("source"), F.lit("Inventory Updated").alias("detail-type"),
        F.struct(F.lit("inventory.updated").alias("eventType"),
                 F.struct(F.col("who").cast("string").alias("itemId"),
                          F.col("amount").cast("decimal(18,2)").alias("quantity"),
                          _iso("at").alias("updatedAt")).alias("data"))
        .alias("detail")))

    note = F.to_json(F.struct(
        F.lit("notifications").alias("source"), F.lit("Notification Sent").alias("detail-type"),
        F.struct(F.struct(F.concat(F.lit("NOTIF-"), key).alias("id"),
                          F.lit("Urgent order").alias("subject"),
                          F.concat(F.lit("Order "), key, F.lit(" is urgent")).alias("message"),
                          F.lit("high").alias("priority"),
                          _iso("at").alias("timestamp")).alias("data")).alias("detail")))
    wrapped = F.to_json(F.struct(F.array(F.struct(note.alias("body"))).alias("Records")))
    of_order = F.when(phase == 0, created).when(phase == 1, completed).otherwise(F.parse_json(wrapped))

    if deal:
        rows = deal(of_orders.unionByName(of_lines, allowMissingColumns=True), seq)
        return rows.select(F.when(phase == 2, updated).otherwise(of_order).alias("event"), seq.alias("seq"))
    # A bus has its events in shards; the tables come in one piece.
    of_lines = of_lines.repartition("k", "line").select(updated.alias("event"), seq.alias("seq"))
    return of_orders.select(of_order.alias("event"), seq.alias("seq")).unionByName(of_lines)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bus_events(spark, sf_dir)
    norm, _ = ev.normalise(raw)
    known, _ = ev.split_events(ev.parse_detail(norm))
    return ev.route(known, ev.rules_frame(spark))


def order_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows folded from created/completed events."""
    routed = _routed(spark, sf_dir).filter(F.col("target") == "order_processor")
    changes, _ = ev.order_changes(routed)
    st = ev.fold_orders(changes)
    return st.select("order_id", "status", "customer_id", F.size("items").alias("n_items"),
                     F.col("total").cast("double").alias("total"), "created_at")


def inventory_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last inventory update per item."""
    routed = _routed(spark, sf_dir).filter(F.col("target") == "inventory_processor")
    changes, _ = ev.inventory_changes(routed)
    st = ev.fold_latest(changes, "item_id")
    return st.select("item_id", F.col("quantity").cast("double").alias("quantity"), "updated_at")


def notification_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + F4: every notification published by the three processors."""
    routed = _routed(spark, sf_dir)
    orders = routed.filter(F.col("target") == "order_processor")
    changes, _ = ev.order_changes(orders)
    notes = routed.filter(F.col("target") == "notification_processor")
    return ev.outbox(ev.order_outbox(changes), ev.notification_outbox(notes)).select("subject", "message")


def routed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11 + B12: deliveries per (target, eventType)."""
    routed = _routed(spark, sf_dir)
    return routed.groupBy("target", "event_type").agg(F.count(F.lit(1)).alias("events"))


def _dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events of which 7 in 20, by order key, are broken."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").repartition("o_orderkey")
    k = F.col("o_orderkey")
    case, key = k % 20, k.cast("string")
    detail = F.concat(F.lit('{"eventType":"'), F.when(case == 3, "order.lost").otherwise("order.created"), F.lit('","data":{'),
                      F.when(case == 4, "").otherwise(F.concat(F.lit('"orderId":"'), key, F.lit('"'))), F.lit("}}"))
    text = F.when(case == 2, F.concat(detail, F.lit(" tail"))).otherwise(detail)
    event = F.concat(F.lit('{"source":"orders","detail-type":"Order Created","detail":'), F.to_json(F.struct(text.alias("d"))).substr(F.lit(6), F.length(F.to_json(F.struct(text.alias("d")))) - 6), F.lit("}"))
    raw = (F.when(case == 0, F.lit('{"Records":null}')).when(case == 1, F.lit('{"Records":"one"}'))
           .when(case == 5, F.concat(F.lit('{"Records":[{"body":"{broken"},'), event, F.lit("]}")))
           .when(case == 6, F.lit("[1]")).otherwise(event))
    return o.select(F.parse_json(raw).alias("event"),
                    F.when(case != 7, F.col("o_orderkey")).alias("seq"))


def event_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each event of a dirty bus ends up."""
    norm, bad = ev.normalise(_dirty_events(spark, sf_dir))
    known, unfit = ev.split_events(ev.parse_detail(norm))
    changes, no_id = ev.order_changes(ev.route(known, ev.rules_frame(spark)))
    out = changes.select(F.lit("accepted").alias("outcome"))
    for rejected in (bad, unfit, no_id):
        out = out.unionByName(rejected.select(F.explode("reasons").alias("outcome")))
    return out.groupBy("outcome").agg(F.count(F.lit(1)).alias("events"))
