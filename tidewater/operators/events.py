"""Business events: envelope normalising, rule routing, type dispatch, state
folds and the notification outbox (B2, B3, B11, B12, E2, E3, A9, F4).

Events are VARIANT values.  State is never updated in place: the current
order / inventory row is a fold of the event log with decomposable
aggregates (``max_by`` with a total sequence), so Spark combines map-side and
a hot key costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import once, strict_json, variant_fields
from tidewater.operators.quality import split_valid

# Routing rules of the event bus, (source, detail-type, target).
DEFAULT_RULES = [
    ("orders", "Order Created", "order_processor"),
    ("orders", "Order Completed", "order_processor"),
    ("inventory", "Inventory Updated", "inventory_processor"),
    ("notifications", "Notification Sent", "notification_processor"),
    ("workflow", "Workflow Triggered", "order_processor"),
    ("workflow", "Workflow Triggered", "inventory_processor"),
]

AMOUNT = "decimal(38,18)"
ITEMS = "array<struct<productId:string,quantity:bigint,price:decimal(38,18)>>"

# Outbox subjects.
SUBJECT_CREATED = "New Order Created"
SUBJECT_COMPLETED = "Order Completed"
SUBJECT_NOTIFICATION_DEFAULT = "Notification"


def rules_frame(spark, rules=DEFAULT_RULES) -> DataFrame:
    """The routing rules as a frame whose size the planner knows, so it need not
    deal out the events to join them."""
    names = ("source", "detail_type", "target")
    rows = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, r)]) for r in rules]
    typed = F.array(*rows).cast("array<struct<source:string,detail_type:string,target:string>>")
    return spark.range(1).select(F.inline(typed))


def normalise(raw: DataFrame, col: str = "event") -> tuple[DataFrame, DataFrame]:
    """B2: one row per event from a bare event, ``Records[]`` of events, or
    ``Records[].body`` JSON texts.  Other columns of ``raw`` are kept (e.g. a
    sequence).  Quarantined: ``Records`` that is no list (one row), a body
    that is not one JSON document, and an event that is no object (Q6c)."""
    # The structure of what is an object, else null; an event that is neither wrapped nor a body is looked at no more.
    seen = F.col("_seen")
    read = once(raw.withColumn("_seen", variant_fields(col, Records="variant", body="variant")))
    wrapped = seen["Records"].isNotNull()
    records = F.when(wrapped, F.try_variant_get(col, "$.Records", "array<variant>"))
    no_list = wrapped & records.isNull()
    items = F.when(wrapped & ~no_list, records).otherwise(F.array(F.col(col)))
    exploded = (read.withColumns({"_no_list": no_list, "_own": ~wrapped})
                .select("*", F.posexplode(items).alias("record_pos", "_el")).drop(col))
    has_body = F.when(F.col("_own"), seen["body"].isNotNull()).otherwise(variant_fields("_el", body="variant").body.isNotNull())
    body = F.try_variant_get("_el", "$.body", "string")
    event = F.when(has_body, strict_json(body)).otherwise(F.col("_el"))
    plain = F.when(F.col("_own") & ~has_body, seen.isNotNull())
    tagged = once(exploded.withColumns({col: event, "_has_body": has_body, "_plain": plain}).drop("_seen", "_own"))
    bad_body = F.col("_has_body") & F.col(col).isNull()
    is_object = F.when(F.col("_plain").isNotNull(), F.col("_plain")).otherwise(variant_fields(col, source="string").isNotNull())
    ok, bad = split_valid(tagged, {
        "bad_records": F.col("_no_list"),
        "bad_body": bad_body,
        "not_an_object": ~F.col("_no_list") & ~bad_body & ~is_object,
    })
    return ok.drop("_el", "_no_list", "_has_body", "_plain"), bad.drop("_no_list", "_has_body", "_plain")


# Event types that the processors know; '' is a notification.
KNOWN_TYPES = ["order.created", "order.completed", "inventory.updated", ""]


def split_events(parsed: DataFrame, known=KNOWN_TYPES) -> tuple[DataFrame, DataFrame]:
    """Events fit for routing, and the others with reasons: a detail text that
    is not one JSON document, a type that no processor knows (B12), no
    sequence (a fold needs a total order)."""
    return split_valid(parsed, {"bad_detail": F.col("bad_detail"),
                                "unknown_type": ~F.col("bad_detail") & ~F.col("event_type").isin(*known),
                                "missing_seq": F.col("seq").isNull()})


def parse_detail(events: DataFrame, col: str = "event") -> DataFrame:
    """B3 + envelope fields: ``source``, ``detail_type``, ``event_type``
    ('' if absent), ``detail`` (object or JSON text -> object; absent -> {})
    and ``data`` (the detail's ``data``, {} if absent).

    Fields are read with direct paths into the event (``$.detail.data.x``);
    only a detail given as JSON text is parsed (``_dparsed``).  ``detail`` and
    ``data`` are materialised only when a consumer uses them (column pruning
    drops them otherwise).
    """
    e, top = F.col(col), F.col("_top")
    fields = variant_fields(e, **{"source": "string", "detail-type": "string", "detail": "struct<eventType:variant>"})
    read = once(events.select("*", fields.alias("_top")))
    kind = top["detail"]["eventType"]
    # ``detail`` is null in ``_top`` unless it is an object.
    is_obj = kind.isNotNull() | F.when(top["detail"].isNotNull(), F.try_variant_get(e, "$.detail.data", "variant").isNotNull()).otherwise(False)
    # Only a text can be broken; another kind of value counts as absent.
    text = F.when(top["detail"].isNull(), F.when(F.schema_of_variant(F.try_variant_get(e, "$.detail", "variant")) == "STRING",
                                                 F.try_variant_get(e, "$.detail", "string")))
    out = once(read.select(
        *events.columns,
        is_obj.alias("_is_obj"),
        text.isNotNull().alias("_is_text"),
        top["source"].alias("source"),
        top["detail-type"].alias("detail_type"),
        F.try_variant_get(kind, "$", "string").alias("_kind"),
        strict_json(text).alias("_dparsed"),
    ))
    parsed = F.when(F.col("_dparsed").isNotNull(), variant_fields("_dparsed", eventType="string").eventType)
    out = out.withColumns({
        "bad_detail": ~F.col("_is_obj") & F.col("_is_text") & F.col("_dparsed").isNull(),
        "event_type": F.coalesce("_kind", parsed, F.lit(""))}).drop("_kind")
    empty = F.parse_json(F.lit("{}"))
    detail = F.coalesce(F.col("_dparsed"), F.try_variant_get(e, "$.detail", "variant"), empty)
    detail = F.when(F.col("_is_obj") | F.col("_dparsed").isNotNull(), detail).otherwise(empty)
    return out.select("*", detail.alias("detail")).drop("_is_obj", "_is_text").withColumn("data", F.coalesce(F.try_variant_get("detail", "$.data", "variant"), empty))


def data_fields(col: str = "event", **types: str) -> Column:
    """The named fields of ``detail.data``, from either detail form, as one structure."""
    return (F.when(F.col("_dparsed").isNotNull(), variant_fields("_dparsed", "$.data", **types))
            .otherwise(variant_fields(col, "$.detail.data", **types)))


def route(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Match ``(source, detail_type)`` against the rules; unmatched
    events drop out and an event matching several rules is delivered once
    per rule.  Spark broadcasts the rules when their size is below its own
    threshold."""
    return events.join(rules, ["source", "detail_type"], "inner")


def dispatch(events: DataFrame, event_type: str) -> DataFrame:
    """Events of one ``eventType`` (unknown types are left out)."""
    return events.filter(F.col("event_type") == event_type)


def _get(key: str, default: Column) -> Column:
    """``data.get(key, default)`` of the fields in ``_data``: the default only
    when the key is absent; a present null stays null (Q5)."""
    v = F.col("_data")[key]
    return F.when(v.isNull() & data_fields(**{key: "variant"})[key].isNull(), default).otherwise(v)


def order_changes(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Order events -> change rows ``(order_id, kind, customer_id, items,
    total, created_at, seq)``; events without ``orderId`` are quarantined."""
    orders = events.filter(F.col("event_type").isin("order.created", "order.completed"))
    # Apart from the id, which every use needs: a caller that leaves the other fields out does not pay for them.
    fields = data_fields(customerId="string", items=ITEMS, total=AMOUNT, createdAt="string")
    rows = orders.select("event", "_dparsed", "event_type", "seq", fields.alias("_data")).select(
        F.coalesce(data_fields(orderId="string").orderId, F.lit("")).alias("order_id"),
        F.when(F.col("event_type") == "order.created", F.lit("created")).otherwise(F.lit("completed")).alias("kind"),
        _get("customerId", F.lit("")).alias("customer_id"),
        _get("items", F.array().cast(ITEMS)).alias("items"),
        _get("total", F.lit(0).cast(AMOUNT)).alias("total"),
        _get("createdAt", F.lit("")).alias("created_at"),
        F.col("seq"),
    )
    return split_valid(rows, {"missing_order_id": F.coalesce(F.col("order_id"), F.lit("")) == "",
                              "missing_seq": F.col("seq").isNull()})


def fold_orders(changes: DataFrame) -> DataFrame:
    """``created`` replaces the whole row with status ``processing``;
    ``completed`` sets only the status, creating a status-only row when the
    order is unknown (Q6).  ``seq`` must be a total order (no NULLs)."""
    created = F.col("kind") == "created"
    fields = F.struct("customer_id", "items", "total", "created_at")
    status = F.when(created, F.lit("processing")).otherwise(F.lit("completed"))
    folded = (changes.groupBy("order_id")
              .agg(F.max_by(fields, F.when(created, F.col("seq"))).alias("_f"),
                   F.max_by(status, F.col("seq")).alias("status")))
    return folded.select("order_id", "status", "_f.customer_id", "_f.items", "_f.total", "_f.created_at")


def inventory_changes(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    inv = dispatch(events, "inventory.updated")
    fields = data_fields(quantity=AMOUNT, updatedAt="string")
    rows = inv.select("event", "_dparsed", "seq", fields.alias("_data")).select(
        F.coalesce(data_fields(itemId="string").itemId, F.lit("")).alias("item_id"),
        _get("quantity", F.lit(0).cast(AMOUNT)).alias("quantity"),
        _get("updatedAt", F.lit("")).alias("updated_at"),
        F.col("seq"),
    )
    return split_valid(rows, {"missing_item_id": F.coalesce(F.col("item_id"), F.lit("")) == "",
                              "missing_seq": F.col("seq").isNull()})


def fold_latest(changes: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Last write wins per key (full-row replace)."""
    cols = [c for c in changes.columns if c not in (key, seq)]
    return (changes.groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.col(seq)).alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def order_outbox(changes: DataFrame) -> DataFrame:
    """One notification per processed order event."""
    created = F.col("kind") == "created"
    status = F.when(created, F.lit("processing")).otherwise(F.lit("completed"))
    # Message texts.
    text = F.when(created, F.concat(F.lit("Order "), F.col("order_id"),
                                    F.lit(" has been created and is being processed")))
    text = text.otherwise(F.concat(F.lit("Order "), F.col("order_id"), F.lit(" has been completed")))
    message = F.to_json(F.struct(F.col("order_id").alias("orderId"), status.alias("status"),
                                 text.alias("message")))
    subject = F.when(created, F.lit(SUBJECT_CREATED)).otherwise(F.lit(SUBJECT_COMPLETED))
    return changes.select(F.col("seq"), subject.alias("subject"), message.alias("message"))


def notification_outbox(events: DataFrame) -> DataFrame:
    """Notification events publish their ``data`` as the message."""
    subject = F.coalesce(F.try_variant_get("data", "$.subject", "string"), F.lit(SUBJECT_NOTIFICATION_DEFAULT))
    return events.select(F.col("seq"), subject.alias("subject"), F.to_json("data").alias("message"))


def outbox(*parts: DataFrame) -> DataFrame:
    """every producer publishes into one topic."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
