"""Business events (FIXTURES section 4)."""

import json

from pyspark.sql import functions as F

from tidewater.operators import events as ev

CREATED = {"source": "orders", "detail-type": "Order Created",
           "detail": {"eventType": "order.created",
                      "data": {"orderId": "o-1", "customerId": "c9",
                               "items": [{"productId": "p7", "quantity": 2, "price": 4.25},
                                         {"productId": "p8", "quantity": 1, "price": 11.5}],
                               "total": 20.0, "createdAt": "2023-06-02T10:00:00Z"}}}
COMPLETED = {"source": "orders", "detail-type": "Order Completed",
             "detail": json.dumps({"eventType": "order.completed",
                                   "data": {"orderId": "o-1", "completedAt": "2023-06-02T11:00:00Z"}})}
INVENTORY = {"source": "inventory", "detail-type": "Inventory Updated",
             "detail": {"eventType": "inventory.updated",
                        "data": {"itemId": "i5", "quantity": 42, "updatedAt": "2023-06-02T10:00:00Z"}}}
NOTE = {"source": "notifications", "detail-type": "Notification Sent",
        "detail": {"data": {"id": "n3", "subject": "Quay closed", "message": "hi",
                            "priority": "high", "timestamp": "2023-06-02T10:00:00Z"}}}
WORKFLOW = {"source": "workflow", "detail-type": "Workflow Triggered", "detail": {}}


def _bus(spark, evs):
    rows = [(json.dumps(e), i) for i, e in enumerate(evs)]
    return spark.createDataFrame(rows, "j string, seq int").select(F.parse_json("j").alias("event"), "seq")


def _routed(spark, evs):
    norm, bad = ev.normalise(_bus(spark, evs))
    return ev.route(ev.parse_detail(norm), ev.rules_frame(spark)), bad


def test_order_lifecycle_and_outbox(spark):
    routed, _ = _routed(spark, [CREATED, COMPLETED, INVENTORY, NOTE, WORKFLOW])
    orders = routed.filter(F.col("target") == "order_processor")
    changes, bad = ev.order_changes(orders)
    st = ev.fold_orders(changes).collect()
    assert len(st) == 1 and st[0].status == "completed" and len(st[0]["items"]) == 2
    assert float(st[0].total) == 20.0 and st[0].customer_id == "c9"
    inv, _ = ev.inventory_changes(routed.filter(F.col("target") == "inventory_processor"))
    assert [float(r.quantity) for r in ev.fold_latest(inv, "item_id").collect()] == [42.0]
    notes = routed.filter(F.col("target") == "notification_processor")
    box = ev.outbox(ev.order_outbox(changes), ev.notification_outbox(notes)).collect()
    assert sorted(r.subject for r in box) == ["New Order Created", "Order Completed", "Quay closed"]
    # the workflow event reaches both processors and is ignored as unknown type
    assert routed.filter(F.col("source") == "workflow").count() == 2


def test_completed_only_and_redelivery(spark):
    c2 = json.loads(json.dumps(CREATED))
    c2["detail"]["data"]["orderId"] = "o-2"
    done_only = {"source": "orders", "detail-type": "Order Completed",
                 "detail": {"eventType": "order.completed", "data": {"orderId": "o-3"}}}
    empty_id = {"source": "orders", "detail-type": "Order Created",
                "detail": {"eventType": "order.created", "data": {"orderId": ""}}}
    unknown = {"source": "orders", "detail-type": "Order Created", "detail": {"eventType": "order.lost"}}
    routed, _ = _routed(spark, [CREATED, COMPLETED, CREATED, done_only, empty_id, unknown, c2])
    changes, bad = ev.order_changes(routed)
    st = {r.order_id: r for r in ev.fold_orders(changes).collect()}
    assert st["o-1"].status == "processing"          # created again after completed (Q6)
    assert st["o-3"].status == "completed" and st["o-3"].customer_id is None
    assert bad.count() == 1 and set(st) == {"o-1", "o-2", "o-3"}


def test_envelope_forms_and_broken_body(spark):
    wrapped = {"Records": [{"body": json.dumps(INVENTORY)}, {"body": "{broken"}, INVENTORY]}
    norm, bad = ev.normalise(_bus(spark, [wrapped, INVENTORY]))
    assert norm.count() == 3 and bad.count() == 1
    unmatched = {"source": "elsewhere", "detail-type": "Order Created", "detail": {}}
    routed, _ = _routed(spark, [unmatched])
    assert routed.count() == 0


def test_absent_null_and_odd_fields(spark):
    def order(**data):
        return {"source": "orders", "detail-type": "Order Created", "detail": {"eventType": "order.created", "data": data}}

    as_text = {**COMPLETED, "detail": json.dumps({"eventType": "order.created", "data": {"orderId": "t", "customerId": None, "total": "x"}})}
    evs = [order(orderId="a"), order(orderId="b", customerId=None, items=None, total=None, createdAt=None), as_text,
           {**CREATED, "detail": {"eventType": "order.created", "data": [1]}}, {"Records": [{"body": json.dumps(order(orderId="w"))}, 3]},
           {**CREATED, "detail": {"eventType": None, "data": {}}}, {"Records": None}, "text", None, {"body": "{broken"}, {"x": 1}]
    norm, bad = ev.normalise(_bus(spark, evs))
    assert sorted(r[0][0] for r in bad.select("reasons").collect()) == ["bad_body", "bad_records", "not_an_object", "not_an_object", "not_an_object"]
    parsed = ev.parse_detail(norm)
    assert sorted(r.event_type for r in parsed.collect()) == ["", ""] + ["order.created"] * 5
    ok, no_id = ev.order_changes(parsed)
    got = {r.order_id: (r.customer_id, r["items"], None if r.total is None else float(r.total), r.created_at) for r in ok.collect()}
    assert got == {"a": ("", [], 0.0, ""), "b": (None, None, None, None), "t": (None, [], None, ""), "w": ("", [], 0.0, "")}
    assert no_id.count() == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_event_costs_no_failed_lookups_and_no_interpreted_lists(spark):
    norm, _ = ev.normalise(_bus(spark, [CREATED]))
    known, _ = ev.split_events(ev.parse_detail(norm))
    changes, _ = ev.order_changes(known)
    notes = _plan(ev.order_outbox(changes))
    assert "lambdafunction" not in notes            # an array function is interpreted row by row
    assert "$['Records']" not in notes and "customerId" not in notes and "productId" not in notes
