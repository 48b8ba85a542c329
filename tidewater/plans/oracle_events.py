"""DuckDB SQL oracles for the event-routing plans."""

SQL = {
    "order_state": """
WITH li AS (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'processing' END AS status,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(COALESCE(n, 0) AS INTEGER) AS n_items,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created_at
FROM orders LEFT JOIN li ON li.l_orderkey = orders.o_orderkey
""",
    "inventory_state": """
SELECT CAST(l_partkey AS VARCHAR) AS item_id,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
                                   ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
      FROM lineitem)
WHERE rn = 1
""",
    "notification_outbox": """
SELECT 'New Order Created' AS subject,
       '{"orderId":"' || o_orderkey || '","status":"processing","message":"Order ' || o_orderkey
       || ' has been created and is being processed"}' AS message
FROM orders
UNION ALL
SELECT 'Order Completed' AS subject,
       '{"orderId":"' || o_orderkey || '","status":"completed","message":"Order ' || o_orderkey
       || ' has been completed"}' AS message
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'Urgent order' AS subject,
       '{"id":"NOTIF-' || o_orderkey || '","message":"Order ' || o_orderkey || ' is urgent","priority":"high",'
       || '"subject":"Urgent order","timestamp":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '"}' AS message
FROM orders WHERE o_orderpriority = '1-URGENT'
""",
    "routed_counts": """
SELECT 'order_processor' AS target, 'order.created' AS event_type, COUNT(*) AS events FROM orders
UNION ALL
SELECT 'order_processor', 'order.completed', COUNT(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'inventory_processor', 'inventory.updated', COUNT(*) FROM lineitem
UNION ALL
SELECT 'notification_processor', '', COUNT(*) FROM orders WHERE o_orderpriority = '1-URGENT'
""",
    "event_quarantine": """
WITH e AS (SELECT unnest(CASE o_orderkey % 20 WHEN 0 THEN ['bad_records'] WHEN 1 THEN ['bad_records'] WHEN 2 THEN ['bad_detail']
  WHEN 3 THEN ['unknown_type'] WHEN 4 THEN ['missing_order_id'] WHEN 5 THEN ['bad_body', 'accepted'] WHEN 6 THEN ['not_an_object']
  WHEN 7 THEN ['missing_seq'] ELSE ['accepted'] END) AS outcome FROM orders)
SELECT outcome, COUNT(*) AS events FROM e GROUP BY outcome
""",
}
