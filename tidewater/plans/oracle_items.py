"""DuckDB SQL oracles for the item catalogue and keyed-read plans."""

_CMDS = """
cmds AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, 'create' AS op, TIMESTAMP '1994-06-01 00:00:00' AS t, 0 AS ph,
         p_partkey AS k, 0 AS line,
         p_name AS name, TRUE AS d_name, p_type AS description, TRUE AS d_desc,
         'active' AS status, TRUE AS d_status, CAST(p_retailprice AS DECIMAL(18,2)) AS price, TRUE AS d_price,
         p_brand || ',' || p_type AS tags, TRUE AS d_tags
  FROM part
  UNION ALL
  SELECT CAST(l_partkey AS VARCHAR), 'update', l_shipdate, 1, l_orderkey, l_linenumber,
         NULL, FALSE, NULL, FALSE, 'returned', TRUE, CAST(l_extendedprice AS DECIMAL(18,2)), TRUE, NULL, FALSE
  FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT CAST(l_partkey AS VARCHAR), 'delete', l_shipdate, 1, l_orderkey, l_linenumber,
         NULL, TRUE, NULL, TRUE, NULL, TRUE, NULL, TRUE, NULL, TRUE
  FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, ph, k, line) AS rk FROM cmds),
state AS (
  SELECT id,
         arg_max_null(name, rk) FILTER (WHERE d_name) AS name,
         arg_max_null(description, rk) FILTER (WHERE d_desc) AS description,
         arg_max_null(status, rk) FILTER (WHERE d_status) AS status,
         arg_max_null(price, rk) FILTER (WHERE d_price) AS price,
         arg_max_null(tags, rk) FILTER (WHERE d_tags) AS tags,
         arg_max_null(CASE WHEN op = 'create' THEN t END, rk) FILTER (WHERE op <> 'update') AS created_at,
         arg_max(t, rk) AS updated_at,
         arg_max(op, rk) AS last_op
  FROM ranked GROUP BY id
),
flat AS (
  SELECT id, name, description, status, CAST(price AS DOUBLE) AS price, tags,
         strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS created_at,
         strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%f') AS updated_at
  FROM state WHERE last_op <> 'delete'
)"""

SQL = {
    "item_catalog": f"WITH {_CMDS} SELECT * FROM flat",
    "items_active_page": f"WITH {_CMDS} SELECT * FROM flat WHERE status = 'returned' ORDER BY id LIMIT 100",
    "item_delete_counts": f"""
WITH {_CMDS},
keys AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem
         WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'))
SELECT 'survivors' AS outcome, COUNT(*) AS items FROM flat WHERE id NOT IN (SELECT id FROM keys)
UNION ALL
SELECT 'deleted', COUNT(*) FROM flat WHERE id IN (SELECT id FROM keys)
UNION ALL
SELECT 'not_found', COUNT(*) FROM keys WHERE id NOT IN (SELECT id FROM flat)
""",
    "latest_event_per_user": """
SELECT user_id, strftime(arg_max(ts, (ts, event_id)), '%Y-%m-%dT%H:%M:%S.%f') AS ts,
       arg_max(event_id, (ts, event_id)) AS event_id,
       arg_max(event_type, (ts, event_id)) AS event_type,
       arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id
""",
    "user_recent_events": """
SELECT user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, event_id, event_type, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events)
WHERE rank <= 3
""",
    "order_customer_lookup": """
SELECT o.o_custkey AS c_custkey, o.o_orderkey, c.c_name, c.c_mktsegment, c.c_custkey IS NOT NULL AS found
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""",
    "orders_by_status": """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS created_at
FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderkey LIMIT 100
""",
}
