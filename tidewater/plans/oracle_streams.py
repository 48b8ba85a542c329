"""DuckDB SQL oracles for the plans that run streams or change a stored table."""

from tidewater.plans.oracle_chat import SQL as CHAT
from tidewater.plans.oracle_events import SQL as EVENTS

TS = "'%Y-%m-%dT%H:%M:%S.%f'"

SQL = {
    "stream_record_metrics": """
SELECT CAST(user_id AS VARCHAR) AS partition_key, COUNT(*) AS "count",
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) AS total_value, CAST(0 AS BIGINT) AS over
FROM events GROUP BY user_id
""",
    # Late: behind the watermark that the batches before the one before left.
    "windowed_stream_append": f"""
WITH n AS (SELECT COUNT(*) AS n FROM events),
d AS (SELECT e.*, date_trunc('millisecond', ts) AS arr, (event_id + CASE WHEN event_id % 25 = 3 THEN n // 4 ELSE 0 END) * 10
        + CASE WHEN event_id % 25 = 3 THEN 1 ELSE 0 END AS seq FROM events e, n),
log AS (SELECT *, row_number() OVER (ORDER BY again, seq) - 1 AS pos FROM (
        SELECT *, 0 AS again FROM d UNION ALL SELECT *, 1 FROM d WHERE event_id % 10 = 0)),
b AS (SELECT log.*, pos // ((n + 6) // 7) AS batch FROM log, n),
tops AS (SELECT batch, max(max(arr)) OVER (ORDER BY batch) - INTERVAL 2 DAY AS mark FROM b GROUP BY batch),
kept AS (SELECT b.* FROM b LEFT JOIN tops ON tops.batch = b.batch - 2 WHERE again = 0 AND (tops.mark IS NULL OR b.arr >= tops.mark))
SELECT strftime(date_trunc('day', arr), {TS}) AS window_start, strftime(date_trunc('day', arr) + INTERVAL 1 DAY, {TS}) AS window_end,
       CAST(user_id AS VARCHAR) AS partition_key, COUNT(*) AS "count", CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) AS total_value
FROM kept WHERE date_trunc('day', arr) + INTERVAL 1 DAY <= (SELECT max(mark) FROM tops)
GROUP BY date_trunc('day', arr), user_id
""",
    "order_state_stream": EVENTS["order_state"],
    "inventory_state_stream": EVENTS["inventory_state"],
    "chat_presence_stream": CHAT["chat_presence"],
    "order_table_upserts": """
SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 11 = 0 THEN 'released' ELSE o_orderstatus END AS status,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total
FROM orders WHERE o_orderkey % 13 <> 0
UNION ALL
SELECT -o_orderkey, 'new', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) FROM orders WHERE o_orderkey % 17 = 0
""",
}
