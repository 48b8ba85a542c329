"""DuckDB SQL oracles for the metrics plans (same column names and types)."""

TS = "'%Y-%m-%dT%H:%M:%S.%f'"

SQL = {
    "stream_metrics": f"""
SELECT CAST(user_id AS VARCHAR) AS partition_key,
       COUNT(*) AS "count",
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) AS total_value,
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) / COUNT(*) AS average_value,
       strftime(arg_min(date_trunc('millisecond', ts), event_id), {TS}) AS first_arrival,
       strftime(arg_max(date_trunc('millisecond', ts), event_id), {TS}) AS last_arrival,
       CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) + 2592000 AS ttl
FROM events GROUP BY user_id
""",
    "stream_metrics_hourly": f"""
SELECT strftime(date_trunc('hour', ts), {TS}) AS batch_hour,
       CAST(user_id AS VARCHAR) AS partition_key,
       COUNT(*) AS "count",
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) AS total_value,
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) / COUNT(*) AS average_value,
       strftime(arg_min(date_trunc('millisecond', ts), event_id), {TS}) AS first_arrival,
       strftime(arg_max(date_trunc('millisecond', ts), event_id), {TS}) AS last_arrival,
       CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) + 2592000 AS ttl
FROM events GROUP BY date_trunc('hour', ts), user_id
""",
    "windowed_metrics": f"""
SELECT strftime(date_trunc('day', ts), {TS}) AS window_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, {TS}) AS window_end,
       event_type,
       COUNT(*) AS "count",
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) AS total_value,
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) / COUNT(*) AS average_value
FROM events GROUP BY date_trunc('day', ts), event_type
""",
    "error_alerts": f"""
SELECT strftime(date_trunc('hour', ts), {TS}) AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, {TS}) AS window_end,
       CAST(count_if(event_type = 'error') AS BIGINT) AS errors,
       COUNT(*) AS records
FROM events GROUP BY date_trunc('hour', ts)
HAVING count_if(event_type = 'error') >= 5
""",
    "archive_partitions": """
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,
       COUNT(*) AS records, COUNT(DISTINCT user_id) AS keys
FROM events GROUP BY ALL
""",
    "stream_quarantine": """
SELECT CASE event_id % 20 WHEN 0 THEN 'bad_base64' WHEN 1 THEN 'bad_json' WHEN 2 THEN 'value_range'
       WHEN 4 THEN 'arrival' WHEN 5 THEN 'bad_value' ELSE 'valid' END AS reason, COUNT(*) AS n_rows
FROM events GROUP BY 1
""",
    "stream_dirty_metrics": """
WITH e AS (SELECT *, CASE WHEN event_id % 20 IN (2, 5) THEN 0 WHEN event_id % 20 = 3 THEN 0.000000004::DECIMAL(28,9)
                     ELSE CAST(value AS DECIMAL(28,9)) END AS v FROM events WHERE event_id % 20 > 1)
SELECT CAST(user_id AS VARCHAR) AS partition_key, COUNT(*) AS "count", CAST(SUM(v) AS DOUBLE) AS total_value,
       CAST(SUM(v) AS DOUBLE) / COUNT(*) AS average_value
FROM e GROUP BY user_id
""",
    "stream_dirty_audit": """
SELECT COUNT(*) FILTER (event_id % 20 NOT IN (0, 1, 2, 4, 5)) AS processed,
       COUNT(DISTINCT user_id) FILTER (event_id % 20 > 1) AS aggregated,
       COUNT(*) FILTER (event_id % 20 IN (0, 1, 2, 4, 5)) AS errors
FROM events
""",
    "stream_audit": """
SELECT COUNT(value) AS processed, COUNT(DISTINCT user_id) AS aggregated, COUNT(*) - COUNT(value) AS errors
FROM events
""",
    "metrics_live": """
WITH m AS (SELECT user_id, date_trunc('hour', ts) AS h, COUNT(*) AS c FROM events GROUP BY ALL)
SELECT CAST(user_id AS VARCHAR) AS partition_key, COUNT(*) AS live_rows,
       CAST(SUM(c) AS BIGINT) AS live_records
FROM m
WHERE CAST(epoch(h) AS BIGINT) + 2592000 > CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT)
GROUP BY user_id
""",
    "archive_tiers": """
WITH d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS rows FROM events GROUP BY ALL),
a AS (SELECT day, rows, CAST(date_diff('day', day, DATE '2024-03-15') AS INTEGER) AS age_days FROM d)
SELECT strftime(day, '%Y-%m-%d') AS day, rows, age_days,
       CASE WHEN age_days >= 120 THEN 'GLACIER' WHEN age_days >= 30 THEN 'STANDARD_IA'
            WHEN age_days >= 0 THEN 'STANDARD' END AS tier,
       age_days >= 60 AS expired
FROM a
""",
}
