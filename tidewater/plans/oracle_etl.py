"""DuckDB SQL oracles for the ETL plans."""

_LI = """li AS (SELECT l_orderkey, COUNT(*) AS cnt,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
               FROM lineitem GROUP BY l_orderkey)"""

_DIRTY = """a AS (SELECT o_orderkey AS k, o_totalprice, o_orderpriority, o_orderdate,
       CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS n FROM orders),
d AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') || CASE k % 4 WHEN 0 THEN 'T00:00:00Z' WHEN 1 THEN ' 00:00:00+00:00'
       WHEN 2 THEN 'T00:00:00.000' ELSE ' 00:00:00' END AS stamp
      FROM a WHERE o_orderdate >= TIMESTAMP '1996-01-02' AND o_orderdate < TIMESTAMP '1996-01-03')"""

SQL = {
    "etl_daily": f"""
WITH o AS (SELECT * FROM orders
           WHERE o_orderdate >= TIMESTAMP '1996-01-02 00:00:00' AND o_orderdate < TIMESTAMP '1996-01-03 00:00:00'),
{_LI}
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' AS timestamp,
       '1996-01-03T00:00:00Z' AS processed_at,
       o_totalprice AS value, cnt AS count,
       CASE WHEN cnt > 0 THEN total / cnt END AS average,
       o_orderpriority AS location, o_orderstatus AS status
FROM o LEFT JOIN li ON li.l_orderkey = o.o_orderkey
""",
    "etl_stage_all": f"""
WITH {_LI}
SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
       strftime(o_orderdate, '%d') AS day, COUNT(*) AS records,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value_total,
       CAST(SUM(cnt) AS BIGINT) AS lines
FROM orders LEFT JOIN li ON li.l_orderkey = orders.o_orderkey
GROUP BY ALL
""",
    "etl_load": f"""
WITH {_DIRTY}
SELECT CAST(k AS VARCHAR) AS id, stamp AS timestamp, '1996-01-03T00:00:00Z' AS processed_at, o_totalprice AS value,
       o_orderpriority || CASE WHEN k % 7 = 0 THEN '/1' ELSE '/0' END AS location, '__bad_number__' AS note
FROM d WHERE k % 17 <> 0 AND k % 11 <> 0 AND k % 13 <> 0
""",
    "etl_rejects": f"""
WITH {_DIRTY}, r AS (
SELECT 'extract' AS step, 'bad_timestamp' AS reason, n FROM a WHERE k % 17 = 0
UNION ALL SELECT 'transform', 'bad_number', n FROM d WHERE k % 17 <> 0 AND k % 11 = 0
UNION ALL SELECT 'load', 'missing_id', n FROM d WHERE k % 17 <> 0 AND k % 11 <> 0 AND k % 13 = 0)
SELECT step, reason, CAST(SUM(n) AS BIGINT) AS n_rows FROM r GROUP BY step, reason
""",
    "etl_audit": f"""
WITH {_DIRTY}, c AS (SELECT coalesce(sum(n) FILTER (k % 17 <> 0), 0) AS e, coalesce(sum(n) FILTER (k % 17 <> 0 AND k % 11 <> 0), 0) AS t,
  coalesce(sum(n) FILTER (k % 17 <> 0 AND k % 11 <> 0 AND k % 13 <> 0), 0) AS l FROM d),
b AS (SELECT coalesce(sum(n), 0) AS n FROM a WHERE k % 17 = 0)
SELECT 'extract' AS step, CAST(e AS BIGINT) AS processed, CAST(b.n AS BIGINT) AS errors, CASE WHEN b.n > 0 THEN 'bad_timestamp' ELSE '' END AS first_errors FROM c, b
UNION ALL SELECT 'transform', CAST(t AS BIGINT), CAST(e - t AS BIGINT), CASE WHEN e > t THEN 'bad_number' ELSE '' END FROM c
UNION ALL SELECT 'load', CAST(l AS BIGINT), CAST(t - l AS BIGINT), CASE WHEN t > l THEN 'missing_id' ELSE '' END FROM c
""",
}
