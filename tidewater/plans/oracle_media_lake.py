"""DuckDB SQL oracles for the media and lake plans."""

from tidewater.plans.media_lake_plans import ASSET_EXTENSIONS

_EXT = "[" + ", ".join(f"'{e}'" for e in ASSET_EXTENSIONS) + "]"

_MEDIA = f"""f AS (
  SELECT vec_id, 'asset-' || vec_id || '.' || {_EXT}[label + 1] AS fileName,
         lower({_EXT}[label + 1]) AS ext FROM embeddings),
ft AS (SELECT *, CASE WHEN ext IN ('jpg', 'jpeg', 'png') THEN 'image'
                      WHEN ext IN ('mp4', 'mov', 'avi') THEN 'video' END AS type FROM f),
det AS (SELECT vec_id, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS conf FROM embeddings),
lab AS (SELECT vec_id, 'label-' || lpad(CAST(pos AS VARCHAR), 2, '0') AS label, conf FROM det),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY conf DESC, label) AS rk FROM lab),
res AS (
  SELECT ft.fileName, ft.type,
         CASE WHEN ft.type = 'image' THEN 'IMAGE_PROCESSED' WHEN ft.type = 'video' THEN 'VIDEO_PROCESSED'
              ELSE 'UNSUPPORTED' END AS status,
         CASE WHEN ft.type = 'image' THEN (SELECT string_agg(label, '|' ORDER BY rk) FROM ranked r
                                           WHERE r.vec_id = ft.vec_id AND rk <= 5)
              WHEN ft.type = 'video' THEN (SELECT string_agg(label, '|' ORDER BY rk) FROM ranked r
                                           WHERE r.vec_id = ft.vec_id) END AS labels,
         CASE WHEN ft.type = 'image' THEN 5 WHEN ft.type = 'video' THEN 64 ELSE -1 END AS n_labels
  FROM ft)"""

SQL = {
    "media_results": f"""
WITH {_MEDIA}
SELECT fileName, type, status,
       CAST(CASE WHEN type IS NULL THEN NULL ELSE n_labels END AS INTEGER) AS n_labels, labels
FROM res
""",
    "media_notification_counts": f"""
WITH {_MEDIA}
SELECT 'Media Processing Result' AS subject, status, COUNT(*) AS messages FROM res GROUP BY status
""",
    "lake_ingest_summary": """
SELECT TRUE AS is_json, '2024' AS year, '02' AS month, '01' AS day, '00' AS hour, COUNT(*) AS files FROM part
UNION ALL
SELECT FALSE, '2024', '02', '01', '00', COUNT(*) FROM pages
""",
    "lake_category_stats": """
SELECT p_type AS category, COUNT(*) AS items,
       CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_price
FROM part GROUP BY p_type
""",
    "lake_count": "SELECT COUNT(*) AS n FROM part",
    "lake_sample": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_type AS category, p_retailprice AS price
FROM part ORDER BY CAST(p_partkey AS VARCHAR) LIMIT 10
""",
    "lake_partition_query": """
SELECT strftime(ts, '%d') AS day, COUNT(*) AS files,
       CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total
FROM events WHERE strftime(ts, '%Y') = '2024' AND strftime(ts, '%m') = '01'
GROUP BY 1
""",
    "lake_two_batches": """
SELECT '1' AS batch, TRUE AS is_json, COUNT(*) AS files, COUNT(DISTINCT p_partkey) AS names, COUNT(p_retailprice) AS prices FROM part
UNION ALL
SELECT '2', FALSE, COUNT(*), COUNT(DISTINCT page_id), 0 FROM pages
""",
    "lake_partition_prune": """
SELECT strftime(ts, '%H') AS hour, COUNT(*) AS files,
       CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total
FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15' GROUP BY 1
""",
}
