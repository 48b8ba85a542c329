"""DuckDB SQL for the similarity join and the removal of repeated strings.

Both compare everything with everything, so they are for small tables.
"""

OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') || ' #' || len(w) ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
    FROM d, generate_series(1, greatest(len(w) - 2, 1)) AS g(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s FROM d, generate_series(0, n - 100) AS g(p) WHERE n >= 100),
f AS (SELECT s, min({'d': doc_id, 'p': p}) AS first FROM w GROUP BY s HAVING count(*) > 1),
r AS (SELECT doc_id, p, p - lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) > 100 AS begins
    FROM w JOIN f ON f.s = w.s WHERE {'d': doc_id, 'p': p} <> f.first),
g AS (SELECT doc_id, p, sum(CAST(begins AS INT)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r),
x AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM g GROUP BY doc_id, run),
k AS (SELECT x.doc_id, x.run, a, b, lag(b, 1, 0) OVER (PARTITION BY x.doc_id ORDER BY run) AS prior FROM x),
t AS (SELECT k.doc_id, count(*) AS n_spans, sum(b - a) AS gone, max(b) AS last,
    string_agg(substr(h, 2 * prior + 1, 2 * (a - prior)), '' ORDER BY run) AS kept FROM k JOIN d ON d.doc_id = k.doc_id GROUP BY k.doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""
