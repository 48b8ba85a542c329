"""DuckDB SQL oracles for the document plans, written from the same fixed
lexicons and patterns the operators use."""

from tidewater.operators.documents import (ENTITY_PATTERN, ENTITY_TYPES, LANGUAGE_ORDER,
                                           NEGATIVE_WORDS, POSITIVE_WORDS, STOP_WORDS)


def _in_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


_STOP_ALL = sorted({w for ws in STOP_WORDS.values() for w in ws})
_TOK = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '')"
_DOCS = f"""docs AS (
  SELECT doc_id, lang, source, text, source || '/doc-' || doc_id || '.txt' AS file_name, {_TOK} AS tok
  FROM documents)"""
_HITS = ",\n         ".join(
    f"len(list_filter(tok, lambda x: x IN {_in_list(STOP_WORDS[l])})) AS h_{l}" for l in LANGUAGE_ORDER)
_G = "greatest(" + ", ".join(f"h_{l}" for l in LANGUAGE_ORDER) + ")"
_LANG_CASE = ("CASE WHEN " + _G + " = 0 THEN 'und' "
              + " ".join(f"WHEN h_{l} = {_G} THEN '{l}'" for l in LANGUAGE_ORDER[:-1])
              + f" ELSE '{LANGUAGE_ORDER[-1]}' END")
_LANG = f"""lang_v AS (
  SELECT *, {_LANG_CASE} AS source_language, CAST({_G} AS INTEGER) AS language_hits
  FROM (SELECT *, {_HITS} FROM docs))"""
_SENT = f"""sent AS (
  SELECT doc_id, n, pos, neg,
         CASE WHEN pos > 0 AND pos = neg THEN 'MIXED' WHEN pos > neg THEN 'POSITIVE'
              WHEN neg > pos THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment
  FROM (SELECT doc_id, len(tok) AS n,
               len(list_filter(tok, lambda x: x IN {_in_list(POSITIVE_WORDS)})) AS pos,
               len(list_filter(tok, lambda x: x IN {_in_list(NEGATIVE_WORDS)})) AS neg FROM docs))"""
_TYPE_CASE = "CASE " + " ".join(
    f"WHEN regexp_matches(e, '{pat}') THEN '{name}'" for name, pat, _ in ENTITY_TYPES) + " END"
_SCORE_CASE = "CASE " + " ".join(
    f"WHEN regexp_matches(e, '{pat}') THEN CAST({score} AS DOUBLE)" for name, pat, score in ENTITY_TYPES) + " END"
_ENT = f"""ents AS (
  SELECT doc_id, CAST(rank AS INTEGER) AS rank, e AS text, {_TYPE_CASE} AS type, {_SCORE_CASE} AS score
  FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS rank, unnest(l) AS e
        FROM (SELECT doc_id, list_slice(regexp_extract_all(text, '{ENTITY_PATTERN}'), 1, 20) AS l FROM docs)))"""
_KP = f"""grams AS (
  SELECT doc_id, unnest(list_filter(
           list_transform(range(1, len(tok)),
                          lambda i: CASE WHEN NOT list_contains({_in_list(_STOP_ALL).replace('(', '[', 1)[:-1]}], tok[i])
                                     AND NOT list_contains({_in_list(_STOP_ALL).replace('(', '[', 1)[:-1]}], tok[i + 1])
                                    THEN tok[i] || ' ' || tok[i + 1] END),
           lambda x: x IS NOT NULL)) AS phrase
  FROM docs),
tf AS (SELECT doc_id, phrase, COUNT(*) AS tf FROM grams GROUP BY ALL),
dfq AS (SELECT phrase, COUNT(*) AS df FROM tf GROUP BY phrase),
scored AS (SELECT tf.doc_id, tf.phrase, tf.tf * ln((SELECT COUNT(*) FROM documents) / dfq.df) AS s
           FROM tf JOIN dfq USING (phrase)),
kp AS (SELECT doc_id, CAST(rank AS INTEGER) AS rank, phrase, round(s, 6) AS score
       FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, phrase) AS rank FROM scored)
       WHERE rank <= 20)"""

SQL = {
    "doc_text": f"""
WITH {_DOCS}
SELECT doc_id, file_name, 'txt' AS file_type, 'direct_read' AS route,
       CAST(length(text) AS INTEGER) AS full_text_length,
       CAST(length(left(text, 5000)) AS INTEGER) AS extracted_length,
       CASE WHEN length(text) > 5000 THEN 'overflow/' || file_name || '_full_text.txt' END AS overflow_path
FROM docs
""",
    "doc_overflow": f"""
WITH {_DOCS}
SELECT doc_id, 'overflow/' || file_name || '_full_text.txt' AS overflow_path,
       CAST(length(text) AS INTEGER) AS full_text_length
FROM docs WHERE length(text) > 5000
""",
    "doc_language": f"""
WITH {_DOCS}, {_LANG}
SELECT doc_id, lang, source_language, language_hits FROM lang_v
""",
    "doc_language_accuracy": f"""
WITH {_DOCS}, {_LANG}
SELECT lang, COUNT(*) AS docs, CAST(count_if(lang = source_language) AS BIGINT) AS correct
FROM lang_v GROUP BY lang
""",
    "doc_sentiment": f"""
WITH {_DOCS}, {_SENT}
SELECT doc_id, sentiment,
       CASE WHEN n > 0 THEN pos / n ELSE 0.0 END AS positive,
       CASE WHEN n > 0 THEN neg / n ELSE 0.0 END AS negative,
       CASE WHEN n > 0 THEN (n - pos - neg) / n ELSE 0.0 END AS neutral,
       CASE WHEN n > 0 THEN least(pos, neg) / n ELSE 0.0 END AS mixed
FROM sent
""",
    "doc_entities": f"""
WITH {_DOCS}, {_ENT}
SELECT * FROM ents
""",
    "doc_key_phrases": f"""
WITH {_DOCS}, {_KP}
SELECT * FROM kp
""",
    "doc_translation_worklist": f"""
WITH {_DOCS}, {_LANG}
SELECT doc_id, source_language, 'es' AS target_language, CAST(length(text) AS INTEGER) AS chars
FROM lang_v WHERE source_language NOT IN ('es', 'und')
""",
    "doc_results": f"""
WITH {_DOCS}, {_LANG}, {_SENT}, {_KP},
kpn AS (SELECT doc_id, COUNT(*) AS n FROM kp GROUP BY doc_id)
SELECT l.file_name, '2024-02-01T00:00:00' AS processed_at, 'txt' AS file_type, s.sentiment, l.source_language,
       CAST(length(l.text) AS BIGINT) AS full_text_length,
       CAST(len(list_slice(regexp_extract_all(l.text, '{ENTITY_PATTERN}'), 1, 20)) AS INTEGER) AS n_entities,
       CAST(COALESCE(kpn.n, 0) AS INTEGER) AS n_phrases
FROM lang_v l JOIN sent s USING (doc_id) LEFT JOIN kpn USING (doc_id)
""",
    "doc_result_page": f"""
WITH {_DOCS}, {_LANG}, {_SENT}
SELECT l.file_name, '2024-02-01T00:00:00' AS processed_at, s.sentiment, l.source_language
FROM lang_v l JOIN sent s USING (doc_id)
ORDER BY l.file_name LIMIT 100
""",
    "doc_part_results": f"""
WITH {_DOCS}, {_LANG}, {_SENT},
p AS (SELECT l.*, s.sentiment AS label, doc_id % 20 AS k FROM lang_v l JOIN sent s USING (doc_id)),
q AS (SELECT *, CASE k WHEN 3 THEN 'no content' WHEN 5 THEN 'invalid UTF-8' WHEN 7 THEN 'no reader for xyz' END AS text_error,
             k = 9 OR text = '' AS blank FROM p),
r AS (SELECT *, CASE WHEN text_error IS NULL AND blank THEN 'empty text' END AS analysis_error,
             CASE WHEN text_error IS NOT NULL THEN NULL WHEN blank THEN 'empty text'
                  WHEN source_language = 'und' THEN 'language not detected' END AS translation_error FROM q)
SELECT doc_id, CASE WHEN k = 7 THEN replace(file_name, '.txt', '.xyz') ELSE file_name END AS file_name,
       CASE WHEN text_error IS NOT NULL THEN 'ERROR' WHEN coalesce(analysis_error, translation_error) IS NOT NULL THEN 'PARTIAL'
            ELSE 'PROCESSED' END AS status, text_error,
       CASE WHEN text_error IS NULL THEN CASE WHEN blank THEN 0 ELSE CAST(length(text) AS INTEGER) END END AS full_text_length,
       analysis_error, CASE WHEN text_error IS NULL AND NOT blank THEN label END AS sentiment, translation_error,
       CASE WHEN text_error IS NULL AND translation_error IS NULL THEN source_language END AS source_language,
       CASE WHEN text_error IS NULL AND translation_error IS NULL AND source_language <> 'es' THEN 'es' END AS target_language
FROM r
""",
}
