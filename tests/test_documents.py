"""Document annotation (FIXTURES section 6)."""

import math
import random
import re
from collections import Counter
from itertools import pairwise

import numpy as np
from pyspark.sql import functions as F

from tidewater.operators import documents as D

SAMPLE = ("This is a sample document for testing AI services.\n"
          "It contains multiple sentences and paragraphs.\n"
          "The document discusses cloud computing and serverless architecture.\n"
          "AWS Lambda is a great service for running code without managing servers.\n"
          "Amazon S3 provides scalable object storage.\n"
          "Contact ops@example.com or 10.0.0.1 before 2024-01-15 about 42 items.")


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, file_name string, text string")


def test_file_routes_and_overflow(spark):
    rows = [(1, "a.txt", "x" * 5000), (2, "b.TXT", "y" * 5001), (3, "noext", ""), (4, "c.tiff", "z"),
            (5, "scan.pdf", "p")]
    d = D.extract_text(D.classify_files(_docs(spark, rows)))
    got = {r.doc_id: (r.file_type, r.route, r.full_text_length, r.overflow_path) for r in d.collect()}
    assert got[1] == ("txt", "direct_read", 5000, None)
    assert got[2] == ("txt", "direct_read", 5001, "overflow/b.TXT_full_text.txt")
    assert got[3][1] == "unsupported" and got[4][1] == "unsupported" and got[5][1] == "ocr"
    assert [r.doc_id for r in D.overflow(d).collect()] == [2]


def test_language_sentiment_entities(spark):
    rows = [(1, "s.txt", SAMPLE), (2, "f.txt", "le chat et la souris sont dans la maison avec les amis"),
            (3, "e.txt", "el perro y los gatos en la casa con las flores"), (4, "n.txt", "")]
    d = D.entities(D.sentiment(D.detect_language(_docs(spark, rows))))
    got = {r.doc_id: r for r in d.collect()}
    assert got[1].source_language == "en" and got[2].source_language == "fr"
    assert got[3].source_language == "es" and got[4].source_language == "und"
    assert got[1].sentiment == "POSITIVE" and got[4].sentiment == "NEUTRAL"
    ents = [(e.text, e.type) for e in got[1].entities]
    assert ("ops@example.com", "EMAIL") in ents and ("10.0.0.1", "IP_ADDRESS") in ents
    assert ("2024-01-15", "DATE") in ents and ("42", "QUANTITY") in ents
    work = D.translation_worklist(D.detect_language(_docs(spark, rows)))
    assert sorted(r.doc_id for r in work.collect()) == [1, 2]


def test_key_phrases_and_results(spark):
    rows = [(1, "a.txt", "cloud computing rocks. cloud computing scales"), (2, "b.txt", "object storage scales")]
    docs = _docs(spark, rows)
    kp = D.key_phrases(docs).collect()
    top1 = [r.phrase for r in sorted([r for r in kp if r.doc_id == 1], key=lambda r: r["rank"])]
    assert top1[0] == "cloud computing"
    d = D.entities(D.sentiment(D.detect_language(D.extract_text(D.classify_files(docs)))))
    res = D.to_result_row(D.assemble(d, D.key_phrases(d), "2024-01-16 00:00:00"))
    assert res.count() == 2
    page = D.latest_result(res, limit=1).collect()
    assert [r.file_name for r in page] == ["a.txt"]
    one = D.latest_result(res, file_name="b.txt").collect()
    assert len(one) == 1 and one[0].file_name == "b.txt"


def test_a_failed_part_leaves_the_others(spark):
    rows = [(1, "a.txt", b"The cloud is great and it scales"), (2, "b.txt", b"cut \xc3"), (3, "c.txt", None), (4, "d.txt", b""),
            (5, "e.xyz", b"the text"), (6, "f.txt", b"123 456"), (7, "g.txt", "el perro y la casa de los ni\u00f1os".encode())]
    files = D.classify_files(spark.createDataFrame(rows, "doc_id long, file_name string, content binary"))
    got = {r.doc_id: r for r in D.part_results(files).collect()}
    assert {k: r.status for k, r in got.items()} == {1: "PROCESSED", 2: "ERROR", 3: "ERROR", 4: "PARTIAL", 5: "ERROR", 6: "PARTIAL", 7: "PROCESSED"}
    assert [got[k].text_part.error for k in range(1, 8)] == [None, "invalid UTF-8", "no content", None, "no reader for xyz", None, None]
    assert got[2].analysis_part is None and got[2].translation_part is None and got[2].text_part.value is None
    assert got[1].translation_part.value == ("en", "es") and got[7].translation_part.value == ("es", None)
    assert got[6].analysis_part.value.sentiment == "NEUTRAL" and got[6].translation_part.error == "language not detected"
    assert got[4].text_part.value.full_text_length == 0 and got[4].analysis_part.error == "empty text"
    assert D.part_results(files.limit(0)).count() == 0


def test_key_phrases_match_a_plain_count(spark, monkeypatch):
    """Ids that repeat or are null, null and empty texts, tokens in pieces."""
    monkeypatch.setattr(D, "_PIECE", 5)
    rows = [(1, "x", "blue sky, blue sky; blue sea"), (1, "x", "blue sky of red sea 9 red sea"), (None, "x", "red sea blue"),
            (2, "x", None), (3, "x", ""), (4, "x", "the"), (8, "x", ""), (9, "x", ""), (5, "x", "...blue sky!"), (6, "x", "\u00c9t\u00e9 long \u00e9t\u00e9 LONG"),
            (7, "x", " ".join(f"w{chr(97 + i)} z{chr(97 + i)}" for i in range(20)))]
    stop = {w for ws in D.STOP_WORDS.values() for w in ws}
    counts = []
    for k, _, text in rows:
        tok = re.findall(r"[^\W\d_]+", (text or "").lower())
        counts.append((k, Counter(f"{a} {b}" for a, b in pairwise(tok) if not {a, b} & stop)))
    df = Counter(p for _, c in counts for p in c)
    want = []
    for k in {k for k, _ in counts}:
        own = sorted((-n * math.log(len(rows) / df[p]), p) for i, c in counts if i == k for p, n in c.items())
        want += [(k, r, p, round(-s, 6) + 0.0) for r, (s, p) in enumerate(own[:20], 1)]
    for docs in (_docs(spark, rows), D.with_tokens(_docs(spark, rows))):
        got = [tuple(r) for r in D.key_phrases(docs).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert D.key_phrases(_docs(spark, rows).limit(0)).count() == 0


def test_key_phrases_sort_rows_once_after_each_shuffle(spark):
    """No row is sorted for the ranking before it is dealt out, and only repeated phrases are joined."""
    plan = D.key_phrases(_docs(spark, [(1, "x", "blue sky")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("RepartitionByExpression") < plan.index("Join LeftOuter")
    assert "(df" in plan and "> 1)" in plan


def test_key_phrases_of_several_pages_shuffle_no_phrase_before_the_ranking(spark):
    """Frequencies over pages of several tasks, in many parts; frequent phrases, and more equal scores than are kept."""
    rng = random.Random(5)
    words = [a + b for a in "bcdfgh" for b in "aeiouy"]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k % 7 * 30)) + " hot spot" * (k % 3) + f" q{'abcdefghij'[k % 10]} end"
    rows = [(k // 2, "x", text(k)) for k in range(60)]
    counts = []
    for k, _, t in rows:
        tok = re.findall(r"[a-z]+", t)
        counts.append((k, Counter(f"{a} {b}" for a, b in pairwise(tok) if not {a, b} & {w for ws in D.STOP_WORDS.values() for w in ws})))
    df = Counter(p for _, c in counts for p in c)
    want = []
    for k in {k for k, _ in counts}:
        own = sorted((-n * math.log(len(rows) / df[p]), p) for i, c in counts if i == k for p, n in c.items())
        want += [(k, r, p, round(-s, 6) + 0.0) for r, (s, p) in enumerate(own[:20], 1)]
    found = D.key_phrases(_docs(spark, rows).repartition(5))
    assert sorted(map(tuple, found.collect())) == sorted(want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "phrase#" not in plan[plan.index("Join LeftOuter"):]


def test_numbers_are_packed_and_unpacked():
    arrays = [np.array(x, np.int64) for x in ([], [0, 1, 255, 256, (1 << 32) - 1], [7])]
    assert [x.tolist() for x in D._unpacked(D._packed(*arrays), 0, 5, 1)] == [x.tolist() for x in arrays]
