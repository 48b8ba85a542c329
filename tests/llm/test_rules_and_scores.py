"""Rule statistics, language model and classifiers."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import frame
from tidewater.llm import lm_score, quality_classifier, quality_rules, toxicity

SF = "/root/testdata/sf0.01"


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_rule_counts_equal_brute_force(spark, edge_rows):
    texts = [t for _, t in edge_rows] + ["a\na\n\nb\na", "x|y #*$%&<> é", "a b c a b c", "a b c d a b", "\n\n \n", "é é é é"]
    got = quality_rules.statistics_of(pa.array(texts, pa.string()))
    assert [tuple(int(x) for x in r[:5]) for r in got] == [brute.rule_counts(t) for t in texts]


def test_verdicts_without_labels_and_with_clashing_columns(spark, edge_rows):
    docs = frame(spark, edge_rows).withColumn("kept", F.lit("mine")).withColumn("_rule_kept", F.lit("mine too"))
    out = quality_rules.accepted(docs, _labels(spark))
    assert out.columns == docs.columns
    want = sum(1 for _, t in edge_rows if (c := brute.rule_counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0])
    rows = out.collect()
    assert len(rows) == want and {r.kept for r in rows} == {"mine"}
    assert quality_rules.accepted(frame(spark, []), _labels(spark, [(1, 1, 0), (None, None, None)])).count() == 0


def test_forest_rejects_bad_labelled_rows_and_keeps_good_ones(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in quality_rules.op4_quality_rules(spark, SF).collect()}
    assert len(out) == docs.count()
    known = [(out[r.doc_id], r.quality) for r in labels.collect() if not out[r.doc_id].base_failed]
    good, bad = [o.kept for o, q in known if q == 1], [o.kept for o, q in known if q == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1
    assert all(not o.kept for o in out.values() if o.base_failed)


def test_lm_base_scores_and_counts(spark, edge_rows):
    docs = frame(spark, edge_rows).select("doc_id", "text")
    training = docs.where("coalesce(doc_id, 0) % 3 != 1")
    rows = lm_score.lm_scores(docs, training).collect()
    c = brute.word_totals(t for i, t in edge_rows if (i or 0) % 3 != 1)
    total, kinds = sum(c.values()), len(c)
    want = []
    for i, t in edge_rows:
        tokens = [*brute.words(t), None]
        want.append((str(i), len(tokens), sum(c[w] > 0 for w in tokens), total,
                     round(sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in tokens), 6)))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == sorted(want)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_lm_rare_words_are_joined(spark, edge_rows, monkeypatch):
    docs = frame(spark, edge_rows).select("doc_id", "text")
    plain = sorted((str(r.doc_id), round(r.score, 6), r.n_known) for r in lm_score.lm_scores(docs, docs).collect())
    monkeypatch.setattr(lm_score, "FREQUENT", 700)
    rows = lm_score.lm_scores(docs, docs).collect()
    assert sorted((str(r.doc_id), r.n_known) for r in rows) == sorted((a, c) for a, _, c in plain)


def test_lm_probabilities_add_up_to_one():
    counts = np.array([50, 30, 20, 40])
    words = lm_score.Words(np.array([1, 2, 3], np.uint64), counts[:3], np.arange(3, dtype=np.int32), counts, 140, 9)
    model = lm_score._start(words)
    rng = np.random.default_rng(0)
    parts = [(rng.integers(0, 4, 3000), rng.integers(0, 5, 3000), rng.integers(0, 5, 3000)) for _ in range(3)]
    model, seen = lm_score.train(model, iter(parts), np.exp(model.bias), 1)
    z = lm_score.normalisers(model)
    s = (model.first[2] + model.second[4]) @ model.target.T + model.bias - z[2, 4]
    assert seen == 9000 and abs(np.exp(s).sum() - 1) < 1e-4


def test_nce_learns_what_follows_what():
    rng = np.random.default_rng(1)
    n, words = 40_000, lm_score.Words(np.array([1, 2], np.uint64), np.array([10, 10]), np.arange(2, dtype=np.int32), np.array([10, 10, 10]), 30, 3)
    seq = np.zeros(n, np.int64)
    for i in range(1, n):
        seq[i] = (seq[i - 1] + 1) % 3 if rng.random() < 0.9 else rng.integers(3)
    one, two = lm_score.contexts(seq, np.array([0, n]), 3)
    model, _ = lm_score.train(lm_score._start(words), iter([(seq, one, two)] * 3), np.full(3, 1 / 3), 2)
    p = np.exp((model.first[0] + model.second[2]) @ model.target.T + model.bias)
    assert p[1] / p.sum() > 0.8


def test_lm_beats_single_words_on_held_out_documents(spark):
    rows = lm_score.op5_lm_score(spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert [r.held_out for r in rows] == [zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm_score.lm_scores(frame(spark, []), frame(spark, [])).count() == 0
    alone = lm_score.lm_scores(frame(spark, [(1, "a b")]), frame(spark, [])).collect()
    assert (alone[0].n_tokens, alone[0].n_known, alone[0].base_score) == (3, 0, 0.0)


@pytest.mark.parametrize("query,label,least", [(toxicity.op7_toxicity, "toxic", 0.8),
                                               (quality_classifier.op10_quality_classifier, "quality", 0.95)])
def test_held_out_accuracy(spark, query, label, least):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in query(spark, sf).collect()}
    rows = [(out[r.doc_id], r[label]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(o.predicted, y) for o, y in rows if o.held_out]
    assert np.mean([p == y for p, y in held]) > 0.95
    assert np.mean([p for p, y in held if y == 1]) > least
    assert all(0 <= o.score <= 1 for o in out.values())


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_classifiers_on_edge_cases(spark, edge_rows, name):
    docs = frame(spark, edge_rows)
    cases = [[], [(1, 1, 1), (2, 1, 1)], [(k, k % 2, k % 2) for k in range(1, 60)] + [(None, 1, 1), (5, None, None), (3, 0, 0)]]
    for rows in cases:
        labels = _labels(spark, rows).withColumn("text", F.lit("clash"))
        scores = (toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, labels)) if name == "toxic"
                  else quality_classifier.quality_scores(docs, labels))
        got = scores.collect()
        assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)


def test_forest_and_threshold_come_from_all_labelled_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k % 5 > 0, round(float(rng.normal(0.5 + 0.1 * (k % 5 == 0), 0.1)), 2)) for k in range(400)]
    got = quality_rules.calibrate(spark.createDataFrame(rows, "good boolean, score double").repartition(3))
    cuts = sorted({s for _, s in rows})
    n_good, n_bad = sum(g for g, _ in rows), sum(not g for g, _ in rows)
    gain = [n_good * sum(not g and s > c for g, s in rows) - quality_rules.GOOD_WEIGHT * n_bad * sum(g and s > c for g, s in rows) for c in cuts]
    k = max(i for i, x in enumerate(gain) if x == max(gain))
    assert got == pytest.approx((cuts[k] + cuts[min(k + 1, len(cuts) - 1)]) / 2)
    # However small a tree may be, each good row grows one.
    monkeypatch.setattr(quality_rules, "TREES", 4)
    monkeypatch.setattr(quality_rules, "TREE_ROWS", 1)
    good = spark.createDataFrame([(k, float(k), 0.0, 0.0, 0.0) for k in range(40)], "key long, x0 double, x1 double, x2 double, x3 double")
    forest = quality_rules.grow_forest(good, 40)
    assert (forest.feature >= 0).sum() == 40 - 4        # leaves of a tree: one a row
    plan = quality_rules.quality_verdicts(frame(spark, []), None, ["doc_id"])
    assert plan.count() == 0 and not hasattr(quality_rules, "FIT_ROWS")
