"""Each pipeline stage over nulls, copies, empty tables and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import frame
from tidewater.llm import quality_classifier, quality_rules, toxicity
from tidewater.llm.shared import free_prefix, one_text_each

SF = "/root/testdata/sf0.001"
CLASHES = ("_rid", "_RID2", "rid", "_span_start", "_span", "_start", "_mix_hash", "_mix", "_rule_kept", "_text", "node", "root", "key", "hash")
STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_keeps_rows_and_clashing_columns(spark, edge_rows, name):
    plain = frame(spark, edge_rows)
    wide = plain.withColumns({c: F.concat(F.lit(c), F.coalesce(F.length("text"), F.lit(-1))) for c in CLASHES})
    a, b = STAGES[name](spark, plain, SF), STAGES[name](spark, wide, SF)
    if name != "source_mix":
        assert a.columns == plain.columns and b.columns == wide.columns
    base = sorted(map(str, (tuple(r) for r in a.select(*plain.columns).collect())))
    rows = b.collect()
    assert sorted(str(tuple(r[c] for c in plain.columns)) for r in rows) == base
    assert all(r[c].startswith(c) for r in rows for c in CLASHES)


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_of_nothing(spark, name):
    assert STAGES[name](spark, frame(spark, []), SF).collect() == []


def test_free_prefix_is_free(spark):
    df = spark.createDataFrame([(1, 2)], "_RID long, __rid_x long")
    assert free_prefix(df, "_rid") == "___rid"


def test_fits_read_one_text_of_each_picked_id(spark):
    docs = frame(spark, [(k % 10, f"text {k // 20}") for k in range(400)] + [(3, None), (99, "x"), (None, "y")])
    picked = spark.createDataFrame([(k, k % 2) for k in range(12)], "_id long, _label int")
    got = one_text_each(docs, picked).collect()
    assert sorted(r._id for r in got) == list(range(10)) and {(r._id, r._label) for r in got} == {(k, k % 2) for k in range(10)}


@pytest.mark.parametrize("value", [0, 1])
def test_labels_of_one_value(spark, edge_rows, value):
    docs = frame(spark, edge_rows)
    labels = spark.createDataFrame([(k, value, value) for k, _ in edge_rows], "doc_id long, quality int, toxic int")
    scores = toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, labels)).collect()
    assert all(abs(r.score - value) < 1e-200 for r in scores) and len(scores) == len(edge_rows)
    assert {r.score for r in quality_classifier.quality_scores(docs, labels).collect()} == {float(value)}
    assert quality_rules.accepted(docs, labels).count() <= len(edge_rows)
