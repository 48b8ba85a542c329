"""The pipeline's stages, one after another, against plain versions."""

import corpus_pipeline
from tests.llm import brute
from tidewater.llm.quality_rules import op4_quality_rules
from tidewater.llm.shared import materialise

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text, r.source) for r in docs.collect())
    verdict = {r.doc_id: r for r in op4_quality_rules(spark, SF).collect()}
    for k, t, _ in rows:
        c = brute.rule_counts(t)
        assert verdict[k].base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0])
    rows = [r for r in rows if verdict[r[0]].kept]
    found = brute.components([r[:2] for r in rows], 5, 80)
    rows = [r for r, (_, c) in zip(rows, found) if r[0] == c]
    left = brute.removed([r[:2] for r in rows])
    rows = [(k, brute.kept_text(*x), s) for (k, _, s), x in zip(rows, left)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute.overlaps([r[:2] for r in rows], items)}
    rows = [r for r in rows if r[0] not in leaks]
    want = {rows[i][0]: x for i, x in brute.mix([(k, s, t) for k, t, s in rows]).items()}

    stage = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        stage = materialise(step(spark, stage, SF), name)
        assert stage.columns == docs.columns
    assert {(r.doc_id, r.text) for r in stage.collect()} == {(k, t) for k, t, _ in rows}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert {k: r.taken for k, r in got.items()} == {k: x[3] for k, x in want.items() if x[3]}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "benchmark_leaks", "source_mix"]
