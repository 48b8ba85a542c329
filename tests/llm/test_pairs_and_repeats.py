"""Similarity join and repeated strings against their definitions."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import frame, prose
from tidewater.llm import jaccard_join, suffix_dedup
from tidewater.llm.components import connected_components


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, edge_rows, n, percent):
    got = jaccard_join.jaccard_components(frame(spark, edge_rows), n, percent).collect()
    want = [(k, *x) for (k, _), x in zip(edge_rows, brute.components(edge_rows, n, percent))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(want, key=key)


def test_links_between_groups_that_share_passages(spark):
    rng = random.Random(8)
    shared = prose(rng, 40)
    rows = []
    for g in range(6):
        base = (shared + " " + prose(rng, 60, 5000)).split(" ")
        for _ in range(7):
            w = list(base)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(w)))
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(frame(spark, rows), 3, 90).collect()}
    assert got == {k: x[1] for (k, _), x in zip(rows, brute.components(rows, 3, 90))}


def test_empty_table_and_clashing_columns(spark, edge_rows):
    assert jaccard_join.jaccard_components(frame(spark, []), 3, 90).count() == 0
    from pyspark.sql import functions as F
    wide = frame(spark, edge_rows).withColumns({c: F.lit(1) for c in ("rid", "node", "n", "token", "_rid")})
    assert jaccard_join.jaccard_components(wide, 3, 90).count() == len(edge_rows)


def test_one_of_each_keeps_smallest_id_and_columns(spark, edge_rows):
    got = jaccard_join.one_of_each(frame(spark, edge_rows), 5, 80)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    found = brute.groups(edge_rows, 5, 80)
    want = {}
    for (k, t), (n, c) in zip(edge_rows, found):
        if n:
            want.setdefault(c, set()).add((k is None, k or 0))
    blank = sum(1 for _, (n, _) in zip(edge_rows, found) if not n)
    rows = got.collect()
    assert len(rows) == len(want) + blank
    ids = {r.doc_id for r in rows}
    assert all(min(v)[1] in ids or min(v)[0] for v in want.values())


def test_connected_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def _texts(rng, n, alphabet):
    return [bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("alphabet", [b"ab", b"\x00a", b"abcdefgh"])
def test_suffix_array_and_common_prefixes(alphabet):
    rng = random.Random(len(alphabet))
    texts = _texts(rng, 30, alphabet)
    texts += texts[:5] + [b"a" * 40, b"a" * 33]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    order, word = suffix_dedup.suffix_array(np.frombuffer(b"".join(texts), np.uint8), offsets)
    suffixes = [(t[p:], i, offsets[i] + p) for i, t in enumerate(texts) for p in range(len(t))]
    want = sorted(suffixes)
    assert order.tolist() == [p for _, _, p in want]
    lcp = suffix_dedup.common_prefixes(order, word, offsets, most=25)
    for k in range(1, len(want)):
        a, b = want[k - 1][0], want[k][0]
        n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert lcp[k] == (min(n, 25) if len(b) >= 25 else 0)


@pytest.mark.parametrize("hot", [2, 4000])
def test_removed_bytes_equal_brute_force(spark, edge_rows, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)     # windows dealt out singly, or not
    rows = edge_rows + [(200, "".join(t or "" for _, t in edge_rows[:12])), (201, "xyz" * 200), (0, "q" + "xyz" * 60)]
    got = suffix_dedup.removal_digest(frame(spark, rows)).collect()
    want = [(k, *brute.removal_row(*x)) for (k, _), x in zip(rows, brute.removed(rows))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_texts_without_repeats(spark, edge_rows):
    docs = frame(spark, edge_rows)
    got = suffix_dedup.without_repeats(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    want = [(k, None if t is None else brute.kept_text(*x)) for (k, t), x in zip(edge_rows, brute.removed(edge_rows))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    rows = got.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=key) == sorted(want, key=key)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    assert suffix_dedup.without_repeats(frame(spark, [])).count() == 0
