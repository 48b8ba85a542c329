"""Decontamination and mixing against their definitions."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import frame, prose
from tidewater.llm import decontaminate, mixing


@pytest.mark.parametrize("window", range(1, 14))
def test_masks_meet_every_allowed_substitution(window):
    wrong = window - decontaminate.needed(window)
    masks = decontaminate.masks(window)
    for gone in combinations(range(window), wrong):
        assert any(not {p + k for p in m} & set(gone) for m in masks for k in range(window - m[-1]))


def _items():
    rng = random.Random(5)
    items = [(k, prose(rng, n, 5000)) for k, n in enumerate([40, 30, 13, 12, 9, 6, 4, 2, 1, 60])]
    return rng, items + [(20, None), (21, ""), (22, items[0][1]), (None, prose(rng, 25, 5000))]


@pytest.mark.parametrize("hot, bits", [(4096, 28), (2, 4)])      # every seed hot, nearly all let through
def test_overlaps_equal_brute_force(spark, monkeypatch, hot, bits):
    monkeypatch.setattr(decontaminate, "HOT", hot)
    monkeypatch.setattr(decontaminate, "MOST_BITS", bits)
    rng, items = _items()
    docs = []
    for k in range(60):
        body = prose(rng, rng.randrange(0, 60), 5000).split(" ")
        item = items[k % 10][1].split(" ")
        for _ in range(rng.randrange(0, 6)):
            item[rng.randrange(len(item))] = "wrong"
        cut = item[rng.randrange(3):] if k % 3 else item
        at = rng.randrange(len(body) + 1)
        docs.append((k, " ".join(body[:at] + cut + body[at:]).upper() if k % 2 else " ".join(body[:at] + cut + body[at:])))
    docs += [(100, None), (101, ""), (102, "one"), (None, items[9][1]), (103, items[9][1] * 3)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("rid", F.lit(1))
    got = decontaminate.benchmark_overlaps(frame(spark, docs).withColumn("covered", F.lit(2)), bench)
    assert {(r.doc_id, r.item_id): r.covered for r in got.collect()} == brute.overlaps(docs, items)
    clean = decontaminate.without_leaks(frame(spark, docs), bench)
    leaks = {d for d, _ in brute.overlaps(docs, items)}
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in leaks)


def test_no_documents_or_no_items(spark):
    _, items = _items()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.benchmark_overlaps(frame(spark, []), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.benchmark_overlaps(frame(spark, [(1, "a b c")]), none).count() == 0


def _sourced(seed):
    rng = random.Random(seed)
    rows = [(k, prose(rng, rng.randrange(0, 300)), f"s{rng.randrange(5)}" if rng.random() < 0.6 else "big") for k in range(300)]
    rows += [(k, "few words", "tiny") for k in range(300, 303)] + [(400, None, "null text"), (401, "", "é"), (402, "a b", None),
                                                                  (None, "c d e", None), (7, "again with equal id", "s1")]
    return rows + [rows[3]]


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_mix_equals_brute_force(spark, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)     # broadcast or shuffled join
    rows = _sourced(len(limit))
    got = mixing.mixed(frame(spark, rows).withColumn("taken", F.lit("clash"))).collect()
    want = brute.mix([(i, s, t) for i, t, s in rows])
    key = lambda r: tuple(str(x) for x in r)
    assert (sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=key)
            == sorted(((rows[i][0], a, b, round(c, 6), d) for i, (a, b, c, d) in want.items()), key=key))
    by = {}
    for r in got:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        by.setdefault(r.source, [r.target, 0, 0])
        by[r.source][1] += r.taken
        by[r.source][2] = max(by[r.source][2], r.size)
    assert all(abs(taken - target) <= largest for target, taken, largest in by.values())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_mix_of_nothing(spark):
    assert mixing.mixed(frame(spark, [])).count() == 0
    only = mixing.mixed(frame(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2
