"""Item catalogue fold (FIXTURES section 8) and keyed helpers."""

import json

from pyspark.sql import functions as F

from tidewater.operators import items, keyed


def _cmds(spark, cmds):
    rows = [(c[0], c[1], json.dumps(c[2]), i, f"2024-01-15 10:00:0{i}") for i, c in enumerate(cmds)]
    return spark.createDataFrame(rows, "id string, op string, b string, seq int, at string").select(
        "id", "op", F.parse_json("b").alias("body"), "seq", F.to_timestamp_ntz("at").alias("at"))


def _state(spark, cmds):
    ok, bad = items.validate_commands(_cmds(spark, cmds))
    return {r.id: r for r in items.fold_items(ok).collect()}, bad.count()


CREATE = {"name": "Lamp", "description": "d", "status": "active", "price": 18.4, "tags": ["brass", "desk"]}
UPDATE = {"name": "Tall lamp", "description": "new", "status": "inactive", "price": 21.7}


def test_create_update(spark):
    st, _ = _state(spark, [("i1", "create", CREATE), ("i1", "update", UPDATE)])
    r = st["i1"]
    assert (r.name, r.status, float(r.price), r.tags) == ("Tall lamp", "inactive", 21.7,
                                                          ["brass", "desk"])
    assert r.created_at is not None and r.updated_at > r.created_at


def test_partial_null_delete_recreate(spark):
    st, bad = _state(spark, [
        ("i2", "update", {"status": "x"}),                      # update of missing id creates it (Q14)
        ("i3", "create", CREATE), ("i3", "update", {"description": None}),
        ("i4", "create", CREATE), ("i4", "delete", {}),
        ("i5", "create", CREATE), ("i5", "delete", {}), ("i5", "create", {"name": "again"}),
        ("i6", "create", {"description": "no name"}),
    ])
    assert st["i2"].status == "x" and st["i2"].name is None and st["i2"].created_at is None
    assert st["i3"].description is None and st["i3"].name == "Lamp"
    assert "i4" not in st
    assert st["i5"].name == "again" and st["i5"].price is None and st["i5"].status == "active"
    assert "i6" not in st and bad == 1


def test_delete_keys_and_listing(spark):
    state = spark.createDataFrame([("a", "active"), ("b", "inactive"), ("c", "active")], "id string, status string")
    keys = spark.createDataFrame([("a",), ("z",)], "id string")
    surv, deleted, missing = keyed.delete_keys(state, keys, "id")
    assert sorted(r.id for r in surv.collect()) == ["b", "c"]
    assert [r.id for r in deleted.collect()] == ["a"] and [r.id for r in missing.collect()] == ["z"]
    assert [r.id for r in keyed.list_rows(state, "id", status="active", limit=1).collect()] == ["a"]


def test_top_k_matches_brute_force(spark):
    rows = [(g, i, (i * 7919) % 101) for g in ("hot", "cold") for i in range(300 if g == "hot" else 5)]
    df = spark.createDataFrame(rows, "g string, id int, v int")
    top = keyed.top_k(df, ["g"], [F.col("v").desc(), F.col("id")], 4, salt=F.col("id"), buckets=8)
    got = sorted((r.g, r["rank"], r.id) for r in top.collect())
    exp = []
    for g in ("hot", "cold"):
        ranked = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:4]
        exp += [(g, i + 1, r[1]) for i, r in enumerate(ranked)]
    assert got == sorted(exp)


def test_latest_and_upsert(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b")], "k string, s int, v string")
    assert keyed.latest(df, "k", ["s"]).first().v == "c"
    state = spark.createDataFrame([("k", "old"), ("m", "keep")], "k string, v string")
    changes = spark.createDataFrame([("k", 5, "new"), ("k", 4, "older")], "k string, s int, v string")
    out = {r.k: r.v for r in keyed.upsert(state, changes, "k", "s").collect()}
    assert out == {"k": "new", "m": "keep"}
