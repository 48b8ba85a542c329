"""The stored keyed table: only touched buckets change, retries repeat nothing."""

import os

import pytest

from tidewater.operators import keyed_table as kt


def _files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(root, "data")) for f in fs if f.endswith(".parquet")}


def _batch(spark, rows, ddl="k long, v string, seq long"):
    return spark.createDataFrame(rows, ddl)


def _state(spark, root, version=None):
    return {r.k: r.v for r in kt.read_table(spark, root, version).collect()}


def test_batch_rewrites_only_its_buckets(spark, tmp_dir):
    kt.apply_batch(_batch(spark, [(k, "a", 1) for k in range(200)]), tmp_dir, 0, "k", "seq", buckets=16)
    before = _files(tmp_dir)
    made = kt.apply_batch(_batch(spark, [(7, "c", 3), (7, "b", 2), (900, "n", 1)]), tmp_dir, 1, "k", "seq")
    assert 1 <= len(made["touched"]) <= 2 and before <= _files(tmp_dir)
    assert len(_files(tmp_dir) - before) == len(made["touched"])
    assert _state(spark, tmp_dir) == {**{k: "a" for k in range(200)}, 7: "c", 900: "n"}
    assert _state(spark, tmp_dir, 0) == {k: "a" for k in range(200)}
    plan = kt.read_table(spark, tmp_dir).inputFiles()
    assert len([f for f in plan if "/v=1/" in f]) == len(made["touched"])


def test_retry_gives_the_same_version(spark, tmp_dir):
    kt.apply_batch(_batch(spark, [(1, "a", 1), (2, "a", 1)]), tmp_dir, 0, "k", "seq", buckets=4)
    change = _batch(spark, [(1, "b", 5), (3, "x", 1)])
    first = kt.apply_batch(change, tmp_dir, 1, "k", "seq")
    assert kt.apply_batch(change, tmp_dir, 1, "k", "seq") == first
    assert _state(spark, tmp_dir) == {1: "b", 2: "a", 3: "x"}
    kt.apply_batch(change, tmp_dir, 2, "k", "seq")
    with pytest.raises(ValueError):
        kt.apply_batch(change, tmp_dir, 1, "k", "seq")


def test_deletes_empty_batches_new_columns_and_null_keys(spark, tmp_dir):
    kt.apply_batch(_batch(spark, []), tmp_dir, 0, "k", "seq", buckets=4)
    assert kt.read_table(spark, tmp_dir).count() == 0
    kt.apply_batch(_batch(spark, [(1, "a", 1), (None, "n", 1), (2, "z", 1)]), tmp_dir, 1, "k", "seq")
    rows = spark.createDataFrame([(2, None, 9, 1, True), (4, "w", 8, 1, None)], "k long, v string, w int, seq long, gone boolean")
    kt.apply_batch(rows, tmp_dir, 2, "k", "seq", deleted="gone")
    got = {(r.k, r.v, r.w) for r in kt.read_table(spark, tmp_dir).collect()}
    assert got == {(1, "a", None), (None, "n", None), (4, "w", 8)}
    kt.apply_batch(spark.createDataFrame([(k, 1, True) for k in (1, 4)], "k long, seq long, gone boolean"), tmp_dir, 3, "k", "seq", deleted="gone")
    assert {r.v for r in kt.read_table(spark, tmp_dir).collect()} == {"n"}


def test_keys_are_read_from_their_buckets(spark, tmp_dir):
    kt.apply_batch(_batch(spark, [(k, str(k), 1) for k in range(100)]), tmp_dir, 0, "k", "seq", buckets=32)
    some = kt.read_keys(spark, tmp_dir, spark.createDataFrame([(5,), (77,), (5000,)], "k long"))
    assert sorted((r.k, r.v) for r in some.collect()) == [(5, "5"), (77, "77")]
    assert len(some.inputFiles()) <= 3


def test_vacuum_keeps_what_newer_versions_read(spark, tmp_dir):
    for v in range(4):
        kt.apply_batch(_batch(spark, [(k, f"v{v}", v) for k in range(v, 40, v + 1)]), tmp_dir, v, "k", "seq", buckets=8)
    want = _state(spark, tmp_dir), _state(spark, tmp_dir, 2)
    listed = kt.unused(spark, tmp_dir)
    assert kt.vacuum(spark, tmp_dir) == listed and listed
    assert (_state(spark, tmp_dir), _state(spark, tmp_dir, 2)) == want
    assert kt.unused(spark, tmp_dir) == [] and kt.versions(spark, tmp_dir) == [2, 3]


def test_stream_of_upserts(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "table")
    for part in ([(1, "a", 1), (2, "a", 2)], [(1, "b", 3)]):
        _batch(spark, part).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("k long, v string, seq long").option("maxFilesPerTrigger", 1).parquet(src)
    q = (stream.writeStream.foreachBatch(kt.batch_handler(root, "k", "seq", buckets=4)).option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(200)
    assert _state(spark, root) == {1: "b", 2: "a"} and kt.versions(spark, root) == [0, 1]
