"""Streaming jobs equal their batch definitions."""

import base64
import json
import os
import re
import time
import uuid

from pyspark.sql import functions as F

from tidewater.operators import chat, events as ev, metrics
from tidewater.plans import stream_plans
from tidewater.plans.events_plans import bus_events
from tidewater.session import scratch_path
from tidewater.sources import shards
from tidewater.sources.stream import envelopes_from_events, read_envelopes, write_envelopes
from tidewater.sources.tables import read_table
from tidewater.streaming import jobs, stateful

SF = "/root/testdata/sf0.001"
AS_OF = "2024-01-31 00:00:00"


def test_metrics_stream_matches_batch(spark, tmp_dir):
    env = envelopes_from_events(read_table(spark, SF, "events"))
    src = os.path.join(tmp_dir, "src")
    write_envelopes(env, src, files=4)
    q = jobs.start_metrics_stream(spark, src, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"),
                                  AS_OF, max_files=1)
    q.awaitTermination(300)
    m = spark.read.parquet(os.path.join(tmp_dir, "out", "metrics"))
    assert m.select("batch_id").distinct().count() == 4
    per_key = {r.partition_key: r.n for r in m.groupBy("partition_key").agg(F.sum("count").alias("n")).collect()}
    batch = {r.partition_key: r["count"]
             for r in metrics.batch_metrics(metrics.decode_records(read_envelopes(spark, src)), AS_OF).collect()}
    assert per_key == batch
    archived = spark.read.json(os.path.join(tmp_dir, "out", "archive")).count()
    assert archived == env.count()


def test_windowed_stream_dedup(spark, tmp_dir):
    env = envelopes_from_events(read_table(spark, SF, "events"))
    src = os.path.join(tmp_dir, "src")
    write_envelopes(env, os.path.join(src, "a"), files=2)
    write_envelopes(env.limit(100), os.path.join(src, "b"), files=1)  # redelivered records
    stream = spark.readStream.schema(env.schema).option("recursiveFileLookup", True).json(src)
    out = jobs.windowed_stream(stream, "1 day", "2 days")
    q = (out.writeStream.outputMode("complete").format("memory").queryName("win_t")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {(str(r.window_start), r.partitionKey): r["count"] for r in spark.table("win_t").collect()}
    d = metrics.decode_records(env).withColumn("arrival_ts", F.col("arrival").cast("timestamp"))
    exp = {(str(r.window_start), r.partitionKey): r["count"]
           for r in metrics.windowed_metrics(d, "arrival_ts", "partitionKey", "value_num", "1 day").collect()}
    assert got == exp


def _bus_rows(evs, start):
    return [(json.dumps(e), start + i) for i, e in enumerate(evs)]


def _created(oid, total="1.5"):
    return {"source": "orders", "detail-type": "Order Created",
            "detail": {"eventType": "order.created", "data": {"orderId": oid, "total": float(total), "items": [{"productId": "p", "quantity": 2, "price": 3}]}}}


def _done(oid):
    return {"source": "orders", "detail-type": "Order Completed",
            "detail": json.dumps({"eventType": "order.completed", "data": {"orderId": oid}})}


def _stock(item, n):
    return {"source": "inventory", "detail-type": "Inventory Updated", "detail": {"eventType": "inventory.updated", "data": {"itemId": item, "quantity": n}}}


def _bus_file(spark, root, evs, start):
    spark.createDataFrame(_bus_rows(evs, start), "j string, seq long").coalesce(1).write.mode("append").json(root)


def _bus(spark, root):
    return spark.readStream.schema("j string, seq long").json(root).select(F.parse_json("j").alias("event"), "seq")


def _changed(out, batch=None):
    """Rows of the batch that a stream wrote last."""
    batches = sorted(int(d.split("=")[1]) for d in os.listdir(out))
    return os.path.join(out, f"batch_id={batches[-1]}")


def test_order_and_inventory_state_survive_restarts(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "bus"), os.path.join(tmp_dir, "out")
    batches = [([_created("A"), _created("B"), _stock("I", 9)], 10),
               ([_done("A"), _done("C"), _stock("J", 1), [1], _created("")], 20),
               # Older than what is known, so without effect; and a second creation, which has one.
               ([_done("B"), _stock("I", 5)], 5), ([_created("A", "7")], 30)]
    everything = []
    for evs, start in batches:
        _bus_file(spark, src, evs, start)
        everything += _bus_rows(evs, start)
        jobs.start_order_stream(spark, _bus(spark, src), out, os.path.join(tmp_dir, "cko")).awaitTermination(300)
        jobs.start_inventory_stream(spark, _bus(spark, src), out, os.path.join(tmp_dir, "cki")).awaitTermination(300)
    # The last batch changed one order and no item, and wrote no more than that.
    assert [r.order_id for r in spark.read.parquet(_changed(os.path.join(out, "orders"))).collect()] == ["A"]
    assert spark.read.parquet(_changed(os.path.join(out, "inventory"))).count() == 0
    df = spark.createDataFrame(everything, "j string, seq long").select(F.parse_json("j").alias("event"), "seq")
    routed, rejected = jobs.routed_events(spark, df)
    want_o = ev.fold_orders(ev.order_changes(routed.filter("target = 'order_processor'"))[0])
    want_i = ev.fold_latest(ev.inventory_changes(routed.filter("target = 'inventory_processor'"))[0], "item_id")
    got_o = jobs.order_state(spark, os.path.join(tmp_dir, "cko"))
    got_i = jobs.inventory_state(spark, os.path.join(tmp_dir, "cki"))
    assert sorted(map(str, got_o.select(want_o.columns).collect())) == sorted(map(str, want_o.collect()))
    assert sorted(map(str, got_i.select(want_i.columns).collect())) == sorted(map(str, want_i.collect()))
    assert {r.order_id: (r.status, float(r.total) if r.total is not None else None) for r in got_o.collect()} == {
        "A": ("processing", 7.0), "B": ("processing", 1.5), "C": ("completed", None)}
    assert rejected.count() == 1


def test_outbox_batches_replace_their_own_files(spark, tmp_dir):
    handle = jobs.outbox_batch_handler(spark, tmp_dir)
    rows = _bus_rows([_created("A"), _done("A"), _created(""), [1], _stock("", 1)], 0)
    df = spark.createDataFrame(rows, "j string, seq long").select(F.parse_json("j").alias("event"), "seq")
    handle(df, 3)
    handle(df, 3)
    assert spark.read.parquet(os.path.join(tmp_dir, "outbox")).count() == 2
    bad = spark.read.parquet(os.path.join(tmp_dir, "quarantine")).select(F.explode("reasons")).collect()
    assert len(bad) >= 3 and {"missing_order_id", "missing_item_id"} <= {r[0] for r in bad}


def test_last_in_batch_keeps_the_last_of_each_key(spark):
    rows = [(f"k{i % 3}", i, "x") for i in range(50)]
    got = stateful.last_in_batch(spark.createDataFrame(rows, "k string, seq long, v string").coalesce(1), ["k"], "seq").collect()
    assert sorted((r.k, r.seq) for r in got) == [("k0", 48), ("k1", 49), ("k2", 47)]


def _marks(spark, rows):
    return spark.createDataFrame(rows, "connection_id string, ts string, kind int, room string").withColumn("ts", F.to_timestamp_ntz("ts"))


def test_presence_stream_expires_without_new_events(spark, tmp_dir):
    src, ck, out = (os.path.join(tmp_dir, x) for x in ("marks", "ck", "out"))
    batches = [[("u", "2024-01-01 10:00:00", 0, "r1"), ("v", "2024-01-01 10:00:00", 0, "r2")],
               [("u", "2024-01-01 11:00:00", 1, None), ("w", "2024-01-01 12:00:00", 0, "r2")],
               [("x", "2024-01-02 11:30:00", 0, "r3"), ("u", "2024-01-02 11:00:00", 0, "r1")],
               [("y", "2024-01-02 14:00:00", 0, "r3")]]
    clocks = ["2024-01-01 10:00:00", "2024-01-01 12:00:00", "2024-01-02 11:30:00", "2024-01-02 14:00:00"]
    seen, sizes = [], []
    for rows, clock in zip(batches, clocks):
        seen += rows
        _marks(spark, rows).coalesce(1).write.mode("append").parquet(src)
        source = spark.readStream.schema(_marks(spark, rows).schema).parquet(src)
        jobs.start_presence_stream(spark, source, out, ck).awaitTermination(300)
        want = {r.room: r.active_connections for r in chat.presence(_marks(spark, seen), clock).collect()}
        assert {r.room: r.active_connections for r in stateful.present_at(spark, ck, clock).collect()} == want
        sizes.append(stateful.state_table(spark, ck, "presence").count())
    events = sorted((r.connection_id, r.event, str(r.at)) for r in spark.read.parquet(os.path.join(out, "presence")).collect())
    assert ("v", "expired", "2024-01-02 10:00:00") in events and ("w", "expired", "2024-01-02 12:00:00") in events
    assert ("u", "disconnected", "2024-01-01 11:00:00") in events and ("u", "connected", "2024-01-02 11:00:00") in events
    # v and w are gone from the state though nothing came from them again.
    assert sizes[-1] == 3 and {r.connection_id for r in stateful.state_table(spark, ck, "presence").collect()} == {"u", "x", "y"}


def _record_log(spark, root, rows, segment=40):
    """(key, sequence, value) as a log of two shards."""
    env = spark.createDataFrame([(base64.b64encode(json.dumps({"value": v}).encode()).decode(), k, str(s), 1704067200000 + s) for k, s, v in rows],
                                shards.ENVELOPE_SCHEMA)
    shards.append_records(env, root, F.pmod(F.length("partitionKey"), F.lit(2)), segment)


def test_record_log_batches_are_bounded_and_restart(spark, tmp_dir):
    log, ck, out = (os.path.join(tmp_dir, x) for x in ("log", "ck", "out"))
    parts = []

    def run(starting="earliest"):
        env = shards.read_shards(spark, log, ck, 100, starting)

        def handle(batch, i):
            parts.append((i, batch.rdd.getNumPartitions(), batch.count(), batch.select("shard").distinct().count()))
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={i}")

        q = env.writeStream.foreachBatch(handle).option("checkpointLocation", ck).start()
        shards.drain(q)

    rows = [("a" if s % 3 else "bb", s, s) for s in range(430)]
    _record_log(spark, log, rows)
    run()
    assert max(n for _, _, n, _ in parts) == 100 and sum(n for _, _, n, _ in parts) == 430
    assert parts[0][1:] == (2, 100, 2)          # both shards at once, a task each
    before = len(parts)
    run()                                       # nothing new: nothing read again
    assert len(parts) == before
    more = [("a", 1000 + s, s) for s in range(130)]
    _record_log(spark, log, more)
    run("latest")                               # a restart goes on where it stood
    got = spark.read.parquet(out)
    assert sorted((r.partitionKey, int(r.sequenceNumber)) for r in got.collect()) == sorted((k, s) for k, s, _ in rows + more)
    order = got.groupBy("shard").agg(F.max("offset").alias("top"), F.count("*").alias("n")).collect()
    assert all(r.top + 1 == r.n for r in order)


def test_record_log_from_the_latest(spark, tmp_dir):
    log, ck, out = (os.path.join(tmp_dir, x) for x in ("log", "ck", "out"))
    _record_log(spark, log, [("a", s, 1) for s in range(30)])
    q = jobs.start_record_stream(spark, log, out, ck, AS_OF, trigger={"processingTime": "0 seconds"})
    q.processAllAvailable()
    _record_log(spark, log, [("a", 100 + s, 2) for s in range(7)])
    q.processAllAvailable()
    q.stop()
    m = spark.read.parquet(os.path.join(out, "metrics")).collect()
    assert [(r["count"], r.total_value) for r in m] == [(7, 14.0)]


def test_shares_of_a_batch():
    assert shards.shared_out({0: 500, 1: 500}, 100) == {0: 50, 1: 50}
    assert shards.shared_out({0: 10, 1: 500}, 100) == {0: 10, 1: 90}
    assert shards.shared_out({0: 1, 1: 1, 2: 1}, 2) == {0: 1, 1: 1, 2: 0}
    assert shards.shared_out({}, 5) == {}


def test_gap_in_a_log_ends_what_is_read(tmp_dir):
    for first, n in ((0, 3), (5, 2)):
        d = os.path.join(tmp_dir, "shard=0", f"first={first:018d}", f"n={n}")
        os.makedirs(d)
        open(os.path.join(d, "part-0.json"), "w").close()
    assert shards.Log(tmp_dir).ends() == {0: 3}


def test_windows_close_in_append_mode_and_late_records_are_counted(spark, tmp_dir):
    log, ck, out = (os.path.join(tmp_dir, x) for x in ("log", "ck", "out"))
    day = 86_400_000
    rows = [(k, day * d + 1000 * i) for d in range(8) for i, k in enumerate("ab")]
    rows += [("a", day), ("b", day * 7 + 5)]       # one far too late, one in time
    env = spark.createDataFrame([(base64.b64encode(b'{"value": 2}').decode(), k, str(i), 1704067200000 + at) for i, (k, at) in enumerate(rows)],
                                shards.ENVELOPE_SCHEMA)
    shards.append_records(env, log, F.lit(0))
    stateful.use_state_store(spark)
    stream = jobs.windowed_stream(shards.read_shards(spark, log, ck, 4, "earliest"), "1 day", "1 day")
    q = stream.writeStream.outputMode("append").option("checkpointLocation", ck).trigger(processingTime="0 seconds").format("parquet").start(out)
    q.processAllAvailable()
    progress = q.recentProgress
    q.stop()
    assert sum(o.numRowsDroppedByWatermark for p in progress for o in p.stateOperators) >= 1
    assert max(o.numRowsTotal for p in progress for o in p.stateOperators) <= 10       # of 18 records
    got = {(str(r.window_start), r.partitionKey): r["count"] for r in spark.read.parquet(out).collect()}
    assert got == {(f"2024-01-{1 + d:02d} 00:00:00", k): 1 for d in range(6) for k in "ab"}


def test_file_ingest_stream(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing", "data")
    os.makedirs(landing)
    for i in range(3):
        with open(os.path.join(landing, f"f{i}.json"), "w") as f:
            f.write(json.dumps({"id": i}))
    with open(os.path.join(landing, "note.txt"), "w") as f:
        f.write("plain")
    q = jobs.start_file_ingest(spark, landing, os.path.join(tmp_dir, "processed"), os.path.join(tmp_dir, "ck"),
                               "2024-01-16 10:00:00", suffix="*.json")
    q.awaitTermination(300)
    df = spark.read.parquet(os.path.join(tmp_dir, "processed"))
    assert df.count() == 3 and df.filter("is_json").count() == 3


def test_order_stream_emits_only_what_a_batch_changed_without_python(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("bus", "out", "ck"))
    for evs, start in (([_created("A"), _created("B")], 10), ([_done("A"), _created("B", "9")], 5)):
        _bus_file(spark, src, evs, start)
        jobs.start_order_stream(spark, _bus(spark, src), out, ck).awaitTermination(300)
    assert spark.read.parquet(_changed(os.path.join(out, "orders"))).count() == 0    # older, so touched and not changed
    assert {(r.order_id, r.status) for r in jobs.order_state(spark, ck).collect()} == {("A", "processing"), ("B", "processing")}
    plan = stateful.order_stream(jobs.order_changes(jobs.routed_events(spark, _bus(spark, src))[0])[0])._jdf.queryExecution().logical().toString()
    assert "InPySpark" not in plan and "Pandas" not in plan


def test_no_task_holds_a_shard(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(shards, "TASK_RECORDS", 50)
    rows = [("a", (s * 7) % 300, s) for s in range(300)]
    for part in (rows[:130], [(k, s + 300, v) for k, s, v in rows[:90]]):
        _record_log(spark, tmp_dir, part)
    assert shards.Log(tmp_dir).ends() == {1: 220}
    reader = shards.ShardReader({"path": tmp_dir, "startingposition": "earliest"})
    tasks = reader.partitions({}, {"1": 220})
    assert [(t.start, t.end) for t in tasks] == [(0, 50), (50, 100), (100, 150), (150, 200), (200, 220)]
    read = [(o, int(q)) for t in tasks for b in reader.read(t) for o, q in zip(b.column("offset").to_pylist(), b.column("sequenceNumber").to_pylist())]
    want = sorted(s for _, s, _ in rows[:130]) + sorted(s + 300 for _, s, _ in rows[:90])
    assert read == list(enumerate(want))


def _shuffles(spark):
    """The shuffles that have files on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return set(re.findall(r"/shuffle_(\d+)_", files))


def test_order_stream_leaves_neither_shuffle_files_nor_the_events_it_has_read(spark, monkeypatch):
    roots = []
    monkeypatch.setattr(stream_plans, "_fresh", lambda spark, label: roots.append(scratch_path(spark, f"{label}-{uuid.uuid4().hex}")) or roots[-1])
    before = _shuffles(spark)
    rows = stream_plans.order_state_stream(spark, SF)
    until = time.time() + 20            # files are removed aside
    left = lambda: [f for f in os.listdir(os.path.join(roots[0], "bus")) if f.endswith(".parquet")]
    while (_shuffles(spark) - before or len(left()) > 2) and time.time() < until:
        time.sleep(0.5)
    assert not _shuffles(spark) - before
    assert len(left()) == 2             # of eight: those of the last batch
    assert rows.count() == read_table(spark, SF, "orders").count()


def test_a_bus_that_is_dealt_out_has_the_same_events(spark):
    text = lambda df: sorted(map(tuple, df.select(F.to_json("event"), F.to_json("seq")).collect()))
    dealt = bus_events(spark, SF, lambda rows, seq: rows.repartition(3, seq))
    assert dealt.rdd.getNumPartitions() == 3 and text(dealt) == text(bus_events(spark, SF))


def test_items_of_one_line_number_are_in_the_order_of_their_product_as_text(spark, tmp_dir):
    at = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    spark.range(1).select(F.lit(5).cast("long").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                          F.lit(9.5).alias("o_totalprice"), at.alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority")).write.parquet(f"{tmp_dir}/orders.parquet")
    lines = spark.createDataFrame([(5, 499, 1, 1, 2.0, 3.0), (5, 1402, 1, 1, 2.0, 3.0), (5, 7, 1, 0, 2.0, 3.0)],
                                  "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double")
    lines.withColumn("l_shipdate", at).write.parquet(f"{tmp_dir}/lineitem.parquet")
    for deal in (None, lambda rows, seq: rows.repartition(2, seq)):
        created = bus_events(spark, tmp_dir, deal).where("seq.phase = 0").select(F.expr("variant_get(event, '$.detail.data.items', 'array<struct<productId:string>>')")).first()[0]
        assert [i.productId for i in created] == ["7", "1402", "499"]
