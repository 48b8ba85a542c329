"""Chat joins (FIXTURES section 5)."""

from pyspark.sql import functions as F

from tidewater.operators import chat


def _conns(spark):
    rows = [("c1", "general", "alice"), ("c2", "general", "bob"), ("c3", "private", "charlie"),
            ("c4", None, None)]
    return chat.connection_rows(spark.createDataFrame(rows, "connection_id string, room string, user_id string")
                                .withColumn("connected_at", F.to_timestamp_ntz(F.lit("2024-01-15 10:00:00"))))


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "message_id string, connection_id string, room string, type string, "
                                       "message string, ts int")


def test_fan_out_counts(spark):
    conns = _conns(spark)
    msgs = _msgs(spark, [("m1", "c1", "general", "message", "hi", 1), ("m2", "c2", "general", "message", "yo", 2),
                         ("m3", "c3", "private", "message", "x", 3), ("m4", "c1", "general", "typing", "", 4),
                         ("m5", "zz", "general", "message", "?", 5)])
    found, missing = chat.attach_sender(msgs, conns)
    assert [r.error for r in missing.collect()] == ["Connection not found"]
    assert chat.fan_out(found, conns).count() == 5           # 2 + 2 + 1, sender included
    d = {r.room: r.deliveries for r in chat.deliveries_per_room(found, conns).collect()}
    assert d == {"general": 4, "private": 1}
    assert [r.room for r in conns.filter("connection_id = 'c4'").collect()] == ["default"]


def test_drop_stale_and_history(spark):
    conns = _conns(spark)
    fails = spark.createDataFrame([("c2",)], "connection_id string")
    assert chat.drop_stale(conns, fails).count() == 3
    msgs = _msgs(spark, [(f"m{i}", "c1", "general", "message", "", i) for i in range(6)])
    h = chat.room_history(msgs, 3).orderBy("rank").collect()
    assert [r.message_id for r in h] == ["m5", "m4", "m3"]


def _marks(spark, rows):
    return spark.createDataFrame(rows, "connection_id string, ts string, kind int, room string").withColumn(
        "ts", F.to_timestamp_ntz("ts"))


def test_membership_and_presence(spark):
    marks = _marks(spark, [("u", "2024-01-01 10:00:00", 0, "r1"), ("u", "2024-01-01 12:00:00", 1, None),
                           ("u", "2024-01-02 09:00:00", 0, "r2"), ("v", "2024-01-01 23:00:00", 0, "r3")])
    msgs = spark.createDataFrame(
        [(1, "u", "2024-01-01 11:00:00"), (2, "u", "2024-01-01 13:00:00"), (3, "u", "2024-01-03 08:59:59"),
         (4, "u", "2024-01-03 09:00:00"), (5, "v", "2024-01-02 22:00:00"), (6, "w", "2024-01-02 00:00:00")],
        "message_id long, connection_id string, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))
    got = {r.message_id: r.room for r in chat.membership_at(marks, msgs).collect()}
    assert got == {1: "r1", 2: None, 3: "r2", 4: None, 5: "r3", 6: None}
    p = {r.room: r.active_connections for r in chat.presence(marks, "2024-01-02 10:00:00").collect()}
    assert p == {"r2": 1, "r3": 1}
