"""Stream metrics on the sensor fixture (FIXTURES section 1)."""

import base64
import json

from pyspark.sql import functions as F

from tidewater.operators import metrics, quality
from tidewater.sources.stream import ENVELOPE_SCHEMA

AS_OF = "2024-01-16 00:00:00"
BASE_MS = 1705312800000  # 2024-01-15T10:00:00Z


def _env(spark, payloads, raw=None):
    rows = []
    for i, p in enumerate(payloads):
        data = raw[i] if raw and raw.get(i) is not None else base64.b64encode(json.dumps(p).encode()).decode()
        key = p.get("sensorId", "k") if isinstance(p, dict) else "k"
        rows.append((data, key, str(1000 + i), BASE_MS + i * 1000))
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


SENSORS = [("sensor-001", 20.0, "building-A"), ("sensor-002", 22.5, "building-B"),
           ("sensor-003", 25.0, "building-C"), ("sensor-001", 27.5, "building-A"),
           ("sensor-002", 30.0, "building-B")]


def test_batch_metrics_fixture(spark):
    env = _env(spark, [{"sensorId": s, "value": v, "timestamp": "x", "location": l} for s, v, l in SENSORS])
    m = {r.partition_key: r for r in metrics.batch_metrics(metrics.decode_records(env), AS_OF).collect()}
    assert (m["sensor-001"]["count"], m["sensor-001"].total_value, m["sensor-001"].average_value) == (2, 47.5, 23.75)
    assert (m["sensor-002"]["count"], m["sensor-002"].total_value, m["sensor-002"].average_value) == (2, 52.5, 26.25)
    assert (m["sensor-003"]["count"], m["sensor-003"].total_value) == (1, 25.0)
    # first arrival = rows 0, 1, 2 (Q2)
    assert str(m["sensor-001"].first_arrival) == "2024-01-15 10:00:00"
    assert str(m["sensor-002"].first_arrival) == "2024-01-15 10:00:01"


def test_value_variants_and_quarantine(spark):
    payloads = [{"sensorId": "a", "temperature": 1}, {"sensorId": "a", "value": "25.5"},
                {"sensorId": "a", "value": "abc"}, {"sensorId": "a", "value": None},
                {"sensorId": "a", "value": 1}, {"sensorId": "a"}]
    env = _env(spark, payloads, raw={5: "!!!not base64!!!"})
    decoded = metrics.decode_records(env)
    m = metrics.batch_metrics(decoded, AS_OF).collect()
    assert len(m) == 1
    # broken base64 not counted; bad values counted and add 0 (Q3, Q4)
    assert m[0]["count"] == 5
    assert m[0].total_value == 26.5
    assert m[0].average_value == 26.5 / 5
    ok, bad = metrics.split_records(decoded)
    assert ok.count() == 3
    reasons = sorted(r.reasons[0] for r in bad.collect())
    assert reasons == ["decode", "value", "value"]
    a = quality.audit(ok, bad, key="partitionKey").first()
    assert (a.processed, a.aggregated, a.errors) == (3, 1, 3)


def test_nan_value_quarantined(spark):
    env = _env(spark, [{"sensorId": "a", "value": "nan"}, {"sensorId": "a", "value": 2}])
    decoded = metrics.decode_records(env)
    m = metrics.batch_metrics(decoded, AS_OF).first()
    assert m.total_value == 2.0 and m["count"] == 2
    _, bad = metrics.split_records(decoded)
    assert bad.count() == 1


def test_windows_alerts_live(spark):
    rows = [(f"2024-01-01 00:0{i}:00", "error" if i < 6 else "view", 1.0) for i in range(8)]
    df = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn(
        "ts", F.to_timestamp_ntz("ts"))
    a = metrics.error_alerts(df, "ts", F.col("event_type") == "error", "5 minutes", 5).collect()
    assert [(r.errors, r.records) for r in a] == [(5, 5)]
    w = metrics.windowed_metrics(df, "ts", "event_type", "value", "1 hour").collect()
    assert sorted((r.event_type, r["count"]) for r in w) == [("error", 6), ("view", 2)]
    t = spark.createDataFrame([(1,), (2_000_000_000,)], "ttl long")
    assert metrics.live(t, "ttl", AS_OF).count() == 1


def test_archive_layout_and_tiers(spark):
    env = _env(spark, [{"sensorId": "s", "value": 1}])
    arc = metrics.archive_layout(metrics.decode_records(env)).first()
    assert (arc.year, arc.month, arc.day, arc.hour) == ("2024", "01", "15", "10")
    assert json.loads(arc.body)["data"]["value"] == 1
    df = spark.createDataFrame([("2024-01-01",), ("2023-06-01",), ("2023-12-01",)], "d string")
    tiers = {str(r.day): r.tier for r in metrics.tier_report(df, "d", "2024-01-15 00:00:00", expire_days=90).collect()}
    assert tiers == {"2024-01-01": "STANDARD", "2023-12-01": "STANDARD_IA", "2023-06-01": "GLACIER"}
