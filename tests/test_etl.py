"""Daily ETL on the fixture records (FIXTURES section 2)."""

import json

from pyspark.sql import functions as F

from tidewater.operators import etl

AS_OF = "2024-01-16 00:00:00"


def _records(spark, objs):
    return spark.createDataFrame([(json.dumps(o),) for o in objs], "j string").select(
        F.parse_json("j").alias("record"))


def _run(spark, objs):
    ok, bad_x = etl.extract_records(_records(spark, objs), AS_OF)
    t, bad_t = etl.transform(ok, AS_OF)
    load, bad_l = etl.validate_for_load(t)
    stored = etl.to_storage_types(load)
    rows = {r.id: (r, json.loads(r.d)) for r in stored.select("*", F.to_json("data").alias("d")).collect()}
    return rows, bad_x.count(), bad_t.count(), bad_l.count()


def test_fixture_five_rows(spark):
    objs = [{"id": f"row{i}", "timestamp": "2024-01-15T07:30:00Z", "value": 3 + i,
             "count": 2 + i, "total_value": 8 + 4 * i, "location": f"yard {i}",
             "status": "open"} for i in range(5)]
    rows, *_ = _run(spark, objs)
    assert len(rows) == 5
    for _, data in rows.values():
        assert data["average"] == 4.0
        assert "total_value" not in data
        assert set(data) == {"value", "count", "average", "location", "status"}


def test_typed_attributes(spark):
    rows, *_ = _run(spark, [{"id": {"S": "bolt"}, "name": {"S": "Long bolt"}, "value": {"N": "100"},
                             "timestamp": {"S": "2024-01-15T10:00:00Z"}}])
    r, data = rows["bolt"]
    assert data == {"value": 100.0, "name": "Long bolt"}


def test_window_edges_and_defaults(spark):
    objs = [
        {"id": "no-ts"},
        {"id": "start", "timestamp": "2024-01-15T00:00:00Z"},
        {"id": "end", "timestamp": "2024-01-16T00:00:00Z"},
        {"id": "plus2", "timestamp": "2024-01-16T01:00:00+02:00"},
        {"id": "minus5", "timestamp": "2024-01-14T20:00:00-05:00"},
        {"id": "bare", "timestamp": "2024-01-15T23:59:59"},
        {"id": "bad", "timestamp": "not a time"},
        {"partition_key": "pk-1", "timestamp": "2024-01-15T12:00:00Z"},
        {"timestamp": "2024-01-15T12:00:00Z", "x": 1},
        {"id": None, "timestamp": "2024-01-15T12:00:00Z"},
    ]
    rows, bad_x, _, bad_l = _run(spark, objs)
    assert set(rows) == {"no-ts", "start", "plus2", "minus5", "bare", "pk-1", "unknown"}
    assert rows["no-ts"][0].timestamp == "2024-01-16T00:00:00Z"
    assert bad_x == 1 and bad_l == 1


def test_numeric_coercion_and_storage(spark):
    objs = [{"id": "a", "count": "10.5", "total_value": 5, "timestamp": "2024-01-15T01:00:00Z"},
            {"id": "b", "count": {"N": "10.5"}, "total_value": 21, "timestamp": "2024-01-15T01:00:00Z"},
            {"id": "c", "count": 0, "total_value": 5, "timestamp": "2024-01-15T01:00:00Z"},
            {"id": "d", "flag": True, "nested": {"a": None, "b": {"c": 1}}, "lst": [1, 2],
             "timestamp": "2024-01-15T01:00:00Z"},
            {"id": "e", "value": {"N": "abc"}, "timestamp": "2024-01-15T01:00:00Z"}]
    rows, _, bad_t, _ = _run(spark, objs)
    assert "count" not in rows["a"][1]
    assert rows["b"][1]["count"] == 10 and rows["b"][1]["average"] == 2.1
    assert "average" not in rows["c"][1]
    d = rows["d"][1]
    assert d["flag"] is True and d["lst"] == ["1", "2"] and json.loads(d["nested"]) == {"a": None, "b": {"c": 1}}
    assert "e" not in rows and bad_t == 1


def test_empty_day(spark):
    rows, *_ = _run(spark, [{"id": "x", "timestamp": "2020-01-01T00:00:00Z"}])
    assert rows == {}


def test_latest_input_wins_and_inband_text_is_legal(spark):
    objs = [{"id": "a", "timestamp": "2024-01-15T07:00:00Z", "value": v, "note": {"S": "__bad_number__"}} for v in (9, 5)]
    rows = spark.createDataFrame([(i, json.dumps(o)) for i, o in enumerate(objs)], "seq int, j string").select(
        "seq", F.parse_json("j").alias("record"))
    ok, bad = etl.transform(rows, AS_OF)
    assert bad.count() == 0
    got = etl.load_latest(ok).select(F.try_variant_get("data", "$.value", "double").alias("v")).collect()
    assert [r.v for r in got] == [5.0]


def test_time_forms(spark):
    forms = ["2024-01-15 10:00:00+00:00", "2024-01-15 10:00:00Z", "2024-01-15T10:00:00.5Z", "2024-01-15T12:00:00+02:00", "2024-01-15"]
    rows = _records(spark, [{"id": str(i), "timestamp": f} for i, f in enumerate(forms)])
    ok, bad = etl.extract_records(rows, AS_OF)
    assert (ok.count(), bad.count()) == (5, 0)
    _, bad = etl.extract_records(_records(spark, [{"timestamp": "T10:00"}, {"timestamp": "soon"}]), AS_OF)
    assert bad.count() == 2


def test_stage_keeps_other_days(spark, tmp_dir):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
            etl.stage(spark.createDataFrame([(1,)], "x int").withColumn("d", F.lit(day).cast("timestamp")), tmp_dir, "staged", "d")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(f"{tmp_dir}/staged").count() == 2


def test_a_record_is_parsed_once_to_extract_it(spark):
    rows = spark.createDataFrame([(json.dumps({"id": str(i), "timestamp": t}),) for i, t in enumerate(
        ["2024-01-15T07:30:00Z", "2024-01-16T07:30:00Z", "soon", None])], "j string").select(F.parse_json("j").alias("record"))
    ok, bad = etl.extract_records(rows.repartition(2), AS_OF)
    lazy, _ = etl.extract_records(spark.range(3).select(F.parse_json(F.concat(F.lit('{"timestamp":"'), "id", F.lit('"}'))).alias("record")), AS_OF)
    assert (ok.count(), bad.count()) == (2, 1)
    assert lazy._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1
