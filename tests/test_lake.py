"""Lake ingest, processed zone, catalog and curated views (FIXTURES section 3)."""

import json
import os

from pyspark.sql import functions as F

from tidewater.operators import lake

AS_OF = "2024-01-16 10:30:00"
ITEMS = [{"id": "k1", "name": "a", "category": "Rope", "price": 12.5, "quantity": 8},
         {"id": "k2", "name": "b", "category": "Paint", "price": 7.25, "quantity": 31},
         {"id": "k3", "name": "c", "category": "Rope", "price": 20.5, "quantity": 3}]


def _land(root, files):
    for rel, body in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(body)


def test_ingest_curate_query(spark, tmp_dir):
    files = {f"data/x/{i['id']}.json": json.dumps(i) for i in ITEMS}
    files["data/y/001.json"] = "plain text, not json"
    files["data/nd.json"] = "\n".join(json.dumps(i) for i in ITEMS)
    files["data/arr.json"] = "[1, 2]"
    files["data/two.json"] = '{"a": 1}{"b": 2}'
    files["data/tail.json"] = '{"a": 1}] lost text'
    files["data/nan.json"] = '{"a": NaN}'
    files["other/skip.json"] = "{}"
    _land(tmp_dir, files)
    raw = lake.read_raw_files(spark, tmp_dir)
    ing = lake.ingest(raw, AS_OF)
    kinds = {os.path.relpath(r.source_file.replace("file:", ""), tmp_dir): r.is_json for r in ing.collect()}
    assert len(kinds) == 9 and kinds["data/x/k1.json"] and kinds["data/arr.json"]
    assert not kinds["data/y/001.json"] and not kinds["data/nd.json"] and not kinds["data/two.json"]
    assert not kinds["data/nan.json"] and not kinds["data/tail.json"]
    only = lake.read_raw_files(spark, tmp_dir, "data/x/**").collect()
    assert len(only) == 3
    cur = lake.curated_view(ing.filter("is_json"), {"category": "string", "price": "double"})
    stats = {r.category: (r.items, round(r.avg_price, 2))
             for r in lake.category_stats(cur.filter(F.col("category").isNotNull())).collect()}
    assert stats == {"Rope": (2, 16.5), "Paint": (1, 7.25)}
    nd = lake.split_ndjson(ing.filter(F.col("source_file").endswith("nd.json")))
    ndc = lake.curated_view(nd, {"category": "string", "quantity": "double"})
    q = {r.category: r.q for r in ndc.groupBy("category").agg(F.avg("quantity").alias("q")).collect()}
    assert q == {"Rope": 5.5, "Paint": 31.0}


def test_processed_zone_catalog_pruning(spark, tmp_dir):
    _land(tmp_dir, {f"data/{i['id']}.json": json.dumps(i) for i in ITEMS})
    ing = lake.ingest(lake.read_raw_files(spark, tmp_dir), AS_OF)
    out = os.path.join(tmp_dir, "processed")
    for batch in (0, 1, 0):     # batch 0 is written again by a retry
        lake.write_processed(ing, out, batch)
    assert os.path.isdir(os.path.join(out, "year=2024", "month=01", "day=16", "hour=10", "batch_id=1"))
    lake.register(spark, "lake_processed_t", out)
    df = spark.sql("SELECT month, COUNT(*) AS n FROM lake_processed_t WHERE day = '16' GROUP BY month")
    assert [(r.month, r.n) for r in df.collect()] == [("01", 6)]
    plan = spark.sql("SELECT * FROM lake_processed_t WHERE day = '16'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan
    typed = lake.curated_view(spark.table("lake_processed_t_typed"), {"category": "string", "price": "double"})
    assert typed.where("category = 'Rope'").count() == 4
    assert lake.read_processed(spark, out).where("batch_id = '1'").count() == 3
