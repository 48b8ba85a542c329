"""Daily extract -> transform -> load over semi-structured records
(B4-B10, B13, B14, A4, A7, A12).

A record is one JSON object held in a VARIANT column ``record``.  The three
steps are one lazy plan; nothing is materialised between them unless a zone
output is itself wanted (``stage``).  No step shuffles; only the keyed load
(last-write-wins per ``(id, timestamp)``) does, once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.core import lit_ts, once, parse_iso
from tidewater.operators.quality import split_valid

# Fields the transform consumes itself; every other field is
# copied into ``data``.
CONSUMED_FIELDS = ["id", "partition_key", "timestamp", "value", "count", "total_value"]


def day_window(as_of: str | datetime) -> tuple[Column, Column]:
    """[start, end) of the day before ``as_of`` (UTC)."""
    start = F.date_trunc("day", lit_ts(as_of) - F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz")
    return start, start + F.expr("INTERVAL 1 DAY")


def extract_day(df: DataFrame, ts_col: str, as_of: str | datetime) -> tuple[DataFrame, DataFrame]:
    """Rows of the previous day, plus rows without a timestamp.

    A typed timestamp column filters directly (the predicate reaches the
    Parquet scan).  A text column is parsed (Z, offsets, bare = UTC); rows
    whose text does not parse are returned as the second DataFrame (Q7).
    """
    start, end = day_window(as_of)
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        ts = F.col(ts_col).cast("timestamp_ntz")
        return df.filter(((ts >= start) & (ts < end)) | F.col(ts_col).isNull()), df.limit(0)
    parsed = parse_iso(ts_col).cast("timestamp_ntz")
    tagged = once(df.withColumn("_ts", parsed))
    ok = tagged.filter(F.col(ts_col).isNull()
                       | ((F.col("_ts") >= start) & (F.col("_ts") < end))).drop("_ts")
    bad = (tagged.filter(F.col(ts_col).isNotNull() & F.col("_ts").isNull()).drop("_ts")
           .withColumn("reasons", F.array(F.lit("bad_timestamp"))))
    return ok, bad


def extract_records(records: DataFrame, as_of: str | datetime) -> tuple[DataFrame, DataFrame]:
    """B10 over variant records: the ``timestamp`` field decides."""
    text = F.coalesce(F.try_variant_get("record", "$.timestamp.S", "string"),
                      F.try_variant_get("record", "$.timestamp", "string"))
    with_ts = once(records.withColumn("_tstext", text))
    ok, bad = extract_day(with_ts, "_tstext", as_of)
    return ok.drop("_tstext"), bad.drop("_tstext")


def _fields(record: str = "record") -> Column:
    return F.col(record).try_cast("map<string, variant>")


def _is_obj_with(v: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(v.try_cast("map<string, variant>"), F.lit(key)), F.lit(False))


def unwrap_typed(record: str = "record") -> Column:
    """``{"S": x}`` -> x, ``{"N": "1.5"}`` -> 1.5 (double); a bad N
    becomes NULL (see ``bad_numbers``)."""
    def unwrap(k, v):
        return (F.when(_is_obj_with(v, "S"), F.variant_get(v, "$.S", "variant"))
                .when(_is_obj_with(v, "N"), F.try_variant_get(v, "$.N", "double").cast("variant"))
                .otherwise(v))
    return F.transform_values(_fields(record), unwrap)


def bad_numbers(record: str = "record") -> Column:
    """Whether a field is ``{"N": x}`` without a number in it."""
    return F.coalesce(F.exists(F.map_values(_fields(record)), lambda v: ~_is_obj_with(v, "S") & _is_obj_with(v, "N")
                               & F.try_variant_get(v, "$.N", "double").isNull()), F.lit(False))


def transform(records: DataFrame, as_of: str | datetime) -> tuple[DataFrame, DataFrame]:
    """Typed unwrap, key/time defaults, numeric coercion, average,
    remaining fields into ``data``.  Returns (transformed, quarantined).

    Output: ``id``, ``timestamp``, ``processed_at`` (text) and ``data``
    (VARIANT object).  ``id`` falls back to ``partition_key`` then
    ``'unknown'`` only when the key is absent; an explicit null stays null (Q5).
    """
    stamp = F.concat(F.date_format(lit_ts(as_of), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    m = F.col("_m")
    has = lambda k: F.coalesce(F.map_contains_key(m, F.lit(k)), F.lit(False))
    get = lambda k: F.element_at(m, F.lit(k))
    as_text = lambda v: F.try_variant_get(v, "$", "string")

    df = records.withColumn("_m", unwrap_typed("record"))
    value = F.when(has("value"), F.try_variant_get(get("value"), "$", "double"))
    count = F.when(has("count"), F.try_variant_get(get("count"), "$", "bigint"))
    total = F.when(has("total_value"), F.try_variant_get(get("total_value"), "$", "double"))
    average = F.when(count > 0, total / count)
    computed = F.map_from_arrays(
        F.array(F.lit("value"), F.lit("count"), F.lit("average")),
        F.array(value.cast("variant"), count.cast("variant"),
                F.when(~has("average"), average).cast("variant")))
    rest = F.map_filter(m, lambda k, v: ~k.isin(*CONSUMED_FIELDS))
    data = F.map_concat(F.map_filter(computed, lambda k, v: v.isNotNull()), rest)
    out = df.select(
        "*",
        F.when(has("id"), as_text(get("id")))
         .when(has("partition_key"), as_text(get("partition_key")))
         .otherwise(F.lit("unknown")).alias("id"),
        F.when(has("timestamp"), as_text(get("timestamp"))).otherwise(stamp).alias("timestamp"),
        stamp.alias("processed_at"),
        F.to_variant_object(data).alias("data"),
        bad_numbers("record").alias("_bad_number"),
    )
    ok, bad = split_valid(out, {"bad_number": F.col("_bad_number"),
                                "not_an_object": F.col("_m").isNull()})
    keep = [*[c for c in records.columns if c != "record"], "id", "timestamp", "processed_at", "data"]
    return ok.select(*keep), bad.select(*records.columns, "reasons")


def validate_for_load(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id`` and ``timestamp`` are required at load."""
    return split_valid(df, {"missing_id": F.col("id").isNull(),
                            "missing_timestamp": F.col("timestamp").isNull()})


def to_storage_types(df: DataFrame) -> DataFrame:
    """Storage form of ``data``: nulls dropped, numbers kept as numbers,
    booleans kept (Q8), lists of scalars become lists of text, anything
    nested deeper than one level becomes JSON text (Q9)."""
    def store(k, v):
        kind = F.schema_of_variant(v)
        return (F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY<OBJECT")
                       | kind.startswith("ARRAY<ARRAY"), F.to_json(v).cast("variant"))
                .when(kind.startswith("ARRAY"),
                      F.transform(v.try_cast("array<variant>"),
                                  lambda e: F.coalesce(F.try_variant_get(e, "$", "string"), F.to_json(e)))
                      .cast("variant"))
                .otherwise(v))
    m = F.col("data").try_cast("map<string, variant>")
    cleaned = F.transform_values(F.map_filter(m, lambda k, v: ~F.is_variant_null(v)), store)
    return df.withColumn("data", F.to_variant_object(cleaned))


def load_latest(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Keyed load: one row per ``(id, timestamp)``, the one of highest ``seq``
    (the input order, total) winning."""
    return (df.groupBy("id", "timestamp")
            .agg(F.max_by(F.struct("processed_at", "data"), F.col(seq)).alias("_r"))
            .select("id", "timestamp", "_r.processed_at", "_r.data"))


def run_audit(steps: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per step the rows passed on, the rejected ones and the first error
    texts (in sort order, at most 5)."""
    out = None
    for step, (ok, bad) in steps.items():
        rows = (ok.select(F.lit(True).alias("_ok"), F.lit(None).cast("string").alias("_e"))
                .unionByName(bad.select(F.lit(False).alias("_ok"), F.array_join("reasons", ",").alias("_e"))))
        # Reasons are combinations of rule names: a small set.
        one = (rows.groupBy("_ok", "_e").agg(F.count(F.lit(1)).alias("_n")).groupBy()
               .agg(F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_n"))), F.lit(0)).alias("processed"),
                    F.coalesce(F.sum(F.when(~F.col("_ok"), F.col("_n"))), F.lit(0)).alias("errors"),
                    F.array_join(F.slice(F.array_sort(F.collect_set("_e")), 1, 5), "; ").alias("first_errors"))
               .select(F.lit(step).alias("step"), "processed", "errors", "first_errors"))
        out = one if out is None else out.unionByName(one)
    return out


def stage(df: DataFrame, root: str, zone: str, day_col: str) -> str:
    """Write a zone dataset partitioned by year/month/day; returns
    the path.  Re-running a day overwrites only that day's partitions."""
    path = f"{root.rstrip('/')}/{zone}"
    d = F.col(day_col)
    (df.withColumns({"year": F.date_format(d, "yyyy"), "month": F.date_format(d, "MM"),
                     "day": F.date_format(d, "dd")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "day").parquet(path))
    return path


def save_result(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Query-result sink."""
    df.write.mode("overwrite").format(fmt).save(path)
