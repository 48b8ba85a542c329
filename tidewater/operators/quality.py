"""Validation, quarantine and run audit.

Rules are boolean columns that are TRUE when a row violates them.  One pass
computes an array of violated rule names; the valid and quarantined outputs
are two filters over that single projection, so the rules are evaluated once
and the data is read once when the result is cached or written in one job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "reasons"


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reasons: array<string>`` listing the violated rules."""
    flagged = [F.when(cond, F.lit(name)) for name, cond in rules.items()]
    reasons = F.filter(F.array(*flagged), lambda x: x.isNotNull()) if flagged else F.array().cast("array<string>")
    return df.withColumn(REASONS, reasons)


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``reasons``)."""
    tagged = with_reasons(df, rules)
    broken = F.lit(False)
    for cond in rules.values():
        broken = broken | F.coalesce(cond, F.lit(False))
    # The valid rows need no list: an array function would be interpreted row by row.
    ok = df.filter(~broken).drop(REASONS)
    bad = tagged.filter(F.size(REASONS) > 0)
    return ok, bad


def required(*fields: str) -> dict[str, Column]:
    """Rules for required, non-null columns: ``missing_<field>``."""
    return {f"missing_{f}": F.col(f).isNull() for f in fields}


def reason_counts(bad: DataFrame) -> DataFrame:
    """Quarantine summary: one row per reason (a row may have several)."""
    return (bad.select(F.explode(REASONS).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


def audit(ok: DataFrame, bad: DataFrame, key: str | None = None) -> DataFrame:
    """Run audit (D5): ``processed``, ``aggregated`` (distinct keys) and
    ``errors`` as one row, from one aggregate over the union of both sides
    (partial aggregation; no join)."""
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    both = (ok.select(F.lit(True).alias("_ok"), k.alias("_k"))
            .unionByName(bad.select(F.lit(False).alias("_ok"), F.lit(None).cast("string").alias("_k"))))
    return both.agg(
        F.count_if(F.col("_ok")).alias("processed"),
        F.count_distinct("_k").alias("aggregated"),
        F.count_if(~F.col("_ok")).alias("errors"),
    )


def audit_tagged(tagged: DataFrame, key: str | None = None, counted: Column | None = None) -> DataFrame:
    """D5 in one pass over a frame tagged by ``with_reasons``.

    ``aggregated`` counts the keys of the rows that enter the aggregates:
    those of ``counted``, or the valid ones."""
    ok = F.size(REASONS) == 0
    k = F.when(ok if counted is None else counted, F.col(key).cast("string")) if key else F.lit(None).cast("string")
    return tagged.agg(F.count_if(ok).alias("processed"),
                      F.count_distinct(k).alias("aggregated"),
                      F.count_if(~ok).alias("errors"))


def first_errors(bad: DataFrame, n: int = 5, text: Column | None = None) -> DataFrame:
    """The first ``n`` distinct error texts in sort order (bounded top-n:
    each partition keeps at most ``n`` candidates)."""
    t = text if text is not None else F.array_join(F.col(REASONS), ",")
    return bad.select(t.alias("error")).distinct().orderBy("error").limit(n)
