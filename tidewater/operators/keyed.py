"""Keyed tables without a store: latest row, last-write-wins fold, bulk
lookup, filtered listing, top-k per group, deletes, upserts (A8; as a stored
table in ``keyed_table``)
(B15, B16, C4, E1, E2, E5, E6, E7, E8, F1-F3).

Skew: folds use ``max_by`` (partial aggregation).  Top-k per group is done in
two ranking passes -- first per (group, salt bucket), then per group over at
most ``k * buckets`` survivors -- so a group holding a third of all rows is
ranked by ``buckets`` tasks instead of one.  The result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The newest row per key (``ScanIndexForward=False, Limit=1``).
    ``order`` must be total per key; it is compared as one struct."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), ordering).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
          salt: Column | None = None, buckets: int = 16, rank_col: str = "rank") -> DataFrame:
    """Exact top-``k`` rows per group by ``order`` (first = best), ranks
    1..k in ``rank_col``.  ``order`` must be total within a group.

    ``salt`` (any well-spread column, e.g. a row id) splits each group into
    ``buckets`` for the first pass.  Without it a single pass is used, which
    is right when groups are bounded (e.g. labels of one asset).
    """
    group = list(group)
    if salt is not None and buckets > 1:
        b = F.pmod(F.xxhash64(salt), F.lit(buckets))
        w1 = Window.partitionBy(*group, "_b").orderBy(*order)
        df = (df.withColumn("_b", b).withColumn("_r1", F.row_number().over(w1))
              .filter(F.col("_r1") <= k).drop("_b", "_r1"))
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def lookup(state: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """B15 (bulk form): every requested key with ``found`` and the row."""
    marked = state.withColumn("_found", F.lit(True))
    out = keys.join(marked, key, "left")
    return out.withColumn("found", F.coalesce(F.col("_found"), F.lit(False))).drop("_found")


def list_rows(state: DataFrame, key: str, status: str | None = None,
              status_col: str = "status", limit: int = 100) -> DataFrame:
    """Optional status filter, then the first ``limit`` rows by
    key (filter before limit: Q13).  Plans as a bounded top-n."""
    df = state.filter(F.col(status_col) == status) if status else state
    return df.orderBy(key).limit(limit)


def list_by_creation(state: DataFrame, status: str, created: str, key: str,
                     status_col: str = "status", limit: int = 100) -> DataFrame:
    """The newest ``limit`` rows of one status, newest first (ties by key)."""
    return state.filter(F.col(status_col) == status).orderBy(F.col(created).desc(), key).limit(limit)


def delete_outcome(state: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """C4 in one join: every row of the state and every key asked for, with
    ``outcome`` kept, deleted or missing."""
    out = state.withColumn("_in", F.lit(True)).join(keys.select(key).distinct().withColumn("_asked", F.lit(True)), key, "full_outer")
    outcome = F.when(F.col("_in").isNull(), "missing").when(F.col("_asked"), "deleted").otherwise("kept")
    return out.withColumn("outcome", outcome).drop("_in", "_asked")


def delete_keys(state: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C4: (survivors, deleted rows, keys not found)."""
    out = delete_outcome(state, keys, key)
    kept, gone, missing = (out.where(F.col("outcome") == o).drop("outcome") for o in ("kept", "deleted", "missing"))
    return kept, gone, missing.select(key)


def upsert(state: DataFrame, changes: DataFrame, key: str | Sequence[str], seq: str) -> DataFrame:
    """Full-row replace by key (one column or several); the change with
    the highest ``seq`` wins, state rows count as older than every change.
    Columns of one side only stay, NULL on the other.  Union + fold, no MERGE."""
    keys = [key] if isinstance(key, str) else list(key)
    old = state.withColumn(seq, F.lit(None).cast(changes.schema[seq].dataType)).withColumn("_v", F.lit(0))
    both = old.unionByName(changes.withColumn("_v", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c not in (*keys, seq, "_v")]
    order = F.struct(F.col("_v"), F.col(seq))
    return (both.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), order).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))
