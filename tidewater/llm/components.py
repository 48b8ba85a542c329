"""Connected components of a graph given as edges, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import materialise


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge other than to itself.

    ``edges`` has columns ``u`` and ``v`` (long); the root is the component's
    smallest node.  The number of steps grows with the logarithm of the
    longest path; each step's edges are a table in the shared folder.
    Minima are combined before the shuffle, so a node with very many edges
    costs one row for each task.
    """
    edges = materialise(edges.where("u != v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        edges = materialise(_stars(edges), "edges")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
