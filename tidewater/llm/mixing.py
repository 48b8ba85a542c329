"""Mixing sources to target weights with hash-threshold histograms.

Every source gets a target of words; each of its documents is taken in whole
passes, and one more pass goes to the documents whose id hash lies below the
source's threshold.  The threshold comes from histograms: words are summed by
source and leading hash bits, the bucket in which the budget runs out is found,
and only that bucket is summed again by its next bits.  No document is sorted,
and the choice depends on nothing but ids, sizes and weights.

Defined results: null or empty text has size 0 and is taken 0 words; the null
source is one source, the last; a null id hashes like the empty text; rows of
equal id are chosen together; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import free_prefix, materialise, table

WEIGHTS, CAP = (5, 2, 1), 3
_HASH_BITS, _LEVEL_BITS = 60, 12
_WIDE = "decimal(38,0)"


def word_count(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def id_hash(col: str) -> F.Column:
    """The first 60 bits of md5 of the id's text."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _ranked(totals: DataFrame) -> DataFrame:
    """Rank of each source by code point, null last, without a global sort's single task.

    Ranges are sorted apart; only the number of rows of each range comes to
    the driver.
    """
    cut = (totals.withColumn("_null", F.col("source").isNull()).repartitionByRange("_null", "source")
           .sortWithinPartitions("_null", "source").withColumn("_at", F.monotonically_increasing_id()).drop("_null"))
    cut = materialise(cut, "sources").withColumn("_part", F.shiftright("_at", 33))
    before, offsets = 0, []
    for r in sorted(cut.groupBy("_part").count().collect()):
        offsets += [F.lit(r["_part"]), F.lit(before)]
        before += r["count"]
    shift = F.create_map(*offsets)[F.col("_part")] if offsets else F.lit(0)
    rank = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + shift
    return cut.withColumn("rank", rank.cast("long")).drop("_at", "_part")


def _targets(sources: DataFrame) -> DataFrame:
    """Adds target, passes and the numerator of what is left for one more pass.

    Sources whose share is above ``CAP`` times their size stop there, and what
    is left is shared by the weights of the others, until none is above.
    """
    total = sources.agg(F.sum(F.col("source_size").cast(_WIDE))).first()[0] or 0
    weight = sources.agg(F.sum("weight")).first()[0] or 1
    left, open_weight = int(total), int(weight)
    while True:
        above = (F.col("source_size").cast(_WIDE) * F.lit(CAP * open_weight).cast("decimal(18,0)")
                 < F.col("weight").cast("decimal(10,0)") * F.lit(left).cast("decimal(28,0)"))
        got = sources.agg(F.sum(F.when(above, CAP * F.col("source_size").cast(_WIDE))), F.sum(F.when(~above, F.col("weight")))).first()
        now = int(total) - int(got[0] or 0), int(got[1] or 1)
        if now == (left, open_weight):
            break
        left, open_weight = now
    share = F.col("weight").cast("decimal(10,0)") * F.lit(left).cast("decimal(28,0)")
    unit = F.col("source_size").cast("decimal(20,0)") * F.lit(open_weight).cast("decimal(18,0)")
    passes = F.when(F.col("source_size") == 0, 0).when(above, CAP).otherwise(F.floor(share / F.greatest(unit, F.lit(1))))
    out = sources.withColumn("passes", passes.cast("int")).withColumn(
        "target", F.when(above, (CAP * F.col("source_size")).cast("double")).otherwise(share.cast("double") / F.lit(float(open_weight))))
    rest = F.when(above | (F.col("source_size") == 0), F.lit(0).cast(_WIDE)).otherwise((share - F.col("passes") * unit).cast(_WIDE))
    return out.withColumn("rest", rest).withColumn("unit", F.lit(open_weight).cast("decimal(18,0)"))


def _thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(rank, threshold) of each source with something left for one more pass."""
    at = materialise(sources.where("rest > 0").select("rank", "rest", "unit", F.lit(0).cast("long").alias("prefix")), "budgets")
    found = []
    for low in range(_HASH_BITS - _LEVEL_BITS, -1, -_LEVEL_BITS):
        if at.isEmpty():
            break
        inside = (rows.join(at, "rank").where(F.shiftright("hash", low + _LEVEL_BITS) == F.col("prefix")))
        sums = (inside.groupBy("rank", F.shiftright("hash", low).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("hash").alias("first"), F.max("hash").alias("last"),
                     F.first("rest").alias("rest"), F.first("unit").alias("unit")))
        # A window over a source's buckets of one level: 2 ** _LEVEL_BITS rows at most.
        run = F.sum("words").over(_buckets())
        cross = (sums.withColumn("upto", run.cast("decimal(20,0)") * F.col("unit"))
                 .withColumn("words_n", F.col("words").cast("decimal(20,0)") * F.col("unit"))
                 .withColumn("before", F.col("upto") - F.col("words_n"))
                 .where("upto >= rest and before < rest"))
        cross = materialise(cross.select("rank", "bucket", "first", "last", "words_n", "unit",
                                         (F.col("rest") - F.col("before")).cast(_WIDE).alias("rest")), "crossings")
        one = F.col("first") == F.col("last")
        found.append(cross.where(one).select("rank", F.when(2 * F.col("rest") >= F.col("words_n"), F.col("first") + 1)
                                             .otherwise(F.col("first")).alias("threshold")))
        at = cross.where(~one).select("rank", "rest", "unit", F.col("bucket").alias("prefix"))
    out = sources.sparkSession.createDataFrame([], "rank long, threshold long")
    for f in found:
        out = out.unionByName(f)
    return out


def _buckets():
    from pyspark.sql import Window

    return Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target, passes, threshold) of each source."""
    sizes = materialise(docs.select("source", word_count(F.col("text")).alias("size"), id_hash("doc_id").alias("hash")), "sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = _ranked(totals).withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    sources = materialise(_targets(materialise(ranked, "weighted")), "targets")
    key = sources.select(F.col("source").alias("_source"), "rank")
    rows = sizes.where("size > 0").join(key, F.col("source").eqNullSafe(F.col("_source"))).select("rank", "size", "hash")
    thresholds = _thresholds(materialise(rows, "ranked-sizes"), sources)
    plan = (sources.join(thresholds, "rank", "left")
            .select("source", "source_size", "target", "passes", F.coalesce("threshold", F.lit(0).cast("long")).alias("threshold")))
    return materialise(plan, "mixing-plan")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows with size, source_size, target, copies and taken beside them.

    These names replace input columns of the same name.
    """
    plan = mixing_plan(docs, weights)
    own = free_prefix(docs, "_mix")
    plan = plan.select(*[F.col(c).alias(f"{own}_{c}") for c in plan.columns])
    new = ("size", "source_size", "target", "copies", "taken")
    keep = [c for c in docs.columns if c not in new]
    extra = F.col(f"{own}_hash") < F.col(f"{own}_threshold")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], word_count(F.col("text")).alias("size"), id_hash("doc_id").alias(f"{own}_hash"))
    return (rows.join(plan, F.col("source").eqNullSafe(F.col(f"{own}_source")))
            .withColumn("copies", F.when(F.col("size") > 0, F.col(f"{own}_passes") + extra.cast("int")).otherwise(0))
            .select(*[F.col(f"`{c}`") for c in keep], "size", F.col(f"{own}_source_size").alias("source_size"),
                    F.col(f"{own}_target").alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken")))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS n FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS w FROM s),
c AS (SELECT *, sum(n) OVER () AS total, coalesce(sum(3 * n) OVER (ORDER BY n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(w) OVER (ORDER BY n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM w),
k AS (SELECT *, 3 * n * weights < w * (total - before) AS capped FROM c),
o AS (SELECT max(total) - coalesce(sum(3 * n) FILTER (capped), 0) AS lft, coalesce(sum(w) FILTER (NOT capped), 1) AS ow FROM k),
t AS (SELECT source, n, capped, lft, ow, w, CASE WHEN capped THEN CAST(3 * n AS DOUBLE) ELSE CAST(w * lft AS DOUBLE) / CAST(ow AS DOUBLE) END AS target,
        CASE WHEN n = 0 THEN 0 WHEN capped THEN 3 ELSE (w * lft) // (n * ow) END AS passes FROM k, o),
r AS (SELECT *, CASE WHEN capped OR n = 0 THEN 0 ELSE w * lft - passes * n * ow END AS rest FROM t),
g AS (SELECT source, h, sum(size)::HUGEINT AS words FROM d WHERE size > 0 GROUP BY source, h),
u AS (SELECT g.source, g.h, g.words * r.ow AS words, r.rest, sum(g.words * r.ow) OVER (PARTITION BY g.source ORDER BY g.h) AS upto
        FROM g JOIN r ON g.source IS NOT DISTINCT FROM r.source),
x AS (SELECT source, max(h) FILTER (upto <= rest OR (upto - words < rest AND 2 * (rest - (upto - words)) >= words)) AS last FROM u GROUP BY source)
SELECT d.doc_id, d.size, CAST(r.n AS BIGINT) AS source_size, r.target, CAST(d.size * (r.passes + CASE WHEN d.h <= coalesce(x.last, -1) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source
"""
