"""Quality rules: an isolation forest over rule statistics of each document.

``rule_statistics`` counts in one pass over the text, ``fit_forest`` grows
random splits over labelled rows' statistics, ``quality_verdicts`` rejects the
documents that a few splits already set apart.

Defined results: null or empty text has zero counts and fails the base rules;
rows that repeat are judged alike; an empty table gives an empty one; with no
usable labels every document that passes the base rules stays; columns of the
input other than id and text are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.shared import bounded_batches, discard, free_prefix, materialise, table
from tidewater.llm.textarrays import SPACE, Chunk, chunks, hash_spans, ngrams, word_spans

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks")
MIN_WORDS = 50
#: Trees, the rows that a tree gets while there are fewer than all trees need, and how deep it grows.
TREES, TREE_ROWS, TREE_DEPTH = 128, 1024, 10
#: Ranges of scores within which counts are summed up.
RANGES = 65_536
#: Rejecting a share of the good rows costs as much as keeping this many times
#: that share of the bad ones.
GOOD_WEIGHT = 10

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_HEAD = (np.arange(256) & 0xC0) != 0x80
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeat_words(grams: np.ndarray) -> int:
    """Words covered by windows whose hash occurs twice or more."""
    order = np.argsort(grams, kind="stable")
    s = grams[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(s) + 1, bool)
    twice[1:-1] = same
    hit = np.zeros(len(grams) + 2, bool)
    at = order[twice[1:] | twice[:-1]]
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def statistics_of(column: pa.Array) -> np.ndarray:
    """One row of ``STATS`` for each text of an Arrow column."""
    out = np.zeros((len(column), len(STATS)), np.int64)
    for c in chunks(column):
        rows = out[c.first:c.first + c.n]
        starts, ends, at = word_spans(c)
        hashes = hash_spans(c.data, starts, ends, lower=False)
        grams = ngrams(hashes, 3)
        rows[:, 0] = np.diff(at)
        rows[:, 1] = _sums(_HEAD[c.data] & ~SPACE[c.data], c.offsets)
        rows[:, 2] = _sums(_SYMBOL[c.data], c.offsets)
        rows[:, 5] = _sums(_MARK[c.data], c.offsets)
        rows[:, 3] = _dup_lines(c, starts)
        for d in np.flatnonzero(rows[:, 0] > 3):
            rows[d, 4] = _repeat_words(grams[at[d]:at[d + 1] - 2])
    return out


def _dup_lines(c: Chunk, word_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier one of their document."""
    breaks = np.flatnonzero(c.data == 0x0A)
    starts = np.concatenate([c.offsets[:-1], breaks + 1])
    ends = np.concatenate([c.offsets[1:], breaks])
    starts.sort(kind="stable")
    ends.sort(kind="stable")
    # A line without a word holds no word start between its ends.
    has = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[has], ends[has]
    doc = np.searchsorted(c.offsets, starts, "right") - 1
    hashes = hash_spans(c.data, starts, ends, lower=False)
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    dup = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    return np.bincount(d[1:][dup], minlength=c.n)


def features_of(stats: np.ndarray) -> np.ndarray:
    """Mean word length; symbols, marks and repeated words for each word."""
    s = stats.astype(np.float64)
    return s[:, [1, 2, 4, 5]] / np.maximum(s[:, :1], 1)


class Forest(NamedTuple):
    """Complete binary trees in heap order; ``feature`` -1 marks a leaf."""

    feature: np.ndarray    # (trees, nodes) int16
    split: np.ndarray      # (trees, nodes)
    length: np.ndarray     # path length given to a row that ends at the node
    norm: float
    threshold: float       # scores above it are rejected


def _average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_tree(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random splits of the rows down to single ones or ``TREE_DEPTH``."""
    feature = np.full(2 ** (TREE_DEPTH + 1), -1, np.int16)
    split, length = np.zeros(len(feature)), np.zeros(len(feature))
    work = [(1, 0, x)]
    while work:
        node, at, rows = work.pop()
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
        wide = np.flatnonzero(high > low)
        if at == TREE_DEPTH or len(rows) <= 1 or not len(wide):
            length[node] = at + _average_path(len(rows))
            continue
        f = int(rng.choice(wide))
        feature[node], split[node] = f, rng.uniform(low[f], high[f])
        left = rows[:, f] <= split[node]
        work += [(2 * node, at + 1, rows[left]), (2 * node + 1, at + 1, rows[~left])]
    return feature, split, length


def _grow(key: tuple, table: pa.Table) -> pa.Table:
    """One tree over the rows dealt to it, whatever order they came in."""
    x = np.stack([table.column(f"x{k}").to_numpy() for k in range(4)], axis=1)
    x = x[np.lexsort(x.T)]
    arrays = grow_tree(x, np.random.default_rng((7, key[0].as_py())))
    return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(x)], pa.int64()),
                     **{name: pa.array([a.tobytes()], pa.binary()) for name, a in zip(("feature", "split", "length"), arrays)}})


def grow_forest(good: DataFrame, n: int) -> Forest | None:
    """Trees over all of the ``n`` rows (key, x0..x3), each in one tree at least and
    in as many as give a tree ``TREE_ROWS``; a tree is grown by one task."""
    copies = max(1, min(TREES, -(-TREES * TREE_ROWS // n)))
    first = F.pmod(F.xxhash64("key"), F.lit(TREES))
    dealt = good.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    step = F.pmod(F.xxhash64("key", F.lit("step")), F.lit(TREES // 2)) * 2 + 1     # odd, so no tree comes twice
    dealt = dealt.withColumn("tree", F.pmod(first + F.col("tree") * step, F.lit(TREES)).cast("int"))
    trees = (dealt.select("tree", *[f"x{k}" for k in range(4)]).groupBy("tree")
             .applyInArrow(_grow, "tree int, n long, feature binary, split binary, length binary").orderBy("tree").collect())
    part = lambda name, dtype: np.stack([np.frombuffer(bytes(r[name]), dtype) for r in trees])
    norm = max(np.mean([_average_path(r.n) for r in trees]), 1e-9)
    return Forest(part("feature", np.int16), part("split", np.float64), part("length", np.float64), float(norm), np.inf)


def anomaly(forest: Forest, x: np.ndarray) -> np.ndarray:
    """2 ** (-mean path length / its norm): near 1 for rows soon set apart."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    depth = forest.feature.shape[1].bit_length() - 1
    for feature, split, length in zip(forest.feature, forest.split, forest.length):
        node = np.ones(len(x), np.int64)
        for _ in range(depth):
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            right = x[rows, np.maximum(f, 0)] > split[node]
            node = np.where(inner, 2 * node + right, node)
        total += length[node]
    return 2.0 ** (-total / len(forest.length) / forest.norm)


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > 50 * stats[:, 0])


def fit_forest(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """Forest over all labelled rows, and its threshold.

    Of the rows that pass the base rules, the trees grow on the good ones; the
    threshold comes from ``calibrate``.  Only the trees reach the driver.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    labelled = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality"))
                .where("_id is not null and _quality is not null").groupBy("_id").agg(F.min("_quality").alias("_quality")))
    # Statistics first, so that no text is shuffled; where an id is repeated, the text of lowest hash counts.
    texts = docs.where("doc_id is not null").select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    stats = texts.mapInArrow(
        _labelled_statistics, f"_id {id_type}, _hash long, failed boolean, x0 double, x1 double, x2 double, x3 double")
    fields = ["failed", "x0", "x1", "x2", "x3"]
    one = stats.groupBy("_id").agg(F.min_by(F.struct(*fields), F.struct("_hash", *fields)).alias("_s"))
    rows = materialise(one.join(labelled, "_id").where("not _s.failed")
                       .select(F.col("_id").alias("key"), (F.col("_quality") == 1).alias("good"), "_s.x0", "_s.x1", "_s.x2", "_s.x3"), "rule-rows")
    try:
        n = rows.where("good").count()
        if n < 2:
            return None
        forest = grow_forest(rows.where("good"), n)
        return forest._replace(threshold=calibrate(_scored(rows, forest)))
    finally:
        discard(rows)


def _scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """(good, score) of each labelled row."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)  # of a size fixed by TREES

    def score(batches):
        for batch in batches:
            x = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(anomaly(shared.value, x))], names=["good", "score"])

    return rows.select("good", "x0", "x1", "x2", "x3").mapInArrow(score, "good boolean, score double")


def calibrate(scores: DataFrame) -> float:
    """Threshold that rejects most bad rows for ``GOOD_WEIGHT`` times fewer good ones.

    Of equal choices the highest, moved half way to the score above it.  Counts of a
    score are summed up within ranges of scores, after the counts of all ranges below.
    """
    by_score = materialise(
        scores.groupBy("score").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
        .withColumn("range", F.floor(F.col("score") * RANGES).cast("int")), "rule-scores")
    try:
        sums = by_score.groupBy("range").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))  # RANGES rows at most
        sums = np.array(sorted(tuple(r) for r in sums.collect()), np.int64)
        good, bad = sums[:, 1].sum(), sums[:, 2].sum()
        if not bad:
            return by_score.agg(F.max("score")).first()[0]
        below = np.cumsum(sums[:, 1:], axis=0) - sums[:, 1:]
        starts = by_score.sparkSession.createDataFrame(
            [(int(r), int(g), int(b)) for r, (g, b) in zip(sums[:, 0], below)], "range int, g0 long, b0 long")
        upto = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = by_score.join(F.broadcast(starts), "range").select("score", (F.col("g0") + F.sum("g").over(upto)).alias("g"),
                                                                 (F.col("b0") + F.sum("b").over(upto)).alias("b"))
        # Whole numbers, so that equal choices are equal: (1 - b / bad) - weight * (1 - g / good), times both sums.
        gain = F.col("g").cast("decimal(19,0)") * F.lit(int(GOOD_WEIGHT * bad)) - F.col("b").cast("decimal(19,0)") * F.lit(int(good))
        cut = run.agg(F.max(F.struct(gain.alias("gain"), "score")).alias("m")).first().m.score
        above = by_score.where(F.col("score") > cut).agg(F.min("score")).first()[0]
        return cut if above is None else (cut + above) / 2
    finally:
        discard(by_score)


def _labelled_statistics(batches):
    for batch in batches:
        stats = statistics_of(batch.column(2))
        x = features_of(stats)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(base_failed(stats)), *(pa.array(x[:, k]) for k in range(4))],
                                         names=["_id", "_hash", "failed", "x0", "x1", "x2", "x3"])


RULE_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
               "anomaly double, base_failed boolean, kept boolean")


def quality_verdicts(docs: DataFrame, forest: Forest | None, keep: list[str], prefix: str = "") -> DataFrame:
    """Statistics and verdict beside the columns ``keep`` of each row.

    The names of ``RULE_SCHEMA``, after ``prefix``, replace input columns of
    the same name.
    """
    spark = docs.sparkSession
    names = [prefix + f.split()[0] for f in RULE_SCHEMA.split(", ")]
    keep = [c for c in keep if c not in names]
    shared = spark.sparkContext.broadcast(forest)  # of a size fixed by TREES

    def judge(batches):
        for batch in batches:
            stats = statistics_of(batch.column(0))
            failed = base_failed(stats)
            own = shared.value
            score = anomaly(own, features_of(stats)) if own is not None else np.zeros(len(stats))
            ok = ~failed & ((score <= own.threshold) if own is not None else True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(stats[:, i]) for i in range(5)), pa.array(score), pa.array(failed), pa.array(ok)],
                names=[*keep, *names])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep),
                        *(prefix + f for f in RULE_SCHEMA.split(", "))])
    return docs.select(F.col("text").alias(free_prefix(docs, "_text")), *[F.col(f"`{c}`") for c in keep]).mapInArrow(judge, schema)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the rules keep, with their columns."""
    prefix = free_prefix(docs, "_rule_")
    return (quality_verdicts(docs, fit_forest(docs, labels), docs.columns, prefix).where(F.col(f"{prefix}kept"))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = fit_forest(docs, table(spark, sf_dir, "labels"))
    return quality_verdicts(docs, forest, ["doc_id"])
