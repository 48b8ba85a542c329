"""N-gram Jaccard join: prefix filters under several token orders.

Documents are sets of n-word shingles.  Sets of sizes a and b have a Jaccard
similarity of t or more when they share o = t / (1 + t) * (a + b) tokens or more,
and then, whatever the order of the tokens, k of those among the first
a - o + k of the one and b - o + k of the other.  Candidates come from a join on
such prefixes under one order; the prefixes of two more orders are intersected
before any text is compared.

Counts of hash buckets over all rows, a table of fixed size, tell rare tokens
from common ones.  The first order goes by that count, so that common lines and
phrases don't make candidates; the others go by its half octave, and within it
by a hash of their own.

Equal sets are one node.  The first round compares each node with one of its
prefix token and size band, the one that shares most of its tokens; that joins
large groups of near copies by few comparisons.  The second round compares every pair of candidates that is still in
different components.  So no link between different components is missed, and
no group is expanded into all its pairs.

Defined results: null or empty text, or text without words, has no shingles
and its own component; fewer than n words are one shingle; rows that repeat
are copies; a null id is never a component's smallest unless it is alone; an
empty table gives an empty one.  Only id and text are read.  Shingles and sets
are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.components import connected_components
from tidewater.llm.shared import SUM_SCHEMA, array_rows, bounded_batches, discard, free_prefix, keyed_hash, materialise, release_finished, sum_arrays, table
from tidewater.llm.textarrays import chunks, mix, ngrams, shingle_set, word_hashes

BUCKET_BITS = 18
#: Tokens that similar sets must share in a prefix of the first order, and in
#: the longer ones of the others, at most.
FIRST_SHARED, SHARED = 2, 24
_SEEDS = tuple(np.uint64(x) for x in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x6A09E667F3BCC909))


def _sets(column: pa.Array, n: int):
    """(row, sorted distinct shingles) of each text."""
    for c in chunks(column):
        words, at = word_hashes(c)
        grams = ngrams(words, n)
        for d in range(c.n):
            yield c.first + d, shingle_set(words[at[d]:at[d + 1]], grams[at[d]:at[d + 1]], n)


def bucket_counts(docs: DataFrame, n: int) -> np.ndarray:
    """Count of all shingles in each hash bucket."""

    def count(batches):
        from pyspark import TaskContext

        counts = np.zeros(1 << BUCKET_BITS)
        for batch in batches:
            for c in chunks(batch.column(0)):
                words, at = word_hashes(c)
                grams = ngrams(words, n)
                inside = np.ones(len(grams), bool)
                for k in range(1, n):   # runs that cross into the next document
                    cross = at[1:-1] - k
                    inside[cross[(cross >= 0) & (cross < len(grams))]] = False
                counts += np.bincount((grams[inside] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64),
                                      minlength=1 << BUCKET_BITS)
        yield array_rows(counts, TaskContext.get().partitionId())

    total = sum_arrays(docs.select("text").mapInArrow(count, SUM_SCHEMA), 1 << BUCKET_BITS)
    return np.minimum(total, (1 << 32) - 1).astype(np.uint64)


def _prefix(tokens: np.ndarray, counts: np.ndarray, order: int, length: int) -> np.ndarray:
    length = min(length, len(tokens))
    first = counts[(tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
    if order:
        first = np.round(2 * np.log2(1.0 + first)).astype(np.uint64)
    rank = (first << np.uint64(32)) | (mix(tokens ^ _SEEDS[order]) >> np.uint64(32))
    at = np.argpartition(rank, length - 1)[:length]
    return tokens[at[np.argsort(rank[at])]]


def _least_shared(n: int, percent: int) -> int:
    """Tokens that a set of n must share with any set that is similar to it."""
    return -(-percent * n // 100)


def _overlap(a: str, b: str, percent: int) -> F.Column:
    """Tokens that similar sets of these sizes share at least."""
    return F.expr(f"({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent}")


def _may_join(a: str, b: str, percent: int) -> F.Column:
    """Whether a shared token at places ``a_pos`` and ``b_pos`` makes a candidate.

    That is, lies in both prefixes that are long enough for the two sizes.
    """
    o = _overlap(f"{a}_n", f"{b}_n", percent)
    more = F.least(o, F.lit(FIRST_SHARED))
    return ((o <= F.least(f"{a}_n", f"{b}_n")) & (F.col(f"{a}_pos") < F.col(f"{a}_n") - o + more)
            & (F.col(f"{b}_pos") < F.col(f"{b}_n") - o + more))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _signatures(docs: DataFrame, n: int, percent: int, counts: Broadcast) -> DataFrame:
    """(doc_id, rid, n, node, prefix) of each row; node is the set's hash."""

    def run(batches):
        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            node = np.zeros(batch.num_rows, np.uint64)
            prefix = [np.zeros(0, np.uint64)] * batch.num_rows
            for row, tokens in _sets(batch.column(2), n):
                size[row] = k = len(tokens)
                if k:
                    node[row] = np.bitwise_xor(np.add.reduce(mix(tokens)), np.uint64(k))
                    least = _least_shared(k, percent)
                    prefix[row] = _prefix(tokens, counts.value, 0, k - least + min(FIRST_SHARED, least))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size), pa.array(mix(node).view(np.int64)), _lists(prefix)],
                names=["doc_id", "rid", "n", "node", "prefix"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", keyed_hash("doc_id", "text").alias("rid"), "text")
            .mapInArrow(run, f"doc_id {kind}, rid long, n long, node long, prefix array<long>"))


def _prefixes_and_text(docs: DataFrame, wanted: DataFrame, n: int, percent: int, counts: Broadcast) -> DataFrame:
    """(node, n, second, third, text) of the wanted (rid, node), node by number."""

    def run(batches):
        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            second, third = [None] * batch.num_rows, [None] * batch.num_rows
            for row, tokens in _sets(batch.column(1), n):
                k = len(tokens)
                least = _least_shared(k, percent)
                size[row], more = k, min(SHARED, least)
                second[row] = _prefix(tokens, counts.value, 1, k - least + more)
                third[row] = _prefix(tokens, counts.value, 2, k - least + more)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), _lists(second), _lists(third), batch.column(1)],
                names=["node", "n", "second", "third", "text"])

    rows = docs.select(keyed_hash("doc_id", "text").alias("rid"), "text").join(wanted, "rid").select("node", "text")
    return rows.mapInArrow(run, "node long, n long, second array<long>, third array<long>, text string")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int, counts: Broadcast) -> DataFrame:
    """Those of the stored pairs (u, v) whose sets are similar, stored."""
    ends = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    # One row for each node, also where rows repeat.
    wanted = nodes.join(ends, "node").groupBy("node").agg(F.min("rid").alias("rid"))
    sets = materialise(_prefixes_and_text(docs, wanted, n, percent, counts), "sets")
    release_finished(docs.sparkSession)     # the shuffled texts

    def side(key, *cols):
        return sets.select(F.col("node").alias(key), *[F.col(c).alias(f"{key}_{c}") for c in cols])

    def similar(batches):
        for batch in batches:
            left = [s for _, s in _sets(batch.column(2), n)]
            ok = np.zeros(batch.num_rows, bool)
            for row, b in _sets(batch.column(3), n):
                a = left[row]
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                both = int((a[at] == b).sum()) if len(a) else 0
                ok[row] = both > 0 and 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select([0, 1]).filter(pa.array(ok))

    columns = ("n", "second", "third", "text")
    kept = pairs.join(side("u", *columns), "u").join(side("v", *columns), "v")
    for order in ("second", "third"):
        beyond = F.greatest(*[F.col(f"{k}_n") - F.size(f"{k}_{order}") for k in ("u", "v")])
        kept = kept.where(F.size(F.array_intersect(f"u_{order}", f"v_{order}")) >= _overlap("u_n", "v_n", percent) - beyond)
    links = materialise(kept.select("u", "v", "u_text", "v_text").mapInArrow(similar, "u long, v long").distinct(), "links")
    discard(sets)
    return links


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, rid, n_shingles, component_id, root) of each row of (doc_id, text).

    ``rid`` is ``keyed_hash(doc_id, text)``.  Documents link when 100 * shared
    shingles >= percent * all shingles of the two; ``component_id`` is the
    smallest id reachable by links, which components may share if ids repeat.
    ``root`` is the component's own number, null for a row without copies.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    counts = spark.sparkContext.broadcast(bucket_counts(docs, n))     # 2 ** BUCKET_BITS numbers
    full = materialise(_signatures(docs, n, percent, counts), "signatures")
    # Equal sets are one node; numbers of the nodes take less room than hashes.
    nodes = materialise(full.where("n > 0").groupBy(F.col("node").alias("hash"))
                        .agg(F.min("rid").alias("rid"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = materialise(full.select("doc_id", "rid", "n", "node"), "rows")
    discard(full)
    # Sizes of similar sets differ by this factor at most: bands for the first round.
    band = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(percent / 100)))
    posts = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = posts.groupBy("token").agg(F.count("*").alias("_k")).where("_k > 1").select("token")
    stored = materialise(posts.join(shared, "token"), "shared-prefixes")
    posts = stored.withColumn("band", band)
    release_finished(spark)

    # Near copies of a text lack its tokens, so the text itself shares most.
    central = posts.groupBy("node").agg(F.count("*").alias("common"))
    pivots = (posts.join(central, "node").groupBy("token", "band")
              .agg(F.max(F.struct("common", F.col("node").alias("v"), F.col("n").alias("v_n"), F.col("pos").alias("v_pos"))).alias("_p"),
                   F.count("*").alias("_k")).where("_k > 1").select("token", "band", "_p.v", "_p.v_n", "_p.v_pos"))
    first = (posts.select("token", "band", F.col("node").alias("u"), F.col("n").alias("u_n"), F.col("pos").alias("u_pos"))
             .join(pivots, ["token", "band"]).where("u != v").where(_may_join("u", "v", percent)).select("u", "v").distinct())
    first = materialise(first, "first-pairs")
    links = _verified(first, docs, nodes, n, percent, counts)
    roots = materialise(connected_components(links), "roots")

    # Second round: pairs of a token's smaller components with all its nodes.
    own = (posts.join(roots, "node", "left").select("token", F.col("node").alias("b"), F.col("n").alias("b_n"),
                                                   F.col("pos").alias("b_pos"), F.coalesce("root", "node").alias("root")))
    own = materialise(own, "rooted-prefixes")
    discard(stored)
    largest = (own.groupBy("token", "root").agg(F.count("*").alias("_k"))
               .groupBy("token").agg(F.max(F.struct("_k", "root")).root.alias("largest"), F.count("*").alias("_roots"))
               .where("_roots > 1").select("token", "largest"))
    minor = (own.join(largest, "token").where("root != largest")
             .select("token", F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("b_pos").alias("a_pos"),
                     F.col("root").alias("a_root"), "largest"))
    pairs = (minor.join(own, "token")
             .where((F.col("root") != F.col("a_root")) & ((F.col("root") == F.col("largest")) | (F.col("b") < F.col("a")))
                    & _may_join("a", "b", percent))
             .groupBy(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .agg(F.count("*").alias("_k"), F.first(_overlap("a_n", "b_n", percent)).alias("_o"))
             .where(F.col("_k") >= F.least("_o", F.lit(FIRST_SHARED))).select("u", "v"))
    known = first.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs = materialise(pairs.join(known, ["u", "v"], "left_anti"), "second-pairs")
    discard(own)
    more = _verified(pairs, docs, nodes, n, percent, counts)
    if not more.isEmpty():
        # Components of the components that the second round links.
        named = more
        for end in ("u", "v"):
            own = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
            named = named.join(own, end, "left").withColumn(end, F.coalesce("_root", end)).select("u", "v")
        joined = materialise(connected_components(named), "joined")
        roots = (roots.unionByName(joined.select("node", F.col("node").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
                 .join(joined.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left")
                 .select("node", F.coalesce("_to", "root").alias("root")))
        roots = materialise(roots, "roots")

    lows = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("_k"))
    numbers = nodes.select("hash", "node").join(roots, "node", "left").select(F.col("hash").alias("node"), "root", F.col("node").alias("number"))
    lows = materialise(lows.join(numbers, "node").where("_k > 1 or root is not null")
                       .select("node", "low", F.coalesce("root", "number").alias("root")), "lows")
    discard(nodes)
    groups = lows.groupBy("root").agg(F.min("low").alias("component"))
    named = lows.join(groups, "root").select("node", "component", "root")
    return (rows.select("doc_id", "rid", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
            .join(named, "node", "left")
            .select("doc_id", "rid", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "root"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The row of smallest id of each component, with its columns.

    Of equal ids the one of smaller ``keyed_hash``, a null id last; of equal
    rows one.  Components are told apart by their own numbers, not by ids.
    """
    found = materialise(jaccard_components(docs, n, percent), "components")
    # Rows without a root have no copies, also those without words: each stays.
    groups = found.where("root is not null").groupBy("root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).rid
    stays = groups.agg(first.alias("_stays"), F.count("*").alias("_k")).where("_k > 1")
    copies = materialise(found.join(stays, "root").select("rid", "_stays"), "copies")
    release_finished(docs.sparkSession)
    own = free_prefix(docs, "_rid")
    gone = copies.where("rid != _stays").select(F.col("rid").alias(own)).distinct()
    twice = copies.where("rid = _stays").groupBy("rid").count().where("count > 1").select(F.col("rid").alias(own))
    keyed = docs.withColumn(own, keyed_hash("doc_id", "text"))
    one = keyed.join(twice, own, "left_semi").dropDuplicates([own])
    return (keyed.join(gone.unionByName(twice), own, "left_anti").unionByName(one)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (jaccard_components(table(spark, sf_dir, "documents"), 3, 90)
            .select("doc_id", "n_shingles", "component_id"))
