"""Benchmark decontamination by spaced seeds.

A benchmark item is found in a document where ``WINDOW`` successive words of
the two (or the whole of a shorter item) agree in ``SHARE`` percent or more of
their positions.  Fixed masks hash some positions of a stretch of words and
ignore the others, so a hit survives substitutions at ignored positions; the
masks are chosen so that every window within the allowed substitutions holds a
hit.  Each hit's alignment is then compared word by word.

The seeds of the items are a table: hash, place, and the words up to ``REACH``
before and after, which hold every window that the hit may lie in.  A filter of
their hashes, of bounded size, is broadcast; the seeds of the documents that pass
it are written with the words around them and joined with the items' by hash, so
neither texts nor items are read again or shuffled.  A seed that many places share
is dealt out by salt.  Since every window that agrees holds a hit, the windows
around the hits are all that are to be compared.

Defined results: null or empty text, on either side, matches nothing; items of
fewer than five words must agree in full; rows that repeat on the document side
each give their rows, equal items count once, items of equal id and different texts
are items of their own; an empty table gives an empty
result; other columns are not read.  Words are compared by 64-bit hashes of
their bytes, A-Z lower-cased.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import bounded_batches, free_prefix, keyed_hash, materialise, table
from tidewater.llm.textarrays import chunks, mix, word_hashes

WINDOW, SHARE = 13, 80
REACH = WINDOW - 1
AROUND = 8 * (2 * REACH + 1)      # bytes
LEAST_BITS, MOST_BITS, PROBES = 20, 28, 3
#: Places in documents from which on a seed is dealt out over several tasks.
HOT = 4096
_STEP = 1 << 14     # seeds of a batch


def needed(window: int) -> int:
    """Words of a window that must agree."""
    return window if window < 5 else -(-SHARE * window // 100)


def _cover(window: int, weight: int) -> list[tuple[int, ...]] | None:
    """Greedy: the mask that meets most of the substitutions left, again."""
    left = set(combinations(range(window), window - needed(window)))
    hits = {}
    for span in range(weight, min(window, weight + 3) + 1):
        for inner in combinations(range(1, span - 1), max(weight - 2, 0)):
            mask = tuple(sorted({0, *inner, span - 1}))
            if len(mask) == weight:
                moved = [{p + k for p in mask} for k in range(window - span + 1)]
                hits[mask] = {w for w in left if any(m.isdisjoint(w) for m in moved)}
    chosen = []
    while left:
        best = max(hits, key=lambda m: len(hits[m] & left), default=None)
        if best is None or not hits[best] & left:
            return None
        chosen.append(best)
        left -= hits[best]
    return chosen


@cache
def masks(window: int) -> tuple[tuple[int, ...], ...]:
    """Fixed masks (positions compared) that no allowed substitution escapes.

    The heaviest that one or two masks can do with, since heavy masks hit
    unrelated text least.
    """
    for weight in range(window, 0, -1):
        found = _cover(window, weight)
        if found is not None and len(found) <= 2:
            return tuple(found)
    raise AssertionError("one compared word always covers")


def _seed_hashes(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(sum(1 << p for p in mask)), np.uint64)
    for k, p in enumerate(mask):
        out += words[p:p + n] * np.uint64(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E018 * k & (1 << 64) - 1)
    return mix(out)


def _around(words: np.ndarray, at: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The words from ``REACH`` before each position to ``REACH`` after it; 0 outside its text."""
    place = pos[:, None] + np.arange(-REACH, REACH + 1)
    inside = (place >= at[doc][:, None]) & (place < at[doc + 1][:, None])
    return np.where(inside, words[np.where(inside, place, 0)], np.uint64(0))


def _words(column: pa.Array):
    """Each chunk with its word hashes, none of them 0, and the words before each text."""
    for c in chunks(column):
        words, at = word_hashes(c)
        yield c, np.maximum(words, np.uint64(1)), at


def _rows_of(words: np.ndarray) -> pa.Array:
    """A fixed-size binary for each row of word hashes."""
    flat = np.ascontiguousarray(words)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(AROUND), len(flat), [None, pa.py_buffer(flat)]).cast(pa.binary())


_ITEM_SEEDS = "item_id {}, item long, seed long, at int, size int, around binary"


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """The seeds of each item: hash, place in the item, window, and the words around."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for c, words, at in _words(batch.column(2)):
                doc = np.repeat(np.arange(c.n), np.diff(at))
                window = np.minimum(np.diff(at), WINDOW)
                for size in np.unique(window[window > 0]).tolist():
                    for mask in masks(size):
                        h = _seed_hashes(words, mask)
                        pos = np.arange(len(h))
                        pos = pos[(window[doc[pos]] == size) & (pos + mask[-1] < at[doc[pos] + 1])]
                        for some in np.array_split(pos, -(-len(pos) // _STEP) or 1):
                            own = pa.array(doc[some] + c.first)
                            yield pa.RecordBatch.from_arrays(
                                [batch.column(0).take(own), batch.column(1).take(own), pa.array(h[some].view(np.int64)),
                                 pa.array((some - at[doc[some]]).astype(np.int32)), pa.array(np.full(len(some), size, np.int32)),
                                 _rows_of(_around(words, at, doc[some], some))],
                                names=["item_id", "item", "seed", "at", "size", "around"])

    items = benchmark.select("item_id", "text").dropDuplicates().select("item_id", keyed_hash("item_id", "text").alias("item"), "text")
    return materialise(items.mapInArrow(run, _ITEM_SEEDS.format(kind)), "item-seeds")


class Filter(NamedTuple):
    """Bits that every seed of the benchmark sets, ``PROBES`` each."""

    bits: int
    flags: np.ndarray     # packed, little-endian

    def maybe(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes whose bits are all set."""
        left = np.arange(len(h))
        for k in range(PROBES):
            bit = (mix(h[left] ^ np.uint64(k + 1)) >> np.uint64(64 - self.bits)).astype(np.int64)
            left = left[(self.flags[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0]
        return left


def seed_filter(seeds: DataFrame, n: int) -> Filter:
    """The filter over ``n`` seeds: tasks set bits, Spark joins them page by page.

    It has 32 bits a seed, but no more than ``2 ** MOST_BITS`` (32 MB), beyond which
    more documents' seeds reach the join.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (32 * n - 1).bit_length()))

    def run(batches):
        for batch in batches:
            h = np.unique(batch.column(0).to_numpy().view(np.uint64))
            for k in range(PROBES):
                bit = np.unique(mix(h ^ np.uint64(k + 1)) >> np.uint64(64 - bits)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bit)], names=["bit"])

    page = 1 << 15      # bits of a bitmap aggregate
    rows = (seeds.select("seed").mapInArrow(run, "bit long").groupBy(F.expr(f"bit div {page}").alias("page"))
            .agg(F.bitmap_construct_agg(F.expr(f"bit % {page}")).alias("flags")).toLocalIterator())
    flags = np.zeros(max(1 << bits - 3, page // 8), np.uint8)
    for r in rows:
        flags[r.page * (page // 8):(r.page + 1) * (page // 8)] = np.frombuffer(bytes(r.flags), np.uint8)
    return Filter(bits, flags)


def document_seeds(docs: DataFrame, sizes: list[int], known: Filter) -> DataFrame:
    """(rid, seed, pos, around) of the documents' seeds that the filter lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    used = tuple(dict.fromkeys(mask for size in sizes for mask in masks(size)))

    def run(batches):
        for batch in batches:
            for c, words, at in _words(batch.column(1)):
                for mask in used:
                    h = _seed_hashes(words, mask)
                    pos = shared.value.maybe(h)
                    doc = np.searchsorted(at, pos, "right") - 1
                    ok = pos + mask[-1] < at[doc + 1]      # does not run into the next document
                    pos, doc = pos[ok], doc[ok]
                    for some in np.array_split(np.arange(len(pos)), -(-len(pos) // _STEP) or 1):
                        p, d = pos[some], doc[some]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(d + c.first)), pa.array(h[p].view(np.int64)),
                             pa.array(p - at[d]), _rows_of(_around(words, at, d, p))], names=["rid", "seed", "pos", "around"])

    rows = docs.select(keyed_hash("doc_id", "text").alias("rid"), "text")
    return materialise(rows.mapInArrow(run, "rid long, seed long, pos long, around binary"), "document-seeds")


def _agreeing(batches):
    """(rid, item, shift, place) of the item's words in windows that agree around a hit."""
    for batch in batches:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        if not batch.num_rows:
            continue
        ours, theirs = (np.frombuffer(b"".join(col[c].to_pylist()), np.uint64).reshape(-1, 2 * REACH + 1) for c in ("around", "words"))
        both = (ours != 0) & (theirs != 0)
        equal = both & (ours == theirs)
        size, at = col["size"].to_numpy(), col["at"].to_numpy().astype(np.int64)
        covered = np.zeros(both.shape, bool)
        for n in np.unique(size).tolist():
            own = np.flatnonzero(size == n)
            # Windows that begin n - 1 words before the hit, up to those that begin with it.
            for first in range(REACH - n + 1, REACH + 1):
                span = slice(first, first + n)
                fits = own[both[own, span].all(1) & (equal[own, span].sum(1) >= needed(n))]
                covered[fits, span] = True
        row, k = np.nonzero(covered)
        shift = col["pos"].to_numpy() - at
        found = np.column_stack([col["rid"].to_numpy()[row], col["item"].to_numpy()[row], shift[row], at[row] + k - REACH])
        found = found[np.lexsort(found.T)]
        found = found[np.concatenate([[True], (found[1:] != found[:-1]).any(1)])[:len(found)]]
        yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(4)], names=["rid", "item", "shift", "place"])


def _hits(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """The join on the seeds; one that ``HOT`` or more places share is dealt out over several tasks."""
    hot = (ours.groupBy("seed").count().where(F.col("count") >= HOT)
           .select("seed", F.expr(f"1 + count div {HOT}").alias("salts")))
    hot = materialise(hot.join(theirs.select("seed").distinct(), "seed", "left_semi"), "hot-seeds")
    salt = F.pmod(F.xxhash64("rid", "pos"), F.coalesce("salts", F.lit(1))).alias("salt")
    ours = ours.join(hot, "seed", "left").select("rid", "seed", "pos", "around", salt)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    theirs = theirs.join(hot, "seed", "left").select("item", "seed", "at", "size", F.col("around").alias("words"), each)
    return ours.join(theirs, ["seed", "salt"])


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, rid, item_id, covered) of each document row and item that overlap.

    ``covered`` counts the item's words in windows that agree, for the
    alignment with most of them; ``rid`` is ``keyed_hash(doc_id, text)``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    theirs = item_seeds(benchmark)
    n, sizes = theirs.agg(F.count("*"), F.sort_array(F.collect_set("size"))).first()      # WINDOW sizes at most
    ours = document_seeds(docs, sizes, seed_filter(theirs, n))
    places = (_hits(ours, theirs).select("rid", "item", "pos", "at", "size", "around", "words")
              .mapInArrow(_agreeing, "rid long, item long, shift long, place long").distinct())
    covered = (places.groupBy("rid", "item", "shift").agg(F.count("*").alias("covered"))
               .groupBy("rid", "item").agg(F.max("covered").alias("covered")))
    found = materialise(covered.join(theirs.select("item", "item_id").distinct(), "item").select("rid", "item_id", "covered"), "overlaps")
    rows = docs.select("doc_id", keyed_hash("doc_id", "text").alias("rid"))
    return rows.join(found, "rid").select("doc_id", "rid", "item_id", "covered")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no item, with all their columns."""
    own = free_prefix(docs, "_rid")
    leaks = benchmark_overlaps(docs, benchmark).select(F.col("rid").alias(own)).distinct()
    return (docs.withColumn(own, keyed_hash("doc_id", "text")).join(leaks, own, "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", "covered"))


#: Windows of 13 with two words wrong hold four successive words that agree;
#: every item of the given table has 13 words or more.
OP6_SQL = r"""
WITH d AS (SELECT doc_id, i, w[i] AS word, w FROM (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        generate_series(1, len(w)) AS g(i)),
b AS (SELECT item_id, j, w[j] AS word, w FROM (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
        generate_series(1, len(w)) AS g(j)),
shifts AS (SELECT DISTINCT d.doc_id, b.item_id, d.i - b.j AS s FROM d JOIN b
        ON d.word = b.word AND d.w[d.i + 1] = b.w[b.j + 1] AND d.w[d.i + 2] = b.w[b.j + 2] AND d.w[d.i + 3] = b.w[b.j + 3]),
aligned AS (SELECT s.doc_id, s.item_id, s.s, b.j, CAST(d.word = b.word AS INT) AS same
        FROM shifts s JOIN b ON b.item_id = s.item_id JOIN d ON d.doc_id = s.doc_id AND d.i = b.j + s.s),
ahead AS (SELECT *, sum(same) OVER w AS agree, count(*) OVER w AS n FROM aligned
        WINDOW w AS (PARTITION BY doc_id, item_id, s ORDER BY j ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
marked AS (SELECT *, max(CAST(n = 13 AND agree >= 11 AS INT)) OVER (
        PARTITION BY doc_id, item_id, s ORDER BY j ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS inside FROM ahead),
covered AS (SELECT doc_id, item_id, s, sum(inside) AS covered FROM marked GROUP BY doc_id, item_id, s)
SELECT doc_id, item_id, CAST(max(covered) AS BIGINT) AS covered FROM covered WHERE covered > 0 GROUP BY doc_id, item_id
"""
