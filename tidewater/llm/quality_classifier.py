"""Quality classifier: random-indexing word vectors and a small network.

Tokens are words and single ASCII marks, hashed to ``TOKENS`` rows.  Each row
has a fixed sparse index vector of a few +1 and -1; a token's vector is the sum
of the index vectors of its neighbours over the whole corpus.  Tasks add up
their own documents; the sums have a fixed size.  A document is the mean of its
tokens' vectors, with its length and share of distinct tokens; a network of
two layers gives the probability, whose temperature is set on labelled rows
that the network has not seen.

The network is fitted on at most ``FIT_ROWS`` labelled rows, those of lowest
id hash.

Defined results: null or empty text is the zero vector; without usable labels
every score is the share of good labels, or 0.5; rows that repeat are scored
alike; an empty table gives an empty one; only id and text (and the labels' id
and quality) are read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import SUM_SCHEMA, array_rows, bounded_batches, crc_mod, one_text_each, sum_arrays, table
from tidewater.llm.textarrays import PUNCTUATION, SPACE, Chunk, chunks, hash_spans, mix

TOKEN_BITS, WIDTH, NONZERO, REACH = 13, 32, 2, 2
TOKENS = 1 << TOKEN_BITS
FIT_ROWS, HIDDEN, PASSES, BATCH = 20_000, 16, 30, 256


def _tokens(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Row of each word or mark, and the number of them before each document."""
    if not len(c.data):
        return np.zeros(0, np.int64), np.zeros(len(c.offsets), np.int64)
    mark = PUNCTUATION[c.data] & ~SPACE[c.data]
    word = ~PUNCTUATION[c.data]
    edge = np.zeros(len(c.data) + 1, bool)
    edge[c.offsets] = True
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    starts = np.flatnonzero(mark | (word & (~before | edge[:-1])))
    ends = np.flatnonzero(mark | (word & (~after | edge[1:]))) + 1
    rows = (hash_spans(c.data, starts, ends, lower=True) >> np.uint64(64 - TOKEN_BITS)).astype(np.int64)
    return rows, np.searchsorted(starts, c.offsets)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Columns and signs of the ``NONZERO`` entries of each row's index vector."""
    h = mix(np.arange(TOKENS * NONZERO, dtype=np.uint64) + np.uint64(1)).reshape(TOKENS, NONZERO)
    return (h % np.uint64(WIDTH)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """One unit vector for each token row, from the neighbours in all texts."""

    def count(batches):
        from pyspark import TaskContext

        columns, signs = index_vectors()
        total = np.zeros(TOKENS * WIDTH)
        for batch in batches:
            for c in chunks(batch.column(0)):
                rows, at = _tokens(c)
                doc = np.repeat(np.arange(c.n), np.diff(at))
                for gap in range(1, REACH + 1):
                    same = np.flatnonzero(doc[gap:] == doc[:-gap])
                    left, right = rows[same], rows[same + gap]
                    for own, other in ((left, right), (right, left)):
                        for k in range(NONZERO):
                            np.add.at(total, own * WIDTH + columns[other, k], signs[other, k])
        yield array_rows(total, TaskContext.get().partitionId())

    total = sum_arrays(docs.select("text").mapInArrow(count, SUM_SCHEMA), TOKENS * WIDTH).reshape(TOKENS, WIDTH)
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.where(norm > 0, norm, 1)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean vector, its length, log count and share of distinct tokens of each text."""
    out = np.zeros((len(column), WIDTH + 3), np.float32)
    for c in chunks(column):
        rows, at = _tokens(c)
        size = np.diff(at)
        full = np.flatnonzero(size)
        part = out[c.first:c.first + c.n]
        if not len(full):
            continue
        mean = np.add.reduceat(vectors[rows], at[:-1][full], axis=0) / size[full, None]
        pairs = np.sort((np.repeat(np.arange(c.n), size) << TOKEN_BITS) | rows)
        first = np.concatenate([[True], pairs[1:] != pairs[:-1]])
        kinds = np.bincount(pairs[first] >> TOKEN_BITS, minlength=c.n)[full]
        part[full, :WIDTH] = mean
        part[full, WIDTH] = np.linalg.norm(mean, axis=1)
        part[full, WIDTH + 1] = np.log1p(size[full])
        part[full, WIDTH + 2] = kinds / size[full]
    return out


class Network(NamedTuple):
    shift: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]    # weights and biases of the two layers
    temperature: float


def logits(net: Network, x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = net.layers
    return np.maximum((x - net.shift) / net.scale @ w1 + b1, 0) @ w2 + b2


def fit_network(x: np.ndarray, y: np.ndarray, check: np.ndarray, seed: int = 11) -> Network:
    """Adam on the log loss of rows not in ``check``; temperature on those that are."""
    rng = np.random.default_rng(seed)
    train = ~check if (~check).any() and len(set(y[~check])) == 2 else np.ones(len(y), bool)
    shift, scale = x[train].mean(0), x[train].std(0) + 1e-6
    layers = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    one, two = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    z, t, step = (x[train] - shift) / scale, y[train].astype(np.float64), 0
    for _ in range(max(PASSES, 2000 * BATCH // max(len(t), 1) + 1) if len(t) < 2000 * BATCH // PASSES else PASSES):
        order = rng.permutation(len(t))
        for i in range(0, len(t), BATCH):
            at = order[i:i + BATCH]
            hidden = np.maximum(z[at] @ layers[0] + layers[1], 0)
            g = (1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -35, 35))) - t[at]) / len(at)
            back = np.outer(g, layers[2]) * (hidden > 0)
            grads = [z[at].T @ back + 1e-4 * layers[0], back.sum(0), hidden.T @ g + 1e-4 * layers[2], np.array([g.sum()])]
            step += 1
            for k, d in enumerate(grads):
                one[k] = 0.9 * one[k] + 0.1 * d
                two[k] = 0.999 * two[k] + 0.001 * d * d
                layers[k] = layers[k] - 0.01 * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(shift, scale, tuple(layers), 1.0)
    if not check.any() or train.all():
        return net
    raw, t = logits(net, x[check]), y[check]
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.logaddexp(0, np.where(t == 1, -raw, raw) / c).mean() for c in choices]
    return net._replace(temperature=float(choices[int(np.argmin(loss))]))


def fit_quality(docs: DataFrame, labels: DataFrame, vectors) -> Network | float:
    """The network, or a fixed score where the labels have one value at most.

    Learns from ids whose hash leaves a remainder other than 0; remainder 1
    sets the temperature.
    """
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
             .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1)).where(crc_mod("_id", 5) != 0)
             .groupBy("_id").agg(F.min("_label").alias("_label"))
             .orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS))

    def run(batches):
        for batch in batches:
            x = pooled(batch.column(2), vectors.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["label", "checked", "x"])

    rows = (one_text_each(docs, known)
            .select("_label", (crc_mod("_id", 5) == 1).alias("_checked"), "text")
            .mapInArrow(run, "label int, checked boolean, x binary").collect())
    rows.sort(key=lambda r: (bytes(r.x), r.label))
    y = np.array([r.label for r in rows])
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    x = np.array([np.frombuffer(bytes(r.x), np.float32) for r in rows], np.float64)
    return fit_network(x, y, np.array([r.checked for r in rows]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of each row."""
    bounded_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs))     # TOKENS * WIDTH numbers
    model = context.broadcast(fit_quality(docs, labels, vectors))

    def run(batches):
        for batch in batches:
            net = model.value
            if isinstance(net, float):
                score = np.full(batch.num_rows, net)
            else:
                raw = logits(net, pooled(batch.column(1), vectors.value).astype(np.float64))
                score = 1 / (1 + np.exp(-np.clip(raw / net.temperature, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
