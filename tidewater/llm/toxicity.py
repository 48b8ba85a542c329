"""Toxicity: FTRL-proximal logistic regression over hashed n-grams.

Features are the distinct hashed single words, stems (a word's first
``STEM`` bytes), pairs and skip-pairs (one word left out) of a text, words being
runs of letters, digits and non-ASCII bytes; a text's feature vector has unit
length.  Each coordinate has its own learning rate, and the L1 term keeps most
weights at zero, so what goes to the tasks is a short list.

The model is fitted on at most ``FIT_ROWS`` labelled rows of each label, those
of lowest id hash with ``FIT_FEATURES`` distinct features or fewer.  The labels
alternate in proportion, so that neither has the last word.

Defined results: null or empty text, or one without words, gets the model's
score for no features; without usable labels, or with those of
one value only, every score is 0 or that value; rows that
repeat are scored alike; an empty table gives an empty one; only id and text
(and the labels' id and toxic) are read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import bounded_batches, crc_mod, one_text_each, table
from tidewater.llm.textarrays import PUNCTUATION, chunks, hash_spans, mix, word_spans

FIT_ROWS, FIT_FEATURES = 4_000, 20_000
SLOT_BITS = 20
STEM = 4
ALPHA, BETA, L1, PASSES = 100.0, 1.0, 0.3, 6
_PAIR, _SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _chunk_slots(c) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of a chunk and the document of each; repeats included."""
    starts, ends, at = word_spans(c, PUNCTUATION)
    words = hash_spans(c.data, starts, ends, lower=True)
    doc = np.repeat(np.arange(c.n), np.diff(at))
    long = np.flatnonzero(ends - starts > STEM)
    stems = hash_spans(c.data, starts[long], starts[long] + STEM, lower=True)
    slots, docs = [mix(words), mix(~stems)], [doc, doc[long]]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        same = np.flatnonzero(doc[gap:] == doc[:-gap])
        slots.append(mix(words[same] * factor + words[same + gap]))
        docs.append(doc[same])
    return (np.concatenate(slots) >> np.uint64(64 - SLOT_BITS)).astype(np.int32), np.concatenate(docs)


class Weights(NamedTuple):
    slots: np.ndarray      # of the weights that are not zero
    values: np.ndarray
    bias: float


def _weight(z, n):
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) * ALPHA / (BETA + np.sqrt(n)))


def fit_ftrl(rows: list[np.ndarray], labels: np.ndarray) -> Weights:
    """Proximal steps over the rows in the given order, ``PASSES`` times."""
    z, n = np.zeros(1 << SLOT_BITS), np.zeros(1 << SLOT_BITS)
    bias_z = bias_n = 0.0
    for _ in range(PASSES):
        for x, y in zip(rows, labels):
            unit = 1 / np.sqrt(max(len(x), 1))
            zx, nx = z[x], n[x]
            w = _weight(zx, nx)
            bias = -bias_z / (BETA + np.sqrt(bias_n))
            error = 1 / (1 + np.exp(-np.clip(bias + unit * w.sum(), -35, 35))) - y
            g = error * unit
            z[x] = zx + g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA * w
            n[x] = nx + g * g
            bias_z += error - (np.sqrt(bias_n + error * error) - np.sqrt(bias_n)) * bias
            bias_n += error * error
    w = _weight(z, n)
    slots = np.flatnonzero(w)
    return Weights(slots, w[slots], float(-bias_z / (BETA + np.sqrt(bias_n))))


def alternate(labels: np.ndarray) -> np.ndarray:
    """Order in which each label's rows are spread evenly."""
    at = np.empty(len(labels))
    for y in np.unique(labels):
        own = np.flatnonzero(labels == y)
        at[own] = (np.arange(len(own)) + 0.5) / len(own)
    return np.argsort(at, kind="stable")


def _labelled_slots(batches):
    for batch in batches:
        out = [b""] * batch.num_rows
        for c in chunks(batch.column(2)):
            slots, doc = _chunk_slots(c)
            order = np.lexsort((slots, doc))
            slots, doc = slots[order], doc[order]
            one = np.concatenate([[True], (slots[1:] != slots[:-1]) | (doc[1:] != doc[:-1])])[:len(slots)]
            slots, doc = slots[one], doc[one]
            cut = np.searchsorted(doc, np.arange(c.n + 1))
            for d in range(c.n):
                out[c.first + d] = slots[cut[d]:cut[d + 1]].tobytes() if cut[d + 1] - cut[d] <= FIT_FEATURES else None
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["order", "label", "slots"])


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Weights:
    """Weights from labelled rows whose id hash leaves a remainder other than 0."""
    bounded_batches(docs.sparkSession)
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_label"))
             .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1)).where(crc_mod("_id", 5) != 0)
             .groupBy("_id").agg(F.max("_label").alias("_label")).withColumn("_order", F.xxhash64("_id")))
    pick = [known.where(F.col("_label") == y).orderBy("_order", "_id").limit(FIT_ROWS) for y in (0, 1)]
    rows = (one_text_each(docs, pick[0].unionByName(pick[1]))
            .select("_order", "_label", "text").mapInArrow(_labelled_slots, "order long, label int, slots binary")
            .where("slots is not null").collect())
    rows.sort(key=lambda r: (r.order, r.label, bytes(r.slots)))
    y = np.array([r.label for r in rows], np.float64)
    if len(set(y)) < 2:
        return Weights(np.zeros(0, np.int64), np.zeros(0), -np.inf if not y.any() else np.inf)
    order = alternate(y)
    return fit_ftrl([np.frombuffer(bytes(rows[i].slots), np.int32) for i in order], y[order])


def toxicity_scores(docs: DataFrame, weights: Weights) -> DataFrame:
    """(doc_id, score) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # at most 2 ** SLOT_BITS numbers

    def run(batches):
        table = np.zeros(1 << SLOT_BITS, np.float32)
        table[shared.value.slots] = shared.value.values
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for c in chunks(batch.column(1)):
                slots, doc = _chunk_slots(c)
                pairs = np.sort((doc << SLOT_BITS) | slots)
                pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])[:len(pairs)]]
                doc, slots = pairs >> SLOT_BITS, pairs & ((1 << SLOT_BITS) - 1)
                total[c.first:c.first + c.n] = (np.bincount(doc, table[slots], c.n)
                                                / np.sqrt(np.maximum(np.bincount(doc, minlength=c.n), 1)))
            total += shared.value.bias
            score = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity_scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
