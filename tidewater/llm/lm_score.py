"""LM scoring with a log-bilinear model trained by noise-contrastive estimation.

Word counts come from the whole training part of the corpus.  The ``CLASSES``
most frequent words are classes of their own, all others one class, which is
divided further: into subclasses, of which there are ``PER_ROOT`` times the root
of the number of different words, so they grow with the corpus and what a task
sends for them grows slower.  Half of the subclasses are the next most frequent
words, the other half take the rest by hash, each word with its add-one share
of its subclass; so probabilities add up to one over all words, seen or not.

A class's score after two words is the dot product of its vector with the sum
of theirs, plus a bias that starts at the class's own log frequency; words of a
subclass have the subclass's vector.  Groups of subclasses, and the subclasses
of a group, have vectors and biases likewise, so no sum is over more than the
root of their number.

Every task trains on its own documents in numpy, with noise from the class
frequencies; the parameters are averaged by numbers of tokens,
in ``ROUNDS`` rounds over separate parts of the documents.  The normaliser of
every pair of classes comes from batched matrix products, once, that of other
pairs when they are scored.

Counts of the words that make up most tokens (at most ``FREQUENT`` of them,
those with that share of all tokens) are broadcast; the others' are joined.

Defined results: null or empty text is one token, the end; a word that was not
in training counts 0; without training documents every class and count is
empty and each token scores by what is left of the formulas (0); rows that
repeat are scored alike; an empty table gives an empty one; only id and text
are read.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import SUM_SCHEMA, array_rows, bounded_batches, crc_mod, materialise, sum_arrays, table
from tidewater.llm.textarrays import Chunk, chunks, mix, word_hashes

FREQUENT, CLASSES, WIDTH = 2_000_000, 511, 16
BATCH, NOISE, RATE, ROUNDS = 2048, 48, 0.05, 2
PER_ROOT, MEMBER_NOISE = 4, 8
_END = np.uint64(0x27D4EB2F165667C5)
_FLUSH, _STEP, _CACHED, _SAFE, _PAIRS, _FACTORS, _KEPT = 1 << 21, 1 << 18, 1 << 17, 60, 1 << 20, 1 << 23, 31 << 20


def token_hashes(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Words of each document and its end, and where each document begins."""
    words, at = word_hashes(c)
    out = np.full(len(words) + c.n, _END, np.uint64)
    doc = np.repeat(np.arange(c.n), np.diff(at))
    out[np.arange(len(words)) + doc] = words
    return out, at + np.arange(c.n + 1)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _keep_freed() -> None:
    """Lets this process keep the memory of freed arrays for the next ones.

    The C library gives blocks back until one of some size was freed; the system
    would clear each of their pages anew, which takes longer than most sums here.
    """
    np.empty(_KEPT, np.uint8)


def _count_rows(batches):
    _keep_freed()
    keys, counts, size = [], [], 0

    def out():
        k, n = _summed(np.concatenate(keys), np.concatenate(counts))
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["word", "n"])

    for batch in batches:
        for c in chunks(batch.column(0)):
            tokens, _ = token_hashes(c)
            k, n = _summed(tokens, np.ones(len(tokens), np.int64))
            keys.append(k)
            counts.append(n)
            size += len(k)
            if size > _FLUSH:
                k, n = _summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts, size = [k], [n], len(k)
                if size > _FLUSH // 2:
                    yield out()
                    keys, counts, size = [], [], 0
    if keys:
        yield out()


class Words(NamedTuple):
    """Frequent words by hash: their counts and classes; and the totals."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    class_counts: np.ndarray    # the last one is of all other words
    total: int
    distinct: int
    subs: np.ndarray = np.zeros(0, np.int32)    # subclass that a word has for itself, or -1
    singles: int = 0                            # number of these; then come those by hash
    sub_counts: np.ndarray = np.zeros(0)
    sub_kinds: np.ndarray = np.zeros(0)         # different words of each subclass
    begin: np.ndarray = np.zeros(0, np.int32)   # first place of the hashes with each start, see ``indexed``

    @property
    def other(self) -> int:
        """The class of all other words; the next number stands for no word."""
        return len(self.class_counts) - 1

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token among the frequent words, and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
        last = len(self.hashes) - 1
        if not len(self.begin):
            at = np.minimum(np.searchsorted(self.hashes, tokens), last)
            return at, self.hashes[at] == tokens
        at = np.minimum(self.begin[tokens >> _shift(len(self.begin))], last).astype(np.int64)
        low = np.flatnonzero(self.hashes[at] < tokens)
        while len(low := low[at[low] < last]):
            at[low] += 1
            low = low[self.hashes[at[low]] < tokens[low]]
        return at, self.hashes[at] == tokens

    def indexed(self) -> Words:
        """With the place where the hashes with each start begin, of which there
        are more than words, so ``find`` takes few steps from there."""
        n = 1 << len(self.hashes).bit_length()
        starts = np.arange(n, dtype=np.uint64) << _shift(n)
        return self._replace(begin=np.searchsorted(self.hashes, starts).astype(np.int32)) if n > 1 else self

    def classes_of(self, tokens: np.ndarray) -> np.ndarray:
        at, known = self.find(tokens)
        return np.where(known, self.classes[at] if len(self.classes) else 0, self.other)

    def subclasses_of(self, tokens: np.ndarray, at: np.ndarray, known: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Subclass of each token of the class of other words, else -1."""
        if not len(self.sub_counts):
            return np.full(len(tokens), -1)
        by_hash = self.singles + _bucket(tokens, len(self.sub_counts) - self.singles)
        own = np.where(known, self.subs[at], -1) if len(self.subs) else np.full(len(tokens), -1)
        return np.where(classes != self.other, -1, np.where(own >= 0, own, by_hash))

    def places(self, tokens: np.ndarray, starts: np.ndarray, found: tuple[np.ndarray, np.ndarray] | None = None):
        """(class, context before, context two before, subclass) of each token.

        ``found`` is what ``find`` gave for the tokens."""
        at, known = found or self.find(tokens)
        classes = np.where(known, self.classes[at] if len(self.classes) else 0, self.other).astype(np.int64)
        subs = self.subclasses_of(tokens, at, known, classes)
        own = np.where(subs >= 0, self.other + 2 + subs, classes)
        return classes, *contexts(own, starts, self.other + 1), subs


def _shift(n: int) -> np.uint64:
    return np.uint64(65 - n.bit_length())


def _bucket(words: np.ndarray, n: int) -> np.ndarray:
    return ((words >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def count_words(docs: DataFrame) -> tuple[DataFrame, Words]:
    """(word, n) of all training tokens, stored, and the frequent ones."""
    counts = materialise(docs.select("text").mapInArrow(_count_rows, "word long, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # No more than FREQUENT words can each have this share of all tokens.
    rows = counts.where(F.col("n") * FREQUENT >= total).toPandas()
    hashes, n = rows["word"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    top = np.lexsort((hashes, -n))[:CLASSES]
    classes = np.full(len(n), len(top), np.int32)
    classes[top] = np.arange(len(top))
    half = max(1, int(PER_ROOT * distinct ** 0.5) // 2)
    ranked = np.lexsort((hashes, -n))
    single = ranked[CLASSES:CLASSES + half]
    subs = np.full(len(n), -1, np.int32)
    subs[single] = np.arange(len(single))
    sums, kinds = np.zeros(half), np.zeros(half)
    bucket = F.shiftrightunsigned("word", 40) % F.lit(half)
    for r in counts.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect():    # half rows at most
        sums[r.b], kinds[r.b] = r.n, r.k
    own = np.concatenate([top, single])
    np.subtract.at(sums, _bucket(hashes[own], half), n[own])
    np.subtract.at(kinds, _bucket(hashes[own], half), 1)
    return counts, Words(hashes, n, classes, np.append(n[top], total - n[top].sum()), int(total), int(distinct), subs, len(single),
                         np.append(n[single], sums), np.append(np.ones(len(single)), kinds))


class Model(NamedTuple):
    first: np.ndarray      # vectors of the class just before, one more for none
    second: np.ndarray     # of the one before that
    target: np.ndarray
    bias: np.ndarray
    group: np.ndarray      # of the groups of subclasses
    group_bias: np.ndarray
    member: np.ndarray     # of the subclasses, each group's one after another
    member_bias: np.ndarray

    @property
    def side(self) -> int:
        """Subclasses of each group but the last, which may have fewer."""
        return _side(len(self.member))


def _side(n: int) -> int:
    return int(np.ceil(np.sqrt(n)))


def _start(words: Words) -> Model:
    rng = np.random.default_rng(5)
    size = len(words.sub_counts)
    n, side = words.other + 2 + size, _side(size)
    share = (words.class_counts + 0.5) / (words.class_counts.sum() + 0.5 * len(words.class_counts))
    within = words.sub_counts + 0.5
    groups = np.add.reduceat(within, np.arange(0, size, side)) if size else within
    return Model(*(rng.normal(0, 0.1, (k, WIDTH)) for k in (n, n, words.other + 1)), np.log(share),
                 rng.normal(0, 0.1, (len(groups), WIDTH)), np.log(groups / groups.sum()) if size else groups,
                 rng.normal(0, 0.1, (size, WIDTH)), np.log(within / groups[np.arange(size) // side]) if size else within)


def _packed(model: Model) -> np.ndarray:
    return np.concatenate([x.ravel() for x in model])


def _unpacked(flat: np.ndarray, like: Model) -> Model:
    cuts = np.cumsum([x.size for x in like])[:-1]
    return Model(*(p.reshape(x.shape) for p, x in zip(np.split(flat, cuts), like)))


def contexts(classes: np.ndarray, starts: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; ``none`` at starts."""
    one = np.concatenate([[none], classes[:-1]])
    two = np.concatenate([[none, none], classes[:-2]])[:len(classes)]
    begin = starts[:-1]
    one[begin] = two[begin] = none
    second = begin + 1
    two[second[second < len(classes)]] = none
    two[begin] = none
    return one, two


def _sigmoid_of_minus(x: np.ndarray) -> None:
    """1 / (1 + exp(x)), in place."""
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


def train(model: Model, parts, share: np.ndarray, seed: int) -> tuple[Model, int]:
    """One pass over (class, before, two before[, subclass]) arrays; tokens seen."""
    rng = np.random.default_rng(seed)
    side, model = model.side, Model(*(x.astype(np.float32) for x in model))
    first, second, target, bias, group, group_bias, member, member_bias = model
    squares = [np.full(x.shape, 1e-3, np.float32) for x in model]
    # Subclasses are in few rows of a batch: their steps begin at full length.
    for x in (squares[0][len(target) + 1:], squares[1][len(target) + 1:], *squares[4:]):
        x[:] = 1 / BATCH ** 2
    edges, log_noise, seen = np.cumsum(share), np.log(NOISE * share).astype(np.float32), 0

    def step(x, square, grad):
        square += grad * grad
        x -= RATE * grad / np.sqrt(square)

    def step_rows(x, square, at, grad, scale):
        """A step of the rows that have a gradient; those of one row are added up."""
        seen = np.bincount(at, minlength=len(x)) > 0
        own = np.flatnonzero(seen)
        row = (np.cumsum(seen) - 1)[at]
        flat = (row[:, None] * WIDTH + np.arange(WIDTH)).ravel()
        g = np.bincount(flat, grad.ravel(), len(own) * WIDTH).reshape(-1, WIDTH).astype(np.float32) * scale
        s = square[own] + g * g
        square[own] = s
        x[own] -= RATE * g / np.sqrt(s)

    def divided(sub, q, n):
        """A step of the groups and subclasses; the gradient of the contexts."""
        of = sub // side
        p = q @ group.T
        p += group_bias
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(sub)), of] -= 1
        dq = p @ group
        step(group, squares[4], p.T @ q / n)
        step(group_bias, squares[5], p.sum(0) / n)
        # A group's words stand together, as a matrix, and share its noise.
        order = np.argsort(of, kind="stable")
        own, row = np.unique(of[order], return_inverse=True)
        col = np.arange(len(of)) - np.searchsorted(row, np.arange(len(own)))[row]
        fits = np.minimum(side, len(member) - own * side)
        drawn = (own * side)[:, None] + (rng.random((len(own), MEMBER_NOISE), np.float32) * fits[:, None]).astype(np.int64)
        log_drawn = np.log(MEMBER_NOISE / fits).astype(np.float32)
        together = np.zeros((len(own), col.max() + 1, WIDTH), np.float32)
        together[row, col] = q[order]
        v = member[drawn]
        e = together @ -v.transpose(0, 2, 1)
        e += (log_drawn[:, None] - member_bias[drawn])[:, None, :]
        _sigmoid_of_minus(e)
        e *= (np.arange(e.shape[1]) < np.bincount(row)[:, None])[:, :, None]
        dq[order] += (e @ v)[row, col]
        hit, log_own = member[sub], np.empty(len(sub), np.float32)
        log_own[order] = log_drawn[row]
        true = 1 / (1 + np.exp(log_own - np.einsum("nd,nd->n", q, hit) - member_bias[sub])) - 1
        hit *= true[:, None]
        dq += hit
        pick = np.concatenate([sub, drawn.ravel()])
        step_rows(member, squares[6], pick, np.concatenate([true[:, None] * q, (e.transpose(0, 2, 1) @ together).reshape(-1, WIDTH)]), np.float32(1 / n))
        step(member_bias, squares[7], (np.bincount(pick, np.concatenate([true, e.sum(1).ravel()]), len(member)) / n).astype(np.float32))
        return dq

    for word, one, two, *subs in parts:
        order = rng.permutation(len(word))
        seen += len(word)
        for i in range(0, len(word), BATCH):
            at = order[i:i + BATCH]
            w, a, b = word[at], one[at], two[at]
            noise = np.minimum(np.searchsorted(edges, rng.random(NOISE)), len(share) - 1)
            q = first[a] + second[b]
            hit = target[w]
            true = 1 / (1 + np.exp(log_noise[w] - np.einsum("nd,nd->n", q, hit) - bias[w])) - 1
            against = target[noise]
            false = q @ -against.T
            false += log_noise[noise] - bias[noise]
            _sigmoid_of_minus(false)
            dq = false @ against
            hit *= true[:, None]
            dq += hit
            db = np.bincount(w, true, len(bias)) + np.bincount(noise, false.sum(0), len(bias))
            dt = np.concatenate([true[:, None] * q, false.T @ q])
            if subs and len(other := np.flatnonzero(subs[0][at] >= 0)):
                dq[other] += divided(subs[0][at[other]], q[other], len(at))
            scale = np.float32(1 / len(at))
            step_rows(first, squares[0], a, dq, scale)
            step_rows(second, squares[1], b, dq, scale)
            step_rows(target, squares[2], np.concatenate([w, noise]), dt, scale)
            step(bias, squares[3], (db * scale).astype(np.float32))
    return model, seen


def fit_model(docs: DataFrame, words: Words, words_shared) -> Model:
    """Parameters averaged over the tasks' own training, round by round."""
    model = _start(words)
    share = np.exp(model.bias)
    for r in range(ROUNDS):
        like = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches, like=like, r=r):
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            _keep_freed()
            own = words_shared.value.indexed()

            def parts():
                for batch in batches:
                    for c in chunks(batch.column(0)):
                        tokens, starts = token_hashes(c)
                        yield own.places(tokens, starts)

            fitted, seen = train(like.value, parts(), share, 1000 * r + part)
            if seen:
                yield array_rows(np.append(_packed(fitted) * seen, seen), part)

        part = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == r
        rows = docs.where(part | (F.col("doc_id").isNull() & F.lit(r == 0))).select("text").mapInArrow(run, SUM_SCHEMA)
        total = sum_arrays(rows, len(_packed(model)) + 1)
        if total[-1] > 0:
            model = _unpacked(total[:-1] / total[-1], model)
    return model


def _log_sums(q: np.ndarray, vectors: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of ``q @ vectors.T + bias``, row by row.

    Some rows at a time, in one buffer that stays in the processor's cache.
    """
    out = np.empty(len(q), q.dtype)
    rows = max(64, _CACHED // max(1, len(vectors)))
    across = np.concatenate([vectors.T, bias[None].astype(q.dtype)])
    wide = np.ones((min(rows, len(q)), q.shape[1] + 1), q.dtype)
    buffer = np.empty((min(rows, len(q)), len(vectors)), q.dtype)
    # No product exceeds this; where it is small, exponentials need no common factor taken out.
    reach = np.sqrt((q * q).sum(1).max(initial=0) * (vectors * vectors).sum(1).max(initial=0)) + np.abs(bias.max(initial=-np.inf) if len(bias) else 0)
    ones = np.ones(len(vectors), q.dtype)
    for i in range(0, len(q), rows):
        part = q[i:i + rows]
        s = buffer[:len(part)]
        wide[:len(part), :-1] = part
        np.matmul(wide[:len(part)], across, out=s)
        if reach < _SAFE:
            np.exp(s, out=s)
            out[i:i + rows] = np.log(s @ ones)
        else:
            top = s.max(1)
            s -= top[:, None]
            np.exp(s, out=s)
            out[i:i + rows] = top + np.log(s @ ones)
    return out


def normalisers(model: Model) -> np.ndarray:
    """Log of the sum over all classes, for each class before and two before."""
    n = len(model.target) + 1
    out = np.empty((n, n), np.float32)
    for a in range(n):
        out[a] = _log_sums(model.first[a] + model.second[:n], model.target, model.bias)
    return out


class PairSums:
    """Log sums of pairs of contexts that were worked out lately.

    Each pair has one place, by hash, which the last one there holds; so the size
    is fixed, and a pair that was put out is worked out again.
    """

    def __init__(self, model: Model, vectors: np.ndarray, bias: np.ndarray):
        self.vectors, self.bias = vectors, bias
        self.count = len(model.first)
        self.first, self.second = _factors(model, vectors, bias)
        self.pairs, self.sums = np.full(_PAIRS, -1, np.int64), np.zeros(_PAIRS, vectors.dtype)

    def of(self, pair: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The log sum of each pair, whose summed vectors are ``q``."""
        place = (mix(pair.view(np.uint64)) % np.uint64(_PAIRS)).astype(np.int64)
        out = self.sums[place]
        new = np.flatnonzero(self.pairs[place] != pair)
        # Each pair once.
        _, first, same = np.unique(pair[new], return_index=True, return_inverse=True)
        once = new[first]
        sums = self._worked_out(pair[once], q, once)
        out[new] = sums[same]
        self.pairs[place[once]] = pair[once]
        stays = self.pairs[place[once]] == pair[once]      # of two at one place, one
        self.sums[place[once[stays]]] = sums[stays]
        return out


    def _worked_out(self, pair: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(pair), self.sums.dtype)
        one, two = np.divmod(pair, self.count)
        known = (one < len(self.first)) & (two < len(self.first))
        other, own = np.flatnonzero(~known), np.flatnonzero(known)
        if len(other):
            out[other] = _log_sums(q[at[other]], self.vectors, self.bias)
        if len(own):
            one, two = one[own], two[own]
            rows = max(64, _CACHED // 2 // max(1, self.first.shape[1]))
            a, b = np.empty((2, min(rows, len(own)), self.first.shape[1]), self.first.dtype)
            z = np.empty(len(own), self.first.dtype)
            for i in range(0, len(own), rows):
                n = len(z[i:i + rows])
                np.take(self.first, one[i:i + rows], 0, a[:n], "clip")
                np.take(self.second, two[i:i + rows], 0, b[:n], "clip")
                np.einsum("ij,ij->i", a[:n], b[:n], out=z[i:i + rows])
            out[own] = np.log(z)
        return out


def _pair_sums(model: Model) -> tuple[PairSums, PairSums]:
    return PairSums(model, model.target, model.bias), PairSums(model, model.group, model.group_bias)


def _factors(model: Model, vectors: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the contexts that come first, exponentials of their products with the
    vectors, before (with the bias) and two before: a pair's sum is the product
    of two rows.  None if a product of two could leave single precision."""
    n = min(len(model.first), _FACTORS // max(1, len(vectors)))
    out = [model.first[:n] @ vectors.T, model.second[:n] @ vectors.T]
    out[0] += bias
    if not out[0].size or sum(np.abs(x).max() for x in out) >= _SAFE:
        return np.empty((0, len(vectors)), vectors.dtype), np.empty((0, len(vectors)), vectors.dtype)
    for x in out:
        np.exp(x, out=x)
    return out[0], out[1]


def class_logs(model: Model, log_sum: np.ndarray, word, one, two, sub, held: tuple[PairSums, PairSums] | None = None) -> np.ndarray:
    """Log probability of each token's class and, if it has one, subclass.

    ``held`` keeps log sums of classes and of groups from one call to the next.
    """
    of_classes, of_groups = held or _pair_sums(model)
    out = np.empty(len(word))
    n, side = len(log_sum), model.side
    for i in range(0, len(word), _STEP):
        s = slice(i, i + _STEP)
        a, b, w, d = one[s], two[s], word[s], sub[s]
        q = model.first[a] + model.second[b]
        plain = (a < n) & (b < n)
        z = log_sum[np.where(plain, a, 0), np.where(plain, b, 0)].astype(np.float64)
        pair = a.astype(np.int64) * len(model.first) + b
        other = np.flatnonzero(~plain)
        z[other] = of_classes.of(pair[other], q[other])
        logs = np.einsum("ij,ij->i", q, model.target[w]) + model.bias[w] - z
        other = np.flatnonzero(d >= 0)
        if len(other):
            of = d[other] // side
            own_q = q[other]
            logs[other] += (np.einsum("ij,ij->i", own_q, model.group[of]) + model.group_bias[of]
                            + np.einsum("ij,ij->i", own_q, model.member[d[other]]) + model.member_bias[d[other]]
                            - of_groups.of(pair[other], own_q))
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[order])) + 1
            for own in np.split(other[order], cuts):
                low = d[own[0]] // side * side
                logs[own] -= _log_sums(q[own], model.member[low:low + side], model.member_bias[low:low + side])
        out[s] = logs
    return out


SCORE_SCHEMA = ("row long, word long, n long, n_known long, logs double, other_logs double, class_logs double")


def _score_rows(batches, words: Words, model: Model, log_sum: np.ndarray):
    """A row for each document, and one for each of its words that isn't frequent."""
    _keep_freed()
    model = Model(*(x.astype(np.float32) for x in model))
    held = _pair_sums(model)
    rest = np.log10(words.sub_counts + words.sub_kinds + 1.0)
    weight = np.log10(words.counts + 1.0)
    names = [f.split()[0] for f in SCORE_SCHEMA.split(", ")]
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for c in chunks(batch.column(1)):
            tokens, starts = token_hashes(c)
            place, known = words.find(tokens)
            classes, one, two, subs = words.places(tokens, starts, (place, known))
            logs = class_logs(model, log_sum, classes, one, two, subs, held)
            own = np.where(known, weight[place] if len(weight) else 0.0, 0.0)
            shared = np.where(subs >= words.singles, own - rest[np.maximum(subs, 0)], 0.0)
            cut = starts[:-1]
            sums = [np.add.reduceat(x, cut) for x in (known.astype(np.int64), own, shared, logs)]
            rows = ids[c.first:c.first + c.n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.nulls(c.n, pa.int64()), pa.array(np.diff(starts)), *map(pa.array, sums)], names=names)
            rare = np.flatnonzero(~known)
            if len(rare):
                doc = np.searchsorted(starts, rare, "right") - 1
                order = np.lexsort((tokens[rare], doc))
                doc, word = doc[order], tokens[rare][order]
                new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])]))
                k = len(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[doc[new]]), pa.array(word[new].view(np.int64)), pa.array(np.diff(np.append(new, len(doc)))),
                     pa.nulls(k, pa.int64()), *(pa.nulls(k, pa.float64()),) * 3], names=names)


def lm_scores(docs: DataFrame, training: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text) with their scores.

    Adds n_tokens, n_known, train_tokens, base_score (add-one counts of single
    words) and score, both log10 probabilities.  Other columns of ``docs`` are
    not kept.
    """
    bounded_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    counts, words = count_words(training)
    shared = context.broadcast(words)       # at most FREQUENT rows
    model = fit_model(training.select("doc_id", "text"), words, shared)
    fitted = context.broadcast((model, normalisers(model)))

    def run(batches):
        return _score_rows(batches, shared.value.indexed(), *fitted.value)

    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    # Ids and numbers go the same way as the scores, in one write.
    scored = _with_ids(numbered, run)
    scored = materialise(scored, "scores")
    rare = (scored.where("word is not null").select("row", "word", F.col("n").alias("times")).join(counts, "word", "left")
            .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("rare_logs"),
                                F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("rare_known")))
    zero = F.lit(0.0)
    plain = float(np.log10(words.total + words.distinct + 1))
    logs = F.coalesce("rare_logs", zero)
    return (scored.where("word is null").join(rare, "row", "left")
            .select("doc_id", F.col("n").alias("n_tokens"), (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    F.lit(words.total).cast("long").alias("train_tokens"),
                    (F.col("logs") + logs - F.col("n") * plain).alias("base_score"),
                    (F.col("class_logs") / float(np.log(10)) + F.col("other_logs") + logs).alias("score")))


def _with_ids(numbered: DataFrame, run) -> DataFrame:
    """Scores of (doc_id, text, row), with the id in each document's row."""

    def batches_with_ids(batches):
        for batch in batches:
            ids, row = batch.column(0), batch.column(2).to_numpy()
            for out in run(iter([pa.RecordBatch.from_arrays([batch.column(2), batch.column(1)], names=["row", "text"])])):
                at = np.searchsorted(row, out.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *out.columns], names=["doc_id", *out.schema.names])

    kind = numbered.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(batches_with_ids, f"doc_id {kind}, {SCORE_SCHEMA}")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod("doc_id", 7) == 2
    scores = lm_scores(docs, docs.where(~held_out))
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
