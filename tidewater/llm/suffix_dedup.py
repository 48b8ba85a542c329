"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(by document id, then offset) goes.  Equal strings meet in one shard: a window
of ``LENGTH`` bytes is dealt out by the smallest hash of its ``GRAM``-byte
strings, so equal windows have equal keys, and neighbouring windows mostly
share one, which lets them travel as one context.  Only keys found twice or
more in the corpus are dealt out at all; any other window is unique.

A shard's contexts are worked off in blocks of bounded size: a generalised
suffix array by Larsson-Sadakane refinement (each round sorts only suffixes
not yet told apart, by the rank of what follows), Kasai's common prefixes,
and in each run of neighbours with ``LENGTH`` bytes in common all but the first
occurrence are repeats.  Blocks end between keys, so no two blocks share a
window.  A key with more than ``HOT`` occurrences would make a shard too large;
its windows travel singly and are dealt out by their own hash as well.

Equal contexts are combined before the shuffle: in a task only the first goes
on, the others are known to be repeats.

Defined results: null is the empty text; texts shorter than ``LENGTH`` bytes
keep all; rows equal in id and text get equal results and don't remove each
other; rows of equal id and different text are ordered by offset; a null id
comes last; an empty table gives an empty one; only id and text are read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import bounded_batches, discard, free_prefix, keyed_hash, materialise, table
from tidewater.llm.textarrays import Chunk, _BYTE, buffers, chunks, mix, powers

LENGTH, GRAM = 100, 32
_WIDTH = LENGTH - GRAM + 1
#: Windows in a context, bytes of contexts in a block, occurrences of a key
#: beyond which its windows are dealt out singly.
RUN_WINDOWS, BLOCK_BYTES, HOT = 256, 1 << 19, 4_000
_COMBINE_BYTES = 16 << 20
_LAST = (1 << 63) - 1


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of each ``GRAM``-byte string."""
    n = len(data)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    return mix((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])


def _window_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each gram, and the key of the window that starts at each byte."""
    grams = _grams(data)
    return grams, _sliding(grams, _WIDTH, np.minimum)


def _pieces(c: Chunk):
    """Documents long enough for a window: (row, bytes).

    A long document comes in pieces that overlap by one byte less than a window.
    """
    step = 1 << 20
    for d in np.flatnonzero(np.diff(c.offsets) >= LENGTH):
        whole = c.data[c.offsets[d]:c.offsets[d + 1]]
        for at in range(0, len(whole) - LENGTH + 1, step):
            yield c.first + int(d), at, whole[at:at + step + LENGTH - 1]


def _document_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct window keys, and how often each one's gram was the smallest."""
    grams, keys = _window_keys(data)
    pad = np.zeros(_WIDTH - 1, np.uint64)
    reach = _sliding(np.concatenate([pad, keys, pad]), _WIDTH, np.maximum)
    chosen = np.sort(grams[grams == reach])
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    return chosen[first], np.diff(np.append(first, len(chosen)))


def _key_rows(batches):
    for batch in batches:
        rows, keys, counts = [], [], []
        for c in chunks(batch.column(1)):
            for row, _, data in _pieces(c):
                k, n = _document_keys(data)
                rows.append(np.full(len(k), row))
                keys.append(k)
                counts.append(n)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(keys).view(np.int64)),
                 pa.array(np.concatenate(counts).astype(np.int32))], names=["rid", "key", "n"])


CONTEXT_SCHEMA = "rid long, doc long, start long, stop long, key long, salt int, context binary"


class _Combiner:
    """First occurrence of each context; the others are repeats at once."""

    def __init__(self):
        self.first: dict[tuple, tuple] = {}
        self.bytes = 0
        self.out: list[tuple] = []

    def add(self, rid: int, doc: int, start: int, key: int, salt: int, context: bytes) -> None:
        at, now = (key, context), (doc, start, rid, salt)
        have = self.first.get(at)
        if have is None:
            self.bytes += len(context) + 400
            self.first[at] = now
        elif have[:2] != now[:2]:
            early, late = (have, now) if have[:2] < now[:2] else (now, have)
            self.first[at] = early
            self.repeat(late, len(context))
        elif have[2] != rid:        # the same place of rows of equal id
            self.out.append((rid, doc, start, start + len(context), key, salt, context))

    def repeat(self, at: tuple, length: int) -> None:
        self.out.append((at[2], at[0], at[1], at[1] + length, None, at[2] & 0xFF, None))

    def full(self) -> bool:
        return self.bytes > _COMBINE_BYTES or len(self.out) > 50_000

    def flush(self):
        # What is repeated of a document, in as few ranges as possible.
        repeats: list[list] = []
        for rid, doc, start, stop, key, salt, context in sorted((r for r in self.out if r[6] is None), key=lambda r: r[:4]):
            if repeats and repeats[-1][:2] == [rid, doc] and start <= repeats[-1][3]:
                repeats[-1][3] = max(repeats[-1][3], stop)
            else:
                repeats.append([rid, doc, start, stop, key, salt, context])
        rows = repeats + [r for r in self.out if r[6] is not None] + [(rid, doc, start, start + len(context), key, salt, context)
                           for (key, context), (doc, start, rid, salt) in self.first.items()]
        self.first, self.bytes, self.out = {}, 0, []
        for i in range(0, len(rows), 20_000):
            cols = list(zip(*rows[i:i + 20_000]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[f.split()[0] for f in CONTEXT_SCHEMA.split(", ")])


def _context_rows(batches):
    """Contexts of the windows whose key is among the document's shared ones.

    Rows without a context are repeats already.
    """
    combine = _Combiner()
    for batch in batches:
        rid, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        flat_keys, key_at = _list_buffers(batch.column(3))
        flat_salts, _ = _list_buffers(batch.column(4))
        for c in chunks(batch.column(2)):
            for row, at, data in _pieces(c):
                shared = flat_keys[key_at[row]:key_at[row + 1]].view(np.uint64)
                order = np.argsort(shared)
                shared, salts = shared[order], flat_salts[key_at[row]:key_at[row + 1]][order]
                _, keys = _window_keys(data)
                edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                ends = np.append(edges[1:], len(keys))
                found = np.minimum(np.searchsorted(shared, keys[edges]), len(shared) - 1)
                raw = data.tobytes()
                for k in np.flatnonzero(shared[found] == keys[edges]):
                    key, fan = int(shared[found[k]].view(np.int64)), int(salts[found[k]])
                    low, high = int(edges[k]), int(ends[k])
                    if fan > 1:
                        for p in range(low, high):
                            window = raw[p:p + LENGTH]
                            combine.add(int(rid[row]), int(doc[row]), at + p, key, zlib.crc32(window) % fan, window)
                    else:
                        for p in range(low, high, RUN_WINDOWS):
                            stop = min(p + RUN_WINDOWS, high) + LENGTH - 1
                            combine.add(int(rid[row]), int(doc[row]), at + p, key, 0, raw[p:stop])
                if combine.full():
                    yield from combine.flush()
    yield from combine.flush()


def _list_buffers(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False), offsets


def suffix_array(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes of the texts in ``data``, and the words they start with.

    A suffix ends with its text; equal suffixes are in the order of the texts.
    Larsson-Sadakane: the rank of a suffix is the place where its group
    begins; groups of several are sorted by the rank ``h`` bytes on.
    """
    n = len(data)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | wide[k:k + n]
    near = np.flatnonzero(left < 8)     # words that reach into the next text
    word[near] &= ~np.uint64(0) << (np.uint64(64) - np.uint64(8) * left[near].astype(np.uint64))
    # Seven bytes, and their number: a zero byte and the end of a text differ.
    h = 7
    key = (word & ~np.uint64(255)) | np.minimum(left, h).astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        at = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(at):
            break
        pos = order[at]
        # What ends here comes first, equal ones in the order of the texts.
        follow = np.where(left[pos] <= h, pos - n, rank[np.minimum(pos + h, n - 1)])
        key = rank[pos] * (2 * n + 1) + (follow + n)
        sub = np.argsort(key)
        pos, key = pos[sub], key[sub]
        order[at] = pos
        new[at] = fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[pos] = np.maximum.accumulate(np.where(fresh, at, 0))
        h *= 2
    return order, word


def common_prefixes(order: np.ndarray, word: np.ndarray, offsets: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Bytes, up to ``most``, that each suffix shares with the one before it.

    Kasai: from one suffix of a text to the next the common prefix loses one
    byte at most.  All texts advance in step, eight bytes at a time.
    Suffixes shorter than ``most`` are left at 0.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    ends = np.repeat(offsets[1:], np.diff(offsets))
    lcp = np.zeros(n, np.int16)
    steps = np.diff(offsets) - most + 1
    texts = np.argsort(-steps, kind="stable")
    starts, steps = offsets[:-1][texts], steps[texts]
    have = np.zeros(len(texts), np.int64)
    for t in range(int(steps[0]) if len(steps) else 0):
        live = int(np.searchsorted(-steps, -t, "left"))     # texts with a suffix that long
        p = starts[:live] + t
        q = before[p]
        limit = np.where(q < 0, 0, np.minimum(ends[q] - q, most))
        h = np.minimum(np.maximum(have[:live] - 1, 0), limit)
        go = np.flatnonzero(h < limit)
        while len(go):
            x = word[p[go] + h[go]] ^ word[q[go] + h[go]]
            gain = np.full(len(go), 8)
            other = np.flatnonzero(x)
            if len(other):
                part = x[other]
                equal = np.full(len(other), 7)
                for k in range(6, -1, -1):      # equal leading bytes
                    equal[part >> np.uint64(56 - 8 * k) != 0] = k
                gain[other] = equal
            h[go] = np.minimum(h[go] + gain, limit[go])
            go = go[(x == 0) & (h[go] < limit[go])]
        lcp[p] = have[:live] = h
    return lcp[order]


def repeated_windows(contexts: list[bytes], doc: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """For each context, the offsets of windows that occur earlier in the block, ascending."""
    sizes = np.array([len(x) for x in contexts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    order, word = suffix_array(data, offsets)
    lcp = common_prefixes(order, word, offsets)
    same = lcp >= LENGTH
    if not same.any():
        return [np.zeros(0, np.int64)] * len(contexts)
    inside = np.flatnonzero(same | np.append(same[1:], False))
    pos = order[inside]
    group = np.cumsum(~same[inside])
    text = np.searchsorted(offsets, pos, "right") - 1
    offset = pos - offsets[text]
    # Ids as ranks, so that (id, place) is one number.
    ids = np.unique(doc[text], return_inverse=True)[1]
    place = start[text] + offset
    by = np.lexsort((place, ids, group))
    g, d, s = group[by], ids[by], place[by]
    head = np.concatenate([[True], g[1:] != g[:-1]])
    lead = np.maximum.accumulate(np.where(head, np.arange(len(g)), 0))
    late = (d != d[lead]) | (s != s[lead])
    texts, offs = text[by][late], offset[by][late]
    order = np.lexsort((offs, texts))
    texts, offs = texts[order], offs[order]
    return np.split(offs, np.searchsorted(texts, np.arange(1, len(contexts))))


def spans_of(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges covered by windows at these ascending offsets."""
    if not len(offsets):
        return []
    cut = np.flatnonzero(np.diff(offsets) > LENGTH) + 1
    return [(int(x[0]), int(x[-1]) + LENGTH) for x in np.split(offsets, cut)]


def _shard_spans(batches):
    """Repeated spans of contexts that come in the order of their keys."""
    rows: list[tuple] = []
    size, last = 0, None

    def block():
        nonlocal rows, size
        done, rows, size = rows, [], 0
        if not done:
            return
        same: list[tuple] = []
        # Equal contexts of several tasks: the first goes into the array.
        first: dict[bytes, tuple] = {}
        for row in done:
            have = first.setdefault(row[4], row)
            if have is row:
                continue
            early, late = (have, row) if have[1:3] <= row[1:3] else (row, have)
            first[row[4]] = early
            if early[1:3] != late[1:3]:
                yield late[0], late[2], late[2] + len(row[4])
            else:       # the same place of rows of equal id
                same.append(late)
        rid, doc, start, _, contexts = zip(*first.values(), *same)
        found = repeated_windows(list(contexts), np.array(doc), np.array(start))
        yield from ((r, s + a, s + b) for r, s, x in zip(rid, start, found) for a, b in spans_of(x))

    def emit(spans):
        spans = list(spans)
        if spans:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*spans)], names=["rid", "start", "stop"])

    for batch in batches:
        known = []
        for rid, doc, start, stop, key, salt, context in zip(*(c.to_pylist() for c in batch.columns)):
            if context is None:
                known.append((rid, start, stop))
                continue
            if size >= BLOCK_BYTES and (key, salt) != last:
                yield from emit(block())
            rows.append((rid, doc, start, stop, context))
            size += len(context)
            last = (key, salt)
        yield from emit(known)
    yield from emit(block())


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(rid, start, stop): byte ranges that repeat, of each row of (doc_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rid = keyed_hash("doc_id", "text").alias("rid")
    text = F.coalesce("text", F.lit(""))
    keys = materialise(docs.select(rid, text.alias("text")).where(F.octet_length("text") >= LENGTH)
                       .mapInArrow(_key_rows, "rid long, key long, n int"), "window-keys")
    shared = (keys.groupBy("key").agg(F.sum("n").alias("_n")).where("_n > 1")
              .select("key", F.when(F.col("_n") > HOT, F.ceil(F.col("_n") * _WIDTH / HOT)).otherwise(1).cast("int").alias("fan")))
    found = (keys.select("rid", "key").join(shared, "key").groupBy("rid")
             .agg(F.collect_set(F.struct("key", "fan")).alias("_k")).select("rid", "_k.key", "_k.fan"))
    found = materialise(found, "shared-keys")
    discard(keys)
    rows = (docs.select(rid, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), text.alias("text"))
            .where(F.octet_length("text") >= LENGTH).join(found, "rid").select("rid", "doc", "text", "key", "fan"))
    contexts = rows.mapInArrow(_context_rows, CONTEXT_SCHEMA)
    spans = (contexts.repartition("key", "salt").sortWithinPartitions("key", "salt")
             .mapInArrow(_shard_spans, "rid long, start long, stop long"))
    spans = materialise(spans, "spans")
    discard(found)
    return spans


def merge_spans(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal ranges of overlapping or touching ones."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts.tolist(), stops.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame) -> tuple[DataFrame, list]:
    """All columns and two lists of each row, whose columns are also returned: starts and stops."""
    own = free_prefix(docs, "_span")
    spans = repeated_spans(docs).groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("_s"))
    spans = spans.select(F.col("rid").alias(own), F.col("_s.start").alias(f"{own}_start"), F.col("_s.stop").alias(f"{own}_stop"))
    lists = [F.coalesce(F.col(f"{own}_{c}"), F.array().cast("array<long>")).alias(f"{own}_{c}") for c in ("start", "stop")]
    return docs.withColumn(own, keyed_hash("doc_id", "text")).join(spans, own, "left").drop(own), lists


def _kept(batch: pa.RecordBatch, text: int, start: int, stop: int):
    """(bytes, removed ranges) of each row."""
    flat, offsets = buffers(batch.column(text))
    lists = []
    for c in (start, stop):
        column = batch.column(c)
        lists.append((column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()))
    (a, at), (b, _) = lists
    for i in range(batch.num_rows):
        raw = flat[offsets[i]:offsets[i + 1]].tobytes()
        ranges = merge_spans(a[at[i]:at[i + 1]], b[at[i]:at[i + 1]]) if at[i + 1] > at[i] else []
        yield raw, ranges


def _pieces_left(raw: bytes, ranges: list[tuple[int, int]]) -> list[bytes]:
    edges = [0, *(x for r in ranges for x in r), len(raw)]
    return [raw[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)]


def removal_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""

    def run(batches):
        for batch in batches:
            n, gone, spans, digest = [], [], [], []
            for raw, ranges in _kept(batch, 1, 2, 3):
                n.append(len(raw))
                gone.append(sum(b - a for a, b in ranges))
                spans.append(len(ranges))
                digest.append(hashlib.sha256(b"".join(_pieces_left(raw, ranges))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, spans)), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows, lists = _with_spans(docs.select("doc_id", "text"))
    return (rows.select("doc_id", "text", *lists)
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows and columns, with the repeated bytes cut out of the text.

    A character that loses some of its bytes goes; ``n_chars``, if there,
    follows the text.  Null texts stay null.
    """

    def run(batches):
        for batch in batches:
            texts = ["".join(p.decode("utf-8", "ignore") for p in _pieces_left(raw, ranges))
                     for raw, ranges in _kept(batch, 0, batch.num_columns - 2, batch.num_columns - 1)]
            missing = batch.column(0).is_null().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if m else t for m, t in zip(missing, texts)], pa.string()), *batch.columns[1:-2]],
                names=batch.schema.names[:-2])

    others = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(["text string", *(f"`{f.name}` {f.dataType.simpleString()}" for f in others)])
    rows, lists = _with_spans(docs)
    out = rows.select("text", *[F.col(f"`{f.name}`") for f in others], *lists).mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digest(table(spark, sf_dir, "documents"))
