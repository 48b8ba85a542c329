"""Byte-pair encoding and decoding over contiguous rank arrays.

A text is cut at the vocabulary's special tokens, then into pieces by the
byte-level pattern.  A piece is an array of part ids, one a byte at first, and
beside it the array of the ranks of its adjacent pairs.  Over and over the
smallest rank is found, the boundary inside that pair deleted, and the ranks to
its left and right refreshed.  Pieces of equal length do this together as the
rows of a matrix: each step merges one pair of every row, so rows stay equally
long, and a row without a pair to merge leaves.  Scanning costs the square of the
length, so pieces over ``SHORT`` bytes keep their ranks in a heap with linked
neighbours instead; both merge the leftmost pair of smallest rank.

Pieces are looked up before they are merged; what is remembered is bounded by
``REMEMBERED`` characters.  Texts are worked off in windows of ``WINDOW``
characters, which end where a piece must end: before white space that follows
something else.  Documents stand for themselves, so nothing is shuffled; the
vocabulary is broadcast (its size is the file's).

Defined results: null and empty texts give no ids and decode to the empty text;
bytes that aren't UTF-8 count as U+FFFD; a special token's string in a text is
that token; repeated rows are encoded alike; an empty table gives an empty one;
other columns are kept, save one that has the name of the column added.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.shared import bounded_batches, table

VOCABULARY = "byte_bpe_50k.json"
SHORT, WINDOW, REMEMBERED = 256, 1 << 21, 1 << 24
_ROWS = 1 << 14
_NONE = np.iinfo(np.int32).max


class Vocabulary(NamedTuple):
    newer: tuple             # letters and digits that only the pattern library knows
    pairs: np.ndarray        # left id << 32 | right id, ascending
    ranks: np.ndarray        # of these pairs
    merged: np.ndarray       # id that each rank's pair becomes
    byte_ids: np.ndarray     # id of each byte
    spelled: list            # bytes of each id
    special: dict            # special tokens and their ids


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(0x100 + others.index(b)) for b in range(256)]


@lru_cache
def newer_characters() -> tuple[str, str]:
    """Letters and digits of the pattern library that the encoding library doesn't know, as spans.

    The encoding library counts what it doesn't know as neither.  Only characters
    that this Python's own tables don't have can be among them.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    cut = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    fresh = "".join(c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Cn")

    def spans(kind: str, like: str) -> str:
        at = np.array([ord(c) for c in regex.findall(kind, fresh) if len(cut(like + c)) > 1], np.int64)
        runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []
        return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)

    return spans(r"\p{L}", "a"), spans(r"\p{N}", "1")


# The words that a byte-level vocabulary cuts off after an apostrophe.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _pattern(letter: str, digit: str, other: str) -> str:
    return rf"{_CONTRACTIONS}| ?{letter}+| ?{digit}+| ?{other}+|\s+(?!\S)|\s+"


class Pieces:
    """Cuts a text into pieces: plain ASCII, any text, or text with newer characters."""

    def __init__(self, letters: str, digits: str):
        self.ascii = re.compile(_pattern("[A-Za-z]", "[0-9]", r"[^\sA-Za-z0-9]"), re.ASCII).findall
        self.any = regex.compile(_pattern(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")).findall
        self.newer = None
        if letters + digits:
            self.newer = re.compile(f"[{letters}{digits}]").search
            letter, digit = (rf"[\p{{{k}}}--[{c}]]" if c else rf"\p{{{k}}}" for k, c in (("L", letters), ("N", digits)))
            self.exact = regex.compile("(?V1)" + _pattern(letter, digit, rf"(?:[^\s\p{{L}}\p{{N}}]|[{letters}{digits}])")).findall

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        return self.exact(text) if self.newer and self.newer(text) else self.any(text)


def read_vocabulary(raw: str) -> Vocabulary:
    """The tables of a byte-level BPE file (JSON text)."""
    stored = json.loads(raw)
    ids, merges = stored["model"]["vocab"], stored["model"]["merges"]
    letters = byte_letters()
    byte_of = {c: b for b, c in enumerate(letters)}
    couples = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    pairs = np.array([ids[a] << 32 | ids[b] for a, b in couples], np.int64)
    order = np.argsort(pairs, kind="stable")
    special = {t["content"]: t["id"] for t in stored["added_tokens"]}
    spelled = [b""] * (1 + max([*ids.values(), *special.values()]))
    for token, k in {**ids, **special}.items():
        spelled[k] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return Vocabulary(newer_characters(), pairs[order], order.astype(np.int32), np.array([ids[a + b] for a, b in couples], np.int64),
                      np.array([ids[c] for c in letters], np.int64), spelled, special)


class Encoder:
    """Encodes and decodes texts; one for each task."""

    def __init__(self, vocabulary: Vocabulary, short: int = SHORT, window: int = WINDOW):
        self.v, self.short, self.window = vocabulary, short, window
        self.pieces = Pieces(*vocabulary.newer)
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile(f"({'|'.join(map(regex.escape, names))})") if names else None
        self.seam = regex.compile(r"(?<=\S)(?=\s)")
        self.known: dict[str, bytes] = {}
        self.held = 0

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.v.pairs):
            return np.full(left.shape, _NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.v.pairs, key), len(self.v.pairs) - 1)
        return np.where(self.v.pairs[at] == key, self.v.ranks[at], _NONE)

    def merge_rows(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of one length, as little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(words)
        own = np.arange(len(words))
        ids = self.v.byte_ids[np.frombuffer(b"".join(words), np.uint8)].reshape(len(words), -1)
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        while len(own):
            width = ids.shape[1]
            at = ranks.argmin(1) if width > 1 else np.zeros(len(own), np.int64)
            best = ranks[np.arange(len(own)), at] if width > 1 else np.full(len(own), _NONE)
            done = best == _NONE
            if done.any():
                flat = ids[done].astype("<u4").tobytes()
                for k, i in enumerate(own[done].tolist()):
                    out[i] = flat[4 * width * k:4 * width * (k + 1)]
                own, ids, ranks, at, best = (x[~done] for x in (own, ids, ranks, at, best))
                if not len(own):
                    break
            row, places = np.arange(len(own)), np.arange(width - 1)
            ids = np.take_along_axis(ids, places + (places > at[:, None]), 1)
            ids[row, at] = self.v.merged[best]
            places = places[:-1]
            ranks = np.take_along_axis(ranks, places + (places >= at[:, None]), 1)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            ranks[left, at[left] - 1] = self.rank(ids[left, at[left] - 1], ids[left, at[left]])
            ranks[right, at[right]] = self.rank(ids[right, at[right]], ids[right, at[right] + 1])
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same for one long word: its ranks in a heap."""
        ids = self.v.byte_ids[np.frombuffer(word, np.uint8)]
        ranks = self.rank(ids[:-1], ids[1:])
        heap = [(int(ranks[i]), i) for i in np.flatnonzero(ranks != _NONE).tolist()]
        heapq.heapify(heap)
        now, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        fresh = ranks.tolist() + [_NONE]
        place = {int(k): int(r) for k, r in zip(self.v.pairs, self.v.ranks)} if heap else {}

        def refresh(i):
            r = place.get(now[i] << 32 | now[after[i]], _NONE) if after[i] < n else _NONE
            fresh[i] = r
            if r != _NONE:
                heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if fresh[i] != r:
                continue
            gone = after[i]
            now[i], now[gone], fresh[gone] = int(self.v.merged[r]), -1, _NONE
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            refresh(i)
            if before[i] >= 0:
                refresh(before[i])
        return np.array([k for k in now if k >= 0], "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Merge pieces that aren't known yet."""
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            by_length.setdefault(len(raw := p.encode()), []).append((p, raw))
        for length, group in by_length.items():
            if length > self.short:
                self.known.update((p, self.merge_long(raw)) for p, raw in group)
            else:
                for i in range(0, len(group), _ROWS):
                    part = group[i:i + _ROWS]
                    self.known.update(zip([p for p, _ in part], self.merge_rows([raw for _, raw in part])))
            self.held += length * len(group)

    def segments(self, text: str) -> Iterator[str | int]:
        """Special tokens as ids, and the texts between them, in windows."""
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                yield self.v.special[part]
                continue
            at = 0
            while len(part) - at > self.window:
                seam = self.seam.search(part, at + self.window)
                if not seam:
                    break
                yield part[at:seam.start()]
                at = seam.start()
            yield part[at:] if at else part

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        out: list[list[bytes]] = []
        waiting: list[tuple[int, list[str] | int]] = []
        size = 0

        def work_off():
            nonlocal size
            if self.held > REMEMBERED:
                self.known.clear()
                self.held = 0
            self.learn({p for _, s in waiting if not isinstance(s, int) for p in s}.difference(self.known))
            for i, s in waiting:
                out[i].append(s.to_bytes(4, "little") if isinstance(s, int) else b"".join(map(self.known.__getitem__, s)))
            waiting.clear()
            size = 0

        for i, text in enumerate(texts):
            out.append([])
            for segment in self.segments(text):
                if isinstance(segment, int):
                    waiting.append((i, segment))
                else:
                    waiting.append((i, self.pieces(segment)))
                    size += len(segment)
                    if size >= self.window:
                        work_off()
        work_off()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that aren't UTF-8 become U+FFFD, as do ids out of range."""
        spelled, n = self.v.spelled, len(self.v.spelled)
        values = np.frombuffer(ids, "<u4")
        if len(values) and int(values.max()) >= n:
            return b"".join(spelled[k] if k < n else b"\xff" for k in values.tolist()).decode("utf-8", "replace")
        return b"".join(map(spelled.__getitem__, values.tolist())).decode("utf-8", "replace")


def _added(df: DataFrame, name: str, source: str, kind: T.DataType, value_type: pa.DataType, shared, work) -> DataFrame:
    """``df`` with a column that ``work(encoder, values)`` makes of another."""
    bounded_batches(df.sparkSession)
    kept = [c for c in df.columns if c != name or c == source]
    frame = df.select(*[F.col(f"`{c}`") for c in kept if c != name], F.col(f"`{source}`").cast("binary").alias(name))

    def run(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            values = work(encoder, batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, value_type)], names=batch.schema.names)

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields[:-1], T.StructField(name, kind)]))


def load(spark: SparkSession, path: str):
    """The vocabulary of a file on the driver, as a broadcast."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(read_vocabulary(f.read()))


def encoded(df: DataFrame, vocabulary, text: str = "text", into: str = "ids") -> DataFrame:
    """Adds the ids of a text column, as little-endian 32-bit numbers in a binary."""
    return _added(df, into, text, T.BinaryType(), pa.binary(), vocabulary,
                  lambda e, column: e.encode((v or b"").decode("utf-8", "replace") for v in column.to_pylist()))


def decoded(df: DataFrame, vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text that ids stand for; null: the empty text."""
    return _added(df, into, ids, T.StringType(), pa.string(), vocabulary,
                  lambda e, column: [e.decode(v or b"") for v in column.to_pylist()])


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = load(spark, public_tokenizers.path(VOCABULARY))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decoded(encoded(docs, vocabulary).select("doc_id", "ids"), vocabulary)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
