"""Whole columns of text as numpy arrays: words, hashes, n-grams.

Words are runs of bytes other than space and \\x09-\\x0D, which is the same as
runs of code points other than those, since no other code point has such a
byte in UTF-8.  Lower-casing covers A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and ASCII punctuation: what splits plain words.
PUNCTUATION = SPACE.copy()
PUNCTUATION[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every bit of a 64-bit word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse modulo 2**64."""
    size = max(CHUNK_BYTES + 1, 1 << max(1, int(n - 1).bit_length()))
    if size not in _POWERS:
        up, down = np.full(size, _BASE), np.full(size, _BASE_INV)
        up[0] = down[0] = 1
        if size > 4 * CHUNK_BYTES:
            return np.cumprod(up), np.cumprod(down)
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


class Chunk(NamedTuple):
    """Some documents of a batch: their bytes and where each one begins."""

    first: int            # index of the first document in the batch
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, one more than documents

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A text column's bytes and offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat, offsets


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Consecutive documents, together up to ``size`` bytes or one document."""
    flat, offsets = buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(n, max(i + 1, j))
        yield Chunk(i, flat[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


def word_spans(chunk: Chunk, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each document."""
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = np.zeros(n + 2, bool)
    word[1:-1] = ~breaks[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans ascend and don't overlap.

    Prefix sums of byte values times powers of a base give each span's
    polynomial; it is worked off in pieces, so memory follows the piece.
    """
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        part = LOWER[data[lo:hi]] if lower else data[lo:hi]
        up, down = powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def word_hashes(chunk: Chunk, lower: bool = True, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words before each document."""
    starts, ends, at = word_spans(chunk, breaks)
    return hash_spans(chunk.data, starts, ends, lower), at


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words of one array (across documents too)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[:len(words) - n + 1].copy()
    for i in range(1, n):
        out *= _BASE
        out += words[i:len(words) - n + 1 + i]
    return mix(out)


def shingle_set(words: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word hashes of one document.

    ``grams`` are the hashes that start at its words.  Fewer than n words
    count as one shingle; no words as none.
    """
    if len(words) >= n:
        s = np.sort(grams[:len(words) - n + 1])
        keep = np.empty(len(s), bool)
        keep[0] = True
        np.not_equal(s[1:], s[:-1], out=keep[1:])
        return s[keep]
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    whole = words[:1].copy()
    for w in words[1:]:
        whole = whole * _BASE + w
    return mix(whole ^ np.uint64(0xA5A5A5A5A5A5A5A5) + np.uint64(len(words)))
