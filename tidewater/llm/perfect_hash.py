"""Minimal perfect hashes in shards, looked up for whole arrays of keys at once.

A shard's keys go through levels of bits: a key whose place nobody else wants
sets the bit there, the others try the next, smaller level.  The number of bits
set before a key's own is its slot, so slots are dense.  A lookup ends by
comparing bytes with the key that is stored for the slot, so a key that was never
put in is found out, whatever its hash.  Keys that no level can tell apart, since
their hashes are equal, are listed and compared one by one.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np

from tidewater.llm.textarrays import mix

LEVELS, ROOM = 48, 2.0
#: A longer key is stored, and compared, as a NUL and its SHA-256.
LONGEST = 63
_SEEDS = mix(np.arange(1, LEVELS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def place(hashes: np.ndarray, level: int, size) -> np.ndarray:
    """Bit of each hash in a level of so many bits."""
    return ((mix(hashes ^ _SEEDS[level]) >> np.uint64(32)) * np.asarray(size).astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def build(hashes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits one after another, and the keys' order by slot.

    The order ends with the keys that no level could place.
    """
    left = np.arange(len(hashes))
    sizes, bits, order = [], [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, int(ROOM * len(left)))
        at = place(hashes[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        sizes.append(size)
        bits.append(alone)
        order.append(left[own][np.argsort(at[own])])
        left = left[~own]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), np.concatenate([*order, left]).astype(np.int64)


class Keys(NamedTuple):
    """Byte strings as spans of an array."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def take(self, at: np.ndarray) -> Keys:
        return Keys(self.data, self.starts[at], self.ends[at])

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """The strings one after another, and their offsets."""
        size = self.ends - self.starts
        offsets = np.concatenate([[0], np.cumsum(size)])
        return self.data[np.repeat(self.starts - offsets[:-1], size) + np.arange(offsets[-1])], offsets


def bounded(keys: Keys) -> Keys:
    """The same keys, long ones as digests."""
    long = np.flatnonzero(keys.ends - keys.starts > LONGEST)
    if not len(long):
        return keys
    digests = [b"\0" + hashlib.sha256(keys.data[a:b].tobytes()).digest() for a, b in zip(keys.starts[long].tolist(), keys.ends[long].tolist())]
    width = len(digests[0])
    data = np.concatenate([keys.data, np.frombuffer(b"".join(digests), np.uint8)])
    starts, ends = keys.starts.copy(), keys.ends.copy()
    starts[long] = len(keys.data) + width * np.arange(len(long))
    ends[long] = starts[long] + width
    return Keys(data, starts, ends)


def same(a: Keys, b: Keys) -> np.ndarray:
    """Which strings of two equally long lists are equal, byte by byte."""
    size = a.ends - a.starts
    equal = size == b.ends - b.starts
    at = np.flatnonzero(equal)
    x, offsets = a.take(at).packed()
    y, _ = b.take(at).packed()
    wrong = np.concatenate([[0], np.cumsum(x != y)])
    equal[at] = wrong[offsets[1:]] == wrong[offsets[:-1]]
    return equal


class Shards:
    """Several shards as one table; slots are numbered through, shard by shard."""

    def __init__(self, parts: list[tuple[list[int], np.ndarray, int]], keys: Keys, overflow_hashes: dict[int, int] | None = None):
        """``parts``: each shard's level sizes, its bits (packed), its number of keys; ``keys``: all keys by slot.

        ``overflow_hashes``: hashes of the slots that no level leads to.
        """
        depth = max([len(s) for s, _, _ in parts], default=0)
        self.keys = keys
        self.bases = np.concatenate([[0], np.cumsum([n for _, _, n in parts])]).astype(np.int64)
        self.sizes = np.zeros((depth, len(parts)), np.int64)
        self.at = np.zeros((depth, len(parts)), np.int64)
        bits, rank, first = [], [], 0
        for i, (sizes, raw, _) in enumerate(parts):
            total = sum(sizes)
            own = np.unpackbits(raw, count=total).astype(bool)
            bits.append(own)
            rank.append(self.bases[i] + np.concatenate([[0], np.cumsum(own)])[:-1])
            self.sizes[:len(sizes), i] = sizes
            self.at[:len(sizes), i] = first + np.concatenate([[0], np.cumsum(sizes)])[:-1]
            first += total
        self.bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.rank = np.concatenate(rank).astype(np.int32) if rank else np.zeros(0, np.int32)
        self.overflow = sorted((overflow_hashes or {}).items())

    def slots(self, shard: np.ndarray, hashes: np.ndarray, keys: Keys) -> np.ndarray:
        """Slot of each key in its shard, or -1 for a key that isn't there."""
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        for level in range(len(self.sizes)):
            size = self.sizes[level, shard[left]]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = self.at[level, shard[left]] + place(hashes[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        found = np.flatnonzero(out >= 0)
        wrong = found[~same(keys.take(found), self.keys.take(out[found]))]
        out[wrong] = -1
        for slot, hashed in self.overflow:
            may = np.flatnonzero((hashes == np.uint64(hashed)) & (shard == np.searchsorted(self.bases, slot, "right") - 1))
            here = may[same(keys.take(may), self.keys.take(np.full(len(may), slot)))]
            out[here] = slot
        return out
