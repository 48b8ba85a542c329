"""Plain versions of the corpus operators, for small tables only."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from itertools import product

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = str.maketrans(UPPER, LOWER)
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(LOWERED) if lower else text)


def shingles(text, n):
    w = words(text)
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def groups(rows, n, percent):
    """(shingles, number of the component) of each (id, text)."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return [(len(sets[i]), find(i)) for i in range(len(rows))]


def components(rows, n, percent):
    """(shingles, smallest id of the component) of each (id, text)."""
    found, low = groups(rows, n, percent), {}
    for (k, _), (_, r) in zip(rows, found):
        if k is not None:
            low[r] = min(low.get(r, k), k)
    return [(size, low.get(r, k)) for (k, _), (size, r) in zip(rows, found)]


def rule_counts(text):
    text = text or ""
    w = words(text, lower=False)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    repeat = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat))


def removed(rows, length=100):
    """(bytes, removed flags) of each (id, text), by the definition."""
    first = {}
    data = [(t or "").encode() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        for p in range(len(data[i]) - length + 1):
            s = data[i][p:p + length]
            place = (rows[i][0] is None, rows[i][0] or 0, p)
            if s not in first or place < first[s]:
                first[s] = place
    out = []
    for i, b in enumerate(data):
        flags = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (rows[i][0] is None, rows[i][0] or 0, p):
                flags[p:p + length] = b"\x01" * length
        out.append((b, flags))
    return out


def removal_row(b, flags):
    kept = bytes(c for c, f in zip(b, flags) if not f)
    runs = sum(1 for k in range(len(b)) if flags[k] and (k == 0 or not flags[k - 1]))
    return len(b), sum(flags), runs, hashlib.sha256(kept).hexdigest()


def kept_text(b, flags):
    """What is left of the text when cut characters go."""
    out, run = [], bytearray()
    for c, f in zip(b, flags):
        if f:
            out.append(bytes(run).decode("utf-8", "ignore"))
            run = bytearray()
        else:
            run.append(c)
    return "".join([*out, bytes(run).decode("utf-8", "ignore")])


def overlaps(docs, items, window=13, percent=80):
    """{(id, item): covered} over all alignments."""
    out = {}
    for (d, text), (k, item) in product(docs, items):
        a, b = words(text), words(item)
        if not a or not b:
            continue
        size = min(window, len(b))
        need = size if size < 5 else -(-percent * size // 100)
        best = 0
        for shift in range(-len(b) + 1, len(a)):
            low, high = max(0, -shift), min(len(b), len(a) - shift)
            same = [a[j + shift] == b[j] for j in range(low, high)]
            inside = set()
            for p in range(len(same) - size + 1):
                if sum(same[p:p + size]) >= need:
                    inside.update(range(p, p + size))
            best = max(best, len(inside))
        if best:
            out[d, k] = best
    return out


def word_totals(texts):
    c = Counter()
    for t in texts:
        c.update([*words(t), None])
    return c


def mix(rows, weights=(5, 2, 1), cap=3):
    """{row number: (size, source size, target, taken)} of (id, source, text)."""
    from fractions import Fraction

    size = [len(words(t)) for _, _, t in rows]
    total = Counter()
    for (_, s, _), n in zip(rows, size):
        total[s] += n
    ranked = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ranked)}
    target, open_ = {}, set(ranked)
    while True:
        left = sum(total.values()) - sum(target.values())
        share = {s: Fraction(left * weight[s], sum(weight[x] for x in open_)) for s in open_}
        above = {s for s in open_ if share[s] > cap * total[s]}
        if not above:
            break
        target |= {s: cap * total[s] for s in above}
        open_ -= above
    target |= share
    key = [int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16) for i, _, _ in rows]
    taken = {}
    for s in ranked:
        own = [i for i in range(len(rows)) if rows[i][1] == s]
        passes = 0 if not total[s] else int(target[s] // total[s])
        rest, chosen = target[s] - passes * total[s], set()
        groups = defaultdict(list)
        for i in own:
            if size[i]:
                groups[key[i]].append(i)
        for k in sorted(groups):
            n = sum(size[i] for i in groups[k])
            if n <= rest or 0 < rest and 2 * rest >= n:
                chosen.update(groups[k])
            if n >= rest:
                break
            rest -= n
        for i in own:
            taken[i] = (size[i], total[s], float(target[s]), size[i] * (passes + (i in chosen)))
    return taken
