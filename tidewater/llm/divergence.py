"""Source divergence audit: how far sources of a language are from each other.

The first pass counts, exactly, in how many documents of its language each term
occurs, and keeps the frequent ones.  Their minimal perfect hashes, in shards of
``SHARD_KEYS`` on average, are made by Spark tasks, a shard each, and broadcast
with the keys themselves.  The second pass recounts: each term of a text is looked
up, compared with the stored key, and adds one to the dense slot of its (language,
source) group.  Sums of slots are what all figures are worked out from, in integers.

A broadcast has ``BROADCAST_KEYS`` keys at most, of 64 bytes or less (a longer key
as its digest).  If there are more, the first broadcast has those so frequent that
no more of them can be; what isn't found there is written, dealt out by the hash
that picks the later broadcasts, so each of these reads its own share only and no
text is read again.

Divergences of pairs come from pages of ``PAGE`` slots: a task has one page's counts
of all sources of the language, so a table of sources by slots, and adds up every
ordered pair; pages are summed by Spark.  Terms of a group are ranked in buckets,
then among those left, so a large group isn't ranked by one task.

Defined results: null text, language and source count as empty; a group without
terms has a row for each other source; a language of one source has no pairs; without
kept terms values are 0 and there are no terms; repeated rows are documents of their
own; an empty table gives an empty one; other columns are not read.  All arithmetic
is exact for languages of less than 9e15 kept words.  Within one batch, terms are
told apart by 64-bit hashes when documents are counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.perfect_hash import Keys, Shards, bounded, build
from tidewater.llm.shared import bounded_batches, materialise, table
from tidewater.llm.textarrays import LOWER, buffers, chunks, hash_spans, mix, word_spans
from tidewater.operators.keyed import top_k

MIN_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
SHARD_KEYS, BROADCAST_KEYS, PAGE = 1 << 13, 1 << 21, 1 << 12
_CHUNK, _COUNTERS, _HELD, _PARTS = 4 << 20, 1 << 23, 1 << 20, 16

#: All bytes below 0x80 but letters end a term.
BREAKS = np.ones(256, bool)
BREAKS[0x80:] = BREAKS[0x41:0x5B] = BREAKS[0x61:0x7B] = False


def _codes(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    d = pc.dictionary_encode(pc.fill_null(column, ""))
    return d.indices.to_numpy(), d.dictionary.to_pylist()


def _lang_hashes(langs: list[str]) -> np.ndarray:
    raw = [x.encode() for x in langs]
    ends = np.cumsum([len(x) for x in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    # Mixed once more: a term may be spelled like a language.
    return mix(hash_spans(data, ends - np.array([len(x) for x in raw], np.int64), ends, False) + np.uint64(1))


def _terms(chunk) -> tuple[Keys, np.ndarray, np.ndarray]:
    """Terms of a chunk, their hashes, and the document of each."""
    starts, ends, at = word_spans(chunk, BREAKS)
    keys = Keys(LOWER[chunk.data], starts, ends)
    return keys, hash_spans(keys.data, starts, ends, False), np.repeat(np.arange(chunk.n), np.diff(at))


def _packed_strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _strings(keys: Keys) -> pa.Array:
    return _packed_strings(*keys.packed())


def _combined(parts: list[tuple]) -> tuple:
    """(data, offsets, lang, h, df, n) of several such, equal hashes as one."""
    if len(parts) == 1:
        return parts[0]
    h = np.concatenate([x[3] for x in parts])
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    shift = np.cumsum([0] + [len(x[0]) for x in parts])
    spans = [np.concatenate([x[1][side] + k for x, k in zip(parts, shift)]) for side in (slice(None, -1), slice(1, None))]
    own = order[first]
    data, offsets = Keys(np.concatenate([x[0] for x in parts]), *spans).take(own).packed()
    sums = [np.add.reduceat(np.concatenate([x[i] for x in parts])[order], first) for i in (4, 5)]
    return data, offsets, np.concatenate([x[2] for x in parts])[own], h[own], *sums


def _counted(part: tuple, langs: list[str]) -> pa.RecordBatch:
    data, offsets, lang, h, df, n = part
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(lang)), _packed_strings(data, offsets),
                                       pa.array(h.view(np.int64)), pa.array(df), pa.array(n)], names=["lang", "term", "h", "df", "n"])


def _document_counts(batches):
    """(lang, term, h, df, n) of a task's texts, ``_HELD`` terms at a time: documents and occurrences."""
    number, parts = {}, []
    for batch in batches:
        code, langs = _codes(batch.column(0))
        code = np.array([number.setdefault(x, len(number)) for x in langs], np.int64)[code]
        salt = _lang_hashes(list(number))
        for c in chunks(batch.column(1), _CHUNK):
            keys, hashed, doc = _terms(c)
            if not len(hashed):
                continue
            own = code[c.first:c.first + c.n][doc]
            h = mix(hashed ^ salt[own])
            order = np.argsort(h, kind="stable")        # documents stay in order
            h, at = h[order], doc[order]
            new = np.concatenate([[True], h[1:] != h[:-1]])
            first = np.flatnonzero(new)
            new[1:] |= at[1:] != at[:-1]
            df = np.add.reduceat(new.astype(np.int64), first)
            n = np.diff(np.append(first, len(h)))
            parts.append((*keys.take(order[first]).packed(), own[order[first]], h[first], df, n))
            if sum(len(x[3]) for x in parts) >= _HELD:
                parts = [_combined(parts)]
                if len(parts[0][3]) >= _HELD // 2:
                    yield _counted(parts.pop(), list(number))
    if parts:
        yield _counted(_combined(parts), list(number))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, h, n) of the terms in at least so many of their language's documents."""
    counts = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, h long, df long, n long")
    sums = counts.groupBy("lang", "term", "h").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    return materialise(sums.where(F.col("df") >= min_docs).drop("df"), "kept-terms")


_SHARD = "block int, lang string, shard long, n long, sizes array<long>, bits binary, terms array<string>, hashes array<long>"


def _shard(rows: pa.Table) -> pa.Table:
    """One shard: its levels, its terms in the order of their slots, hashes of those without a level."""
    rows = rows.combine_chunks()
    h = rows["h"].to_numpy().view(np.uint64)
    sizes, bits, order = build(h)
    loose = order[int(bits.sum()):]
    return pa.table({"block": rows["block"][:1], "lang": rows["lang"][:1], "shard": rows["shard"][:1], "n": pa.array([len(h)], pa.int64()),
                     "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
                     "terms": pa.array([rows["term"].take(pa.array(order)).to_pylist()], pa.list_(pa.string())),
                     "hashes": pa.array([h[loose].view(np.int64)], pa.list_(pa.int64()))})


def shards_of(kept: DataFrame, shard_keys: int = SHARD_KEYS, broadcast_keys: int = BROADCAST_KEYS) -> tuple[DataFrame, int]:
    """A row for each shard, with the number of its first slot; and the number of broadcasts."""
    keys, total = kept.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # No more than broadcast_keys terms can each have this share of all words.
    often = F.lit(keys <= broadcast_keys) | (F.col("n") * broadcast_keys >= total)
    others = -(-keys // broadcast_keys) if keys > broadcast_keys else 0
    block = F.when(often, 0).otherwise(1 + later_block(others)).cast("int") if others else F.lit(0)
    dealt = kept.withColumn("block", block)
    number = F.count("*").over(W.partitionBy("lang", "block"))
    per = dealt.groupBy("lang", "block").agg(F.count("*").alias("k")).withColumn("shards", F.expr(f"(k + {shard_keys - 1}) div {shard_keys}"))
    dealt = dealt.join(per, ["lang", "block"]).withColumn("shard", shard_number(F.col("shards")))
    # Dealt out by shard: what the join dealt by language would put a language's shards into one task.
    dealt = dealt.select("block", "lang", "shard", "term", "h").repartition("block", "lang", "shard")
    built = dealt.groupBy("block", "lang", "shard").applyInArrow(_shard, _SHARD)
    built = materialise(built, "perfect-hashes")
    # One row a shard: this window has as many rows as there are shards.
    first = built.select("block", "lang", "shard", (F.sum("n").over(W.orderBy("lang", "block", "shard")) - F.col("n")).alias("first"))
    return built.join(F.broadcast(first), ["block", "lang", "shard"]), 1 + others


def later_block(n: int) -> Column:
    return F.pmod(F.shiftright("h", 3), F.lit(n)) if n else F.lit(0)


def shard_number(n: Column) -> Column:
    """A term's shard among its language's; as in ``Lookup.shard``."""
    return F.shiftrightunsigned("h", 40) % n


class Lookup:
    """A broadcast's shards with the languages they belong to."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.langs = {}
        starts = np.concatenate([[0], np.cumsum(rows["n"].to_numpy())]).astype(np.int64)
        for i, lang in enumerate(rows["lang"].to_pylist()):
            first, _ = self.langs.get(lang, (i, 0))     # a language's slots in a broadcast follow one another
            self.langs[lang] = first, i + 1
        terms = rows["terms"].combine_chunks().flatten()
        data, offsets = buffers(terms) if len(terms) else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        keys = bounded(Keys(data, offsets[:-1], offsets[1:]))
        flat, at = keys.packed()
        loose = {}
        for i, h in enumerate(rows["hashes"].to_pylist()):
            loose.update({int(starts[i + 1]) - len(h) + k: x % (1 << 64) for k, x in enumerate(h)})
        parts = [(s, np.frombuffer(b, np.uint8), n) for s, b, n in zip(rows["sizes"].to_pylist(), rows["bits"].to_pylist(), rows["n"].to_pylist())]
        self.shards = Shards(parts, Keys(flat, at[:-1], at[1:]), loose)
        self.starts = starts
        self.first = rows["first"].to_numpy()

    def width(self, lang: str) -> tuple[int, int, int]:
        """A language's first slot and the end here, and the number of its first slot among all."""
        a, b = self.langs[lang]
        return int(self.starts[a]), int(self.starts[b]), int(self.first[a])

    def find(self, langs: list[str], own: np.ndarray, h: np.ndarray, keys: Keys) -> np.ndarray:
        """Slot in this broadcast of each key of a language, or -1."""
        spans = np.array([self.langs.get(x, (0, 0)) for x in langs], np.int64).reshape(-1, 2)
        n = spans[own, 1] - spans[own, 0]
        out = np.full(len(h), -1, np.int64)
        at = np.flatnonzero(n > 0)
        shard = spans[own[at], 0] + ((h[at] >> np.uint64(40)).astype(np.int64) % n[at])
        out[at] = self.shards.slots(shard, h[at], bounded(keys.take(at)))
        return out


class Counters:
    """Dense counts of groups over their language's slots; handed out when they are too many."""

    def __init__(self, lookup: Lookup, limit: int = _COUNTERS):
        self.lookup, self.limit, self.held, self.groups = lookup, limit, 0, {}

    def add(self, lang: str, source: str, slots: np.ndarray, n: np.ndarray | int):
        lo, hi, _ = self.lookup.width(lang)
        if (lang, source) not in self.groups:
            if self.groups and self.held + hi - lo > self.limit:
                yield from self.flush()
            self.groups[lang, source] = np.zeros(hi - lo, np.int64)
            self.held += hi - lo
        np.add.at(self.groups[lang, source], slots - lo, n)

    def flush(self):
        rows = []
        for (lang, source), counts in self.groups.items():
            at = np.flatnonzero(counts)
            slot = at + self.lookup.width(lang)[2]
            rows += _pages(lang, source, slot, counts[at])
        self.groups, self.held = {}, 0
        if rows:
            yield _page_batch(rows)


#: Rows of counts: a page's slots (two bytes each, from the page's first) and their
#: counts (eight bytes each); or, without a page, a term that wasn't found.
_COUNTED = "lang string, source string, page long, at binary, n binary, total long, term string, h long"
_NAMES = [f.split()[0] for f in _COUNTED.split(", ")]


def _pages(lang: str, source: str, slot: np.ndarray, n: np.ndarray) -> list[tuple]:
    """A row for each page of ascending slots."""
    page = slot // PAGE
    cuts = np.flatnonzero(np.diff(page)) + 1
    return [(lang, source, int(s[0]) // PAGE, (s % PAGE).astype(np.uint16).tobytes(), k.astype(np.int64).tobytes(), int(k.sum()))
            for s, k in zip(np.split(slot, cuts), np.split(n, cuts)) if len(s)]


def _page_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([*[pa.array(x, k) for x, k in zip(zip(*rows), kinds)], pa.nulls(len(rows), pa.string()),
                                       pa.nulls(len(rows), pa.int64())], names=_NAMES)


def _page_sums(batches):
    """Sums of rows that are in order of (lang, source, page): one row each."""
    now, counts, out = None, np.zeros(PAGE, np.int64), []

    def done():
        at = np.flatnonzero(counts)
        out.extend(_pages(now[0], now[1], at + now[2] * PAGE, counts[at]))
        counts[:] = 0

    for batch in batches:
        for lang, source, page, at, n in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if (lang, source, page) != now:
                if now:
                    done()
                now = lang, source, page
            counts[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int64)
        if len(out) >= 256:
            yield _page_batch(out)
            out = []
    if now:
        done()
        yield _page_batch(out)


def _by_group(group: np.ndarray):
    """Places of each group's entries."""
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    return [x for x in np.split(order, cuts) if len(x)]


def _recount_texts(batches, lookup: Lookup, more: bool):
    """Counts by group and slot; if there are more broadcasts, also terms not found, by group."""
    counters = Counters(lookup)
    for batch in batches:
        lang_code, langs = _codes(batch.column(0))
        source_code, sources = _codes(batch.column(1))
        group = lang_code.astype(np.int64) * len(sources) + source_code
        salt = _lang_hashes(langs)
        for c in chunks(batch.column(2), _CHUNK):
            keys, hashed, doc = _terms(c)
            if not len(hashed):
                continue
            own = lang_code[c.first:c.first + c.n][doc]
            h = mix(hashed ^ salt[own])
            order = np.argsort(h)
            new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
            one = order[new]                            # each term is looked up once a chunk
            slots = np.empty(len(h), np.int64)
            slots[order] = lookup.find(langs, own[one], h[one], keys.take(one))[np.cumsum(new) - 1]
            groups = group[c.first:c.first + c.n][doc]
            found = np.flatnonzero(slots >= 0)
            for at in _by_group(groups[found]):
                g = int(groups[found[at[0]]])
                yield from counters.add(langs[g // len(sources)], sources[g % len(sources)], slots[found[at]], 1)
            if more and len(rest := np.flatnonzero(slots < 0)):
                order = rest[np.lexsort((groups[rest], h[rest]))]
                new = np.flatnonzero(np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (groups[order][1:] != groups[order][:-1])]))
                k, g = order[new], groups[order[new]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()).take(pa.array(g // len(sources))), pa.array(sources, pa.string()).take(pa.array(g % len(sources))),
                     pa.nulls(len(k), pa.int64()), pa.nulls(len(k), pa.binary()), pa.nulls(len(k), pa.binary()),
                     pa.array(np.diff(np.append(new, len(order)))), _strings(keys.take(k)), pa.array(h[k].view(np.int64))],
                    names=_NAMES)
    yield from counters.flush()


def _recount_terms(batches, lookup: Lookup):
    """The same from (lang, source, term, h, n) rows."""
    counters = Counters(lookup)
    for batch in batches:
        lang_code, langs = _codes(batch.column(0))
        source_code, sources = _codes(batch.column(1))
        data, offsets = buffers(batch.column(2))
        keys = Keys(data, offsets[:-1], offsets[1:])
        slots = lookup.find(langs, lang_code, batch.column(3).to_numpy().view(np.uint64), keys)
        groups = lang_code.astype(np.int64) * len(sources) + source_code
        n, found = batch.column(4).to_numpy(), np.flatnonzero(slots >= 0)
        for at in _by_group(groups[found]):
            g = int(groups[found[at[0]]])
            yield from counters.add(langs[g // len(sources)], sources[g % len(sources)], slots[found[at]], n[found[at]])
    yield from counters.flush()


def recount(docs: DataFrame, shards: DataFrame, broadcasts: int) -> DataFrame:
    """(lang, source, page, at, n, total): the second pass, over perfect hashes only.

    A page's counts of a group come in ``_PARTS`` rows at most, each the sum of some
    tasks, so no page is added up by one task.
    """
    context = docs.sparkSession.sparkContext
    columns = ["lang", "n", "sizes", "bits", "terms", "hashes", "first"]

    def shared(block: int):
        rows = shards.where(F.col("block") == block).orderBy("lang", "shard").select(*columns).toArrow()
        return context.broadcast(Lookup(rows))

    head, more = shared(0), broadcasts > 1
    first = docs.select("lang", "source", "text").mapInArrow(lambda b: _recount_texts(b, head.value, more), _COUNTED)
    if more:
        first = first.withColumn("block", F.when(F.col("page").isNull(), later_block(broadcasts - 1) + 1).otherwise(0).cast("int"))
        first = materialise(first.repartition("block", F.pmod(F.xxhash64("term", "page"), F.lit(64))).sortWithinPartitions("block"), "recounted")
    figures = _NAMES[:6]
    total = first.where("page is not null").select(*figures)
    for block in range(1, broadcasts):
        hashes = shared(block)
        rows = first.where((F.col("block") == block) & F.col("page").isNull()).select("lang", "source", "term", "h", F.col("total").alias("n"))
        total = total.unionByName(rows.mapInArrow(lambda b, hashes=hashes: _recount_terms(b, hashes.value), _COUNTED).select(*figures))
    # A row's own hash deals out what several tasks say of one page.
    part = F.pmod(F.xxhash64("at", "n"), F.lit(_PARTS))
    dealt = total.repartition("lang", "source", "page", part).sortWithinPartitions("lang", "source", "page")
    return materialise(dealt.mapInArrow(_page_sums, _COUNTED).select(*figures), "page-counts")


def share(n: np.ndarray, of: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """1 + floor(scale * n / of), exactly, three digits at a time; n <= of < 9e15."""
    out, left, step = np.zeros(np.broadcast(n, of).shape, np.int64), n % of, 1
    out = out + n // of * scale
    while step < scale:
        step *= 1000
        left = left * 1000
        out += left // of * (scale // step)
        left = left % of
    return 1 + out


def _page_rows(batches):
    """Partial sums of pairs, and each group's terms that may be among its first."""
    for batch in batches:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            groups = col["groups"][i].values
            sources, totals = groups.field("source").to_pylist(), groups.field("total").to_numpy()
            v, first, width = col["v"][i].as_py(), col["first"][i].as_py(), col["width"][i].as_py()
            place = {s: k for k, s in enumerate(sources)}
            counts = np.zeros((len(sources), width), np.int64)
            for entry in col["entries"][i].values:
                at = np.frombuffer(entry["at"].as_buffer(), np.uint16).astype(np.int64) + (first // PAGE * PAGE - first)
                counts[place[entry["source"].as_py()], at] += np.frombuffer(entry["n"].as_buffer(), np.int64)
            p = share(counts + 1, (totals + v)[:, None])
            lang = col["lang"][i].as_py()
            for k, s in enumerate(sources):
                d = p[k] - p
                f = (d * d // p).sum(1)
                others = [j for j in range(len(sources)) if j != k]
                if others:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(others)), pa.array([s] * len(others)), pa.array([sources[j] for j in others]),
                         pa.nulls(len(others), pa.int64()), pa.array(f[others])], names=_PAGE_NAMES)
            q = share(counts.sum(0) + 1, np.int64(totals.sum() + v))
            for k, s in enumerate(sources):
                at = np.flatnonzero((counts[k] > 0) & (p[k] > q))
                if not len(at):
                    continue
                d = p[k, at] - q[at]
                f = d * d // q[at]
                if len(f) > TOP:        # all that equal the last one stay
                    own = f >= np.partition(f, len(f) - TOP)[len(f) - TOP]
                    at, f = at[own], f[own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array([s] * len(at)), pa.nulls(len(at), pa.string()), pa.array(at + first), pa.array(f)],
                    names=_PAGE_NAMES)


_PAGES = "lang string, source string, other string, slot long, value long"
_PAGE_NAMES = [f.split()[0] for f in _PAGES.split(", ")]


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (lang, source, text).

    Part 'pair' has a row for each other source of the language, part 'term' the
    ``TOP`` terms that a group has more of than its language.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = kept_terms(docs, min_docs)
    shards, broadcasts = shards_of(kept, shard_keys, broadcast_keys)
    counts = recount(docs, shards, broadcasts)
    slots = shards.select("lang", "first", F.posexplode("terms").alias("at", "term")).select("lang", (F.col("first") + F.col("at")).alias("slot"), "term")
    page = F.expr(f"slot div {PAGE}").alias("page")
    pages = slots.groupBy("lang", page).agg(F.min("slot").alias("first"), (F.max("slot") - F.min("slot") + 1).alias("width"))
    groups = (docs.select("lang", "source").distinct().join(counts.groupBy("lang", "source").agg(F.sum("total").alias("total")), ["lang", "source"], "left")
              .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")))
    groups = materialise(groups, "groups")
    langs = (groups.groupBy("lang").agg(F.collect_list(F.struct("source", "total")).alias("groups"))    # the sources of a language
             .join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang"))
    entries = counts.groupBy("lang", "page").agg(F.collect_list(F.struct("source", "at", "n")).alias("entries"))
    figures = materialise(entries.join(pages, ["lang", "page"]).join(langs, "lang").drop("page").mapInArrow(_page_rows, _PAGES), "page-figures")

    sums = figures.where("other is not null").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    both = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = both.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    order = [F.desc("value"), F.asc("item")]
    pairs = pairs.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(*order)))
    terms = figures.where("slot is not null").join(slots.drop("lang"), "slot").select("lang", "source", F.col("term").alias("item"), "value")
    terms = top_k(terms, ["lang", "source"], order, TOP, salt=F.col("item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k ON k.lang = o.lang AND k.term = o.term GROUP BY o.lang, o.source, o.term),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * CAST(coalesce(c.n, 0) + 1 AS HUGEINT)) // CAST(g.total + v.v AS HUGEINT) AS HUGEINT) AS p
    FROM gn g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT c.lang, c.term, CAST(1 + (1000000000 * CAST(sum(c.n) + 1 AS HUGEINT)) // CAST(any_value(t.total) + any_value(v.v) AS HUGEINT) AS HUGEINT) AS q
    FROM c JOIN v ON v.lang = c.lang JOIN (SELECT lang, sum(total) AS total FROM gn GROUP BY lang) t ON t.lang = c.lang GROUP BY c.lang, c.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL SELECT p.lang, p.source, 'term', p.term, (p.p - l.q) * (p.p - l.q) // l.q FROM p JOIN l ON l.lang = p.lang AND l.term = p.term WHERE p.n > 0 AND p.p > l.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM x)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
