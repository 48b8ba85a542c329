"""Divergence audit, Merkle manifest and byte-pair codec against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import DOCS, frame, prose
from tidewater.llm import bpe, divergence, merkle
from tidewater.llm.perfect_hash import Keys, Shards, bounded, build, same
from tidewater.llm.shared import table
from tidewater.llm.textarrays import mix

SF = "/root/testdata/sf0.001"


# Merkle manifest

def plain_tree(leaves, fanout):
    """Root, and each leaf's siblings in order."""
    proofs, level, place = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, at in enumerate(place):
            first = at - at % fanout
            proofs[k] += level[first:at] + level[at + 1:first + fanout]
            place[k] = at // fanout
        level = [hashlib.sha256("".join(level[i:i + fanout]).encode()).hexdigest() for i in range(0, len(level), fanout)]
    return level[0], proofs


def plain_manifest(rows, fanout):
    groups = defaultdict(list)
    for grp, order, leaf in rows:
        groups[(grp is not None, (grp or "").encode())].append(((order is not None, order or 0), leaf))
    names = sorted(groups)
    trees = {g: plain_tree([leaf for _, leaf in sorted(groups[g])], fanout) for g in names}
    root, upper = plain_tree([trees[g][0] for g in names], fanout)
    out = []
    for g, above in zip(names, upper):
        for (order, leaf), proof in zip(sorted(groups[g]), trees[g][1]):
            out.append((order[1] if order[0] else None, leaf, trees[g][0], root, tuple(proof + above)))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout, depth", [(3, 0), (3, 1), (2, 1), (5, 1), (3, 7)])
def test_manifest_equals_plain_trees(spark, fanout, depth):
    rng = random.Random(fanout * 10 + depth)
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "é": 28, "z": 81, "hot": 190}
    rows = [(g, rng.randrange(10_000) if rng.random() > 0.05 else None, f"{rng.randrange(50):064x}") for g, n in sizes.items() for _ in range(n)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "g string, o long, leaf string").repartition(3)
    got = merkle.manifest(df, F.col("leaf"), F.col("g"), F.col("o"), fanout=fanout, depth=depth).collect()
    want = plain_manifest(rows, fanout)
    assert sorted(((r.order_key, r.leaf, r.subroot, r.root, tuple(x for s in r.proof for side in s for x in (side[i:i + 64] for i in range(0, len(side), 64))))
                   for r in got), key=str) == want
    assert all(r.verified and r.folded_root == r.root for r in got)


def test_changed_leaves_do_not_verify(spark):
    rows = [(f"s{k % 3}", k, hashlib.sha256(str(k).encode()).hexdigest()) for k in range(60)]
    df = spark.createDataFrame(rows, "g string, o long, leaf string")
    changed = F.when(F.col("o") % 7 == 0, F.sha2(F.col("leaf"), 256))
    got = merkle.manifest(df, F.col("leaf"), F.col("g"), F.col("o"), changed, depth=1).collect()
    assert {r.order_key for r in got if not r.verified} == {k for k in range(60) if k % 7 == 0}


def test_manifest_of_nulls_copies_and_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], "g string, o long, leaf string"), F.col("leaf"), F.col("g"), F.col("o")).collect() == []
    clash = spark.createDataFrame([(None, None, "00" * 32, 1, "x")] * 3, "g string, o long, leaf string, pos int, grp string")
    got = merkle.manifest(clash, F.col("leaf"), F.col("g"), F.col("o"))
    assert got.count() == 3 and got.where("verified").count() == 3


# Divergence audit

def test_perfect_hash_is_minimal_and_finds_only_its_keys():
    words = [f"w{i}".encode() for i in range(5000)] + [b"x" * 200, b"x" * 201]
    ends = np.cumsum([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    keys = Keys(data, ends - [len(w) for w in words], ends)
    h = mix(np.arange(len(words), dtype=np.uint64) + np.uint64(7))
    sizes, bits, order = build(h)
    assert sorted(order.tolist()) == list(range(len(words))) and int(bits.sum()) == len(words)
    flat, at = bounded(keys.take(order)).packed()
    shards = Shards([(sizes, np.packbits(bits), len(words))], Keys(flat, at[:-1], at[1:]))
    zero = np.zeros(len(words), np.int64)
    slots = shards.slots(zero, h, bounded(keys))
    assert (order[slots] == np.arange(len(words))).all()
    wrong = np.roll(np.arange(len(words)), 1)          # the right hash, another key
    assert (shards.slots(zero, h, bounded(keys.take(wrong))) == -1).all()
    assert (shards.slots(zero, mix(h), bounded(keys)) >= 0).sum() == 0


def test_keys_of_equal_hash_are_told_apart():
    words = [b"aa", b"bb", b"cc", b"dd"]
    keys = Keys(np.frombuffer(b"".join(words), np.uint8), np.arange(0, 8, 2), np.arange(2, 9, 2))
    h = np.array([5, 5, 5, 9], np.uint64)
    sizes, bits, order = build(h)
    assert int(bits.sum()) == 1 and len(order) == 4
    flat, at = keys.take(order).packed()
    shards = Shards([(sizes, np.packbits(bits), 4)], Keys(flat, at[:-1], at[1:]), {1: 5, 2: 5, 3: 5})
    assert (order[shards.slots(np.zeros(4, np.int64), h, keys)] == np.arange(4)).all()
    assert same(keys, keys).all() and not same(keys, keys.take(np.array([1, 0, 3, 2]))).any()


def plain_divergence(rows, min_docs):
    """(lang, source, part, item, value) by dictionaries."""
    import re

    seen, counts = defaultdict(set), defaultdict(Counter)
    for doc, (lang, source, text) in enumerate(rows):
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(words)
        for w in words:
            seen[lang, w].add(doc)
    kept = defaultdict(list)
    for (lang, w), docs in seen.items():
        if len(docs) >= min_docs:
            kept[lang].append(w)

    def shares(counter, lang):
        v = kept[lang]
        n = sum(counter[w] for w in v)
        return {w: 1 + 1_000_000_000 * (counter[w] + 1) // (n + len(v)) for w in v}

    out = []
    for lang in {k for k, _ in counts}:
        own = {s: c for (k, s), c in counts.items() if k == lang}
        p = {s: shares(c, lang) for s, c in own.items()}
        q = shares(sum(own.values(), Counter()), lang)
        for s, c in own.items():
            pairs = [(t, sum((p[s][w] - p[t][w]) ** 2 // p[t][w] for w in kept[lang])) for t in own if t != s]
            terms = [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept[lang] if c[w] and p[s][w] > q[w]]
            for part, rows_, top in (("pair", pairs, len(pairs)), ("term", terms, 200)):
                ranked = sorted(rows_, key=lambda x: (-x[1], x[0].encode()))[:top]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(11)
    alphabet = ["en", "de", "Été", "naïve", "日本", "x" * 70, "x" * 71] + [f"t{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    rows = [(rng.choice(["en", "de", "", None]), rng.choice(["en", "s1", "s2", None, ""]),
             " ".join(rng.choice(alphabet) + rng.choice(["", ".", "9", "_"]) for _ in range(rng.randrange(0, 120)))) for _ in range(150)]
    return rows + rows[:20] + [("en", "mute", None), ("xx", "a", "once"), ("xx", "b", ""), ("yy", "only", "a a a")]


@pytest.mark.parametrize("shard, broadcast", [(1 << 16, 1 << 21), (40, 150)])
def test_divergence_equals_plain_counts(spark, spoken, shard, broadcast):
    df = spark.createDataFrame(spoken, "lang string, source string, text string").withColumn("slot", F.lit("clash")).repartition(4)
    got = divergence.divergences(df, 3, shard, broadcast).collect()
    assert sorted(map(tuple, got)) == plain_divergence(spoken, 3)


def test_divergence_of_empty_and_termless_tables(spark):
    assert divergence.divergences(spark.createDataFrame([], "lang string, source string, text string")).collect() == []
    got = divergence.divergences(spark.createDataFrame([("a", "x", "1 2"), ("a", "y", None)], "lang string, source string, text string")).collect()
    assert sorted(map(tuple, got)) == [("a", "x", "pair", "y", 0, 1), ("a", "y", "pair", "x", 0, 1)]


def test_counters_are_handed_out_when_full():
    class Fixed:
        def width(self, lang):
            return 0, 100, 1000

    counters = divergence.Counters(Fixed(), limit=150)
    out = list(counters.add("a", "s", np.array([3, 3, 5]), 1))
    out += list(counters.add("a", "t", np.array([7]), np.array([4])))
    assert len(out) == 1
    out += list(counters.flush())
    rows = sorted((r["source"], r["page"] * divergence.PAGE + int(k), int(n)) for b in out for r in b.to_pylist()
                  for k, n in zip(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["n"], np.int64)))
    assert rows == [("s", 1003, 2), ("s", 1005, 1), ("t", 1007, 4)]


def test_chunks_of_a_task_are_combined(monkeypatch):
    texts = [["a b a", None], ["b c", "a"], ["c c", "d"], ["d a", "b"]]
    batches = [pa.RecordBatch.from_arrays([pa.array(["x", "y" if k % 2 else "x"]), pa.array(t, pa.string())], names=["lang", "text"]) for k, t in enumerate(texts)]
    docs = [("x" if i == 0 or k % 2 == 0 else "y", (t or "").split()) for k, two in enumerate(texts) for i, t in enumerate(two)]
    want = {(lang, w): [sum(w in ws for at, ws in docs if at == lang), sum(ws.count(w) for at, ws in docs if at == lang)]
            for lang in "xy" for w in "abcd"}
    for held in (1, 4, 1 << 20):
        monkeypatch.setattr(divergence, "_HELD", held)
        sums = defaultdict(lambda: [0, 0])
        for b in divergence._document_counts(iter(batches)):
            for r in b.to_pylist():
                sums[r["lang"], r["term"]][0] += r["df"]
                sums[r["lang"], r["term"]][1] += r["n"]
        assert sums == {k: v for k, v in want.items() if v[0]}


def test_shares_are_exact():
    rng = random.Random(2)
    for _ in range(500):
        of = rng.randrange(1, 9 * 10 ** 15)
        n = rng.randrange(0, of + 1)
        assert int(divergence.share(np.array([n]), np.array([of]))[0]) == 1 + 10 ** 9 * n // of


# Byte pairs

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path(bpe.VOCABULARY), encoding="utf-8") as f:
        return bpe.read_vocabulary(f.read())


PIECES = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "'s", "'LL", "1", "23", "é", "日本", "<|endoftext|>", "<|endo", " ", "\x1c", "\x85",
          "՘", "Ᲊ", "࢏", "\U0003d000", "👩‍👩", "!", "..", "x" * 40, "\x00", "�"]


@pytest.mark.parametrize("short, window", [(bpe.SHORT, bpe.WINDOW), (3, 5)])
def test_encoding_equals_library(library, vocabulary, short, window):
    rng, encoder = random.Random(short), bpe.Encoder(vocabulary, short, window)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 30))) for _ in range(1500)]
    texts += ["".join(rng.choice("abcdehinst") for _ in range(20_000)), "a" * 3000, " " * 5000 + "x"]
    ids = encoder.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.decode(x) for x in ids] == texts


def test_decoding_any_ids_equals_library(library, vocabulary):
    rng, encoder = random.Random(4), bpe.Encoder(vocabulary)
    for _ in range(500):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(0, 12))]
        assert encoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_pieces_equal_library_for_every_character(library, vocabulary):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    pieces = bpe.Pieces(*vocabulary.newer)
    for i in range(0, len(chars), 997):
        text = "".join(f"a{c}1{c} {c}!" for c in chars[i:i + 997])
        assert pieces(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_encoded_keeps_rows_and_columns(spark, edge_rows):
    vocabulary = bpe.load(spark, public_tokenizers.path(bpe.VOCABULARY))
    rows = edge_rows + [(90, prose(random.Random(1), 30_000))]
    docs = frame(spark, rows).withColumn("ids", F.lit("clash"))
    both = bpe.decoded(bpe.encoded(docs, vocabulary), vocabulary)
    assert both.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "decoded"]
    got = both.select("doc_id", "decoded").collect()
    assert sorted(map(str, got)) == sorted(str((k, t or "")).replace("(", "Row(doc_id=", 1).replace(", ", ", decoded=", 1) for k, t in rows)
    assert bpe.encoded(spark.createDataFrame([], DOCS), vocabulary).collect() == []


def test_codec_query_equals_library(spark, library):
    got = {r.doc_id: r for r in bpe.op13_bpe(spark, SF).collect()}
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
