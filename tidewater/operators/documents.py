"""Corpus-scale document annotation.

The reference calls managed language services per file.  Here the same
result shape comes from token / lexicon computations that Spark runs over the
whole corpus; the scores are this library's own definitions (stop-word
language vote, lexicon sentiment, TF-IDF bigram key phrases, pattern
entities), not a model's.

Per-document work (tokenising, lexicon hits, entity patterns) uses
higher-order functions inside the row -- no explode, no shuffle; lexicon
membership compiles to a hash-set lookup.  Phrases are counted by Arrow and
numpy over columns of token lists.  Only the key-phrase IDF needs
corpus statistics and therefore a shuffle.  Whole texts are analysed; the
5,000-character cut applies only to the stored ``extracted_text``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from datetime import datetime
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import file_extension, lit_ts, once
from tidewater.operators import keyed
from tidewater.session import shuffles_freed, stored

TEXT_LIMIT = 5000
TOP_N = 20
TARGET_LANGUAGE = "es"
# File types with text extraction; ``txt`` is read directly.
SUPPORTED_TYPES = ["pdf", "png", "jpg", "jpeg", "txt"]
OCR_TYPES = ["pdf", "png", "jpg", "jpeg"]

# Function words per language for the language vote (this
# library's own lists).
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "in", "is", "that", "it", "for", "with", "as", "was", "on",
           "are", "by", "this", "be", "from", "at", "an"],
    "fr": ["le", "la", "les", "des", "et", "est", "un", "une", "du", "que", "qui", "dans", "pour",
           "pas", "en", "au", "avec", "ce", "sur", "aux"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den", "mit", "von",
           "sich", "des", "auf", "für", "im", "dem", "auch", "es"],
    "es": ["el", "los", "las", "del", "y", "es", "un", "una", "que", "en", "por", "con", "para",
           "se", "lo", "como", "al", "su", "más", "pero"],
}
LANGUAGE_ORDER = ["en", "fr", "de", "es"]

# Sentiment lexicon (this library's own lists).
POSITIVE_WORDS = ["good", "great", "excellent", "happy", "love", "best", "wonderful", "nice",
                  "perfect", "fine", "bon", "bonne", "heureux", "gut", "toll", "bueno", "buena",
                  "feliz", "excelente", "super"]
NEGATIVE_WORDS = ["bad", "worthless", "terrible", "awful", "poor", "worst", "hate", "sad", "wrong",
                  "broken", "mauvais", "triste", "nul", "schlecht", "schrecklich", "malo", "mala",
                  "horrible", "useless", "fail"]

# Entity patterns, tried left to right at each position, and
# the confidence reported for each entity type.
ENTITY_PATTERN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
                  r"|[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
                  r"|[0-9]{4}-[0-9]{2}-[0-9]{2}"
                  r"|[0-9]+(?:[.,][0-9]+)?")
ENTITY_TYPES = [("EMAIL", r"^.*@.*$", 0.99),
                ("IP_ADDRESS", r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$", 0.95),
                ("DATE", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", 0.9),
                ("QUANTITY", r"^.*$", 0.8)]


def _split(text: Column) -> Column:
    """Lower-cased letter runs of the whole text; the first and last may be empty."""
    return F.split(F.lower(text), r"[^\p{L}]+")


def tokens(text: Column) -> Column:
    """Lower-cased letter runs of the whole text."""
    return F.array_remove(_split(text), "")


TOKENS = "_tokens"


def with_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the token list once, for the steps that read it."""
    return df if TOKENS in df.columns else df.withColumn(TOKENS, tokens(F.col(text)))


def _own_tokens(df: DataFrame, out: DataFrame) -> DataFrame:
    """``out`` without the token list, unless ``df`` brought it."""
    return out if TOKENS in df.columns else out.drop(TOKENS)


def classify_files(df: DataFrame, name: str = "file_name") -> DataFrame:
    """``file_type`` (lower-cased extension) and ``route``:
    ``direct_read`` for txt, ``ocr`` for scanned types, ``unsupported``."""
    ext = file_extension(name)
    route = (F.when(ext == "txt", F.lit("direct_read"))
             .when(ext.isin(*OCR_TYPES), F.lit("ocr"))
             .otherwise(F.lit("unsupported")))
    return df.withColumns({"file_type": ext, "route": route})


def extract_text(df: DataFrame, name: str = "file_name", text: str = "text") -> DataFrame:
    """K1 + B18 + A10 pointer: ``extracted_text`` (first 5,000 chars),
    ``full_text_length`` and ``overflow_path`` for longer texts."""
    length = F.char_length(text)
    return df.withColumns({
        "extracted_text": F.left(F.col(text), F.lit(TEXT_LIMIT)),
        "full_text_length": length,
        "text_source": F.lit("direct_read"),
        "overflow_path": F.when(length > TEXT_LIMIT,
                                F.concat(F.lit("overflow/"), F.col(name), F.lit("_full_text.txt"))),
    })


def overflow(df: DataFrame) -> DataFrame:
    """A10: the side table of full texts over the limit."""
    return df.filter(F.col("overflow_path").isNotNull())


def write_overflow(df: DataFrame, root: str) -> None:
    """A10 sink: full texts as one text dataset keyed by the pointer."""
    overflow(df).select("overflow_path", "text").write.mode("overwrite").parquet(root)


def _hits(tok: Column, words: list[str]) -> Column:
    return F.size(F.filter(tok, lambda x: x.isin(*words)))


def _listed(tok: Column, lists: Iterable[list[str]]) -> Column:
    """The tokens that are in one of the lists, so that others are looked up once."""
    return F.filter(tok, lambda x: x.isin(*sorted({w for ws in lists for w in ws})))


def language_votes(tok: Column) -> dict[str, Column]:
    return {lang: _hits(tok, STOP_WORDS[lang]) for lang in LANGUAGE_ORDER}


def detect_language(df: DataFrame, text: str = "text") -> DataFrame:
    """K2: the language with most function-word hits (ties: order
    en, fr, de, es); ``und`` when none.  Adds ``source_language`` and
    ``language_hits``."""
    votes = language_votes(F.col("_listed"))
    cand = F.array(*[F.struct(votes[l].alias("hits"), F.lit(len(LANGUAGE_ORDER) - i).alias("prio"),
                              F.lit(l).alias("lang"))
                     for i, l in enumerate(LANGUAGE_ORDER)])
    listed = with_tokens(df, text).withColumn("_listed", _listed(F.col(TOKENS), STOP_WORDS.values()))
    voted = listed.withColumn("_best", F.array_max(cand)).drop("_listed")
    best = F.col("_best")
    return _own_tokens(df, voted.withColumns({
        "source_language": F.when(best.hits > 0, best.lang).otherwise(F.lit("und")),
        "language_hits": best.hits,
    }).drop("_best"))


def sentiment(df: DataFrame, text: str = "text") -> DataFrame:
    """K3: label and ``{positive, negative, neutral, mixed}`` scores from
    lexicon hits over all tokens."""
    tok = F.col("_listed")
    listed = with_tokens(df, text).withColumn("_listed", _listed(F.col(TOKENS), [POSITIVE_WORDS, NEGATIVE_WORDS]))
    counted = listed.withColumns({
        "_n": F.size(TOKENS), "_pos": _hits(tok, POSITIVE_WORDS), "_neg": _hits(tok, NEGATIVE_WORDS)}).drop("_listed")
    n, pos, neg = F.col("_n"), F.col("_pos"), F.col("_neg")
    frac = lambda c: F.when(n > 0, c.cast("double") / n).otherwise(F.lit(0.0))
    label = (F.when((pos > 0) & (pos == neg), F.lit("MIXED"))
             .when(pos > neg, F.lit("POSITIVE"))
             .when(neg > pos, F.lit("NEGATIVE"))
             .otherwise(F.lit("NEUTRAL")))
    scores = F.struct(frac(pos).alias("positive"), frac(neg).alias("negative"),
                      frac(n - pos - neg).alias("neutral"), frac(F.least(pos, neg)).alias("mixed"))
    out = counted.withColumns({"sentiment": label, "sentiment_scores": scores}).drop("_n", "_pos", "_neg")
    return _own_tokens(df, out)


def entities(df: DataFrame, text: str = "text") -> DataFrame:
    """K5 + E8: the first 20 pattern entities in text order as
    ``array<struct<text, type, score>>`` (bounded per row)."""
    found = F.regexp_extract_all(F.col(text), F.lit(ENTITY_PATTERN), 0)

    def typed(m):
        t = None
        for name, pat, _ in ENTITY_TYPES:
            t = F.when(m.rlike(pat), F.lit(name)) if t is None else t.when(m.rlike(pat), F.lit(name))
        s = None
        for name, _, score in ENTITY_TYPES:
            s = F.when(t == name, F.lit(score)) if s is None else s.when(t == name, F.lit(score))
        return F.struct(m.alias("text"), t.alias("type"), s.alias("score"))
    return df.withColumn("entities", F.transform(F.slice(found, 1, TOP_N), typed))


# Function words of all languages: no phrase holds one.
_STOP = sorted({w for ws in STOP_WORDS.values() for w in ws})
# Tokens of the documents of a page, about, and the parts its phrases are dealt out in.
_PIECE, _PARTS = 1 << 20, 1024
_PAGE = "page long, docs long, ids array<{}>, words string, n long, packed binary"


def _packed(*arrays: np.ndarray) -> bytes:
    """Numbers below 2**32, their bytes by place, as those of a place are alike."""
    planes = [np.ascontiguousarray(a, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, *sizes: int) -> list[np.ndarray]:
    raw, out = np.frombuffer(pa.decompress(packed, 4 * sum(sizes), codec="zstd", asbytes=True), np.uint8), []
    for n in sizes:
        out.append(np.ascontiguousarray(raw[:4 * n].reshape(4, n).T).view("<u4").ravel())
        raw = raw[4 * n:]
    return out


def _counted(ids: pa.Array, tok: pa.ListArray) -> list[pa.Array]:
    """A page of some rows: adjacent pairs of their tokens without function words,
    each once a row with its count, in the order of the row and the phrase.

    Words are numbered in their order, so phrases are in that of their numbers; a blank
    comes before all letters.
    """
    codes = tok.flatten().dictionary_encode()
    words, code = codes.dictionary, codes.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(tok)), pc.fill_null(pc.list_value_length(tok), 0).to_numpy())
    plain = pc.invert(pc.is_in(words, pa.array([*_STOP, ""], words.type))).to_numpy(zero_copy_only=False)
    plain = plain[code] if len(code) else np.zeros(0, bool)
    at = np.flatnonzero(plain[:-1] & plain[1:] & (row[:-1] == row[1:]))
    used = np.unique(np.concatenate([code[at], code[at + 1]]))
    kept = words.take(pa.array(used))
    order = pc.array_sort_indices(kept)
    number = np.zeros(len(words), np.int64)
    number[used[order.to_numpy()]] = np.arange(len(used))
    keys = row[at], number[code[at]], number[code[at + 1]]
    order_of = np.lexsort(keys[::-1])
    keys = [k[order_of] for k in keys]
    new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])[:len(at)]
    first = np.flatnonzero(new)
    row, one, two = (k[first] for k in keys)
    # What grows within the page is kept as its steps.
    packed = _packed(np.bincount(row, minlength=len(tok)), np.diff(one, prepend=0) % (1 << 32), two, np.diff(np.append(first, len(at))))
    listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return [pa.array([len(tok)]), listed, pa.array([" ".join(kept.take(order).to_pylist())]), pa.array([len(first)]), pa.array([packed], pa.binary())]


def _phrase_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of (id, tokens) rows, about ``_PIECE`` tokens each."""
    page = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids, tok = batch.columns
        ends = np.cumsum(pc.fill_null(pc.list_value_length(tok), 0).to_numpy())
        cuts = np.flatnonzero(np.diff(ends // _PIECE, prepend=0))
        for i, j in pairwise([0, *cuts, len(batch)]):
            if j > i:
                columns = [pa.array([page]), *_counted(ids.slice(i, j - i), tok.slice(i, j - i))]
                yield pa.RecordBatch.from_arrays(columns, names=["page", "docs", "ids", "words", "n", "packed"])
                page += 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the numbers spread over all of them, one to one."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class _Page:
    """A stored page: its phrases, and the different ones by part and hash."""

    def __init__(self, docs: int, words: str, n: int, packed: bytes):
        self.words = words.split()
        self.sizes, one, self.two, self.tf = _unpacked(packed, docs, n, n, n)
        self.one = np.cumsum(one, dtype=np.uint32)
        digests = b"".join(hashlib.blake2b(w.encode(), digest_size=16).digest() for w in self.words)
        low, high = np.frombuffer(digests, "<u8").reshape(-1, 2).T
        pair = self.one.astype(np.int64) * len(self.words) + self.two
        pair, self.which, self.held = np.unique(pair, return_inverse=True, return_counts=True)
        one, two = np.divmod(pair, max(1, len(self.words)))
        # 64 and 32 bits of hash, and the part by others.
        low, high = (_mixed(h[one] + _mixed(h[two] + np.uint64(0x9E3779B97F4A7C15))) for h in (low, high))
        part = (high >> np.uint64(32)).astype(np.int64) % _PARTS
        self.order = np.lexsort((low, part))
        self.low, self.high = low[self.order], high[self.order].astype("<u4")
        self.starts = np.searchsorted(part[self.order], np.arange(_PARTS + 1))


def _hash_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, page, hashes, held): the hashes of a part of each page, and of how many documents."""
    for batch in batches:
        for page, docs, words, n, packed in zip(*(c.to_pylist() for c in batch.columns)):
            p = _Page(docs, words, n, packed)
            held = p.held[p.order].astype("<u4")
            parts = np.flatnonzero(np.diff(p.starts))
            spans = [slice(p.starts[k], p.starts[k + 1]) for k in parts]
            columns = [pa.array(parts, pa.int32()), pa.array([page] * len(parts), pa.int64()),
                       pa.array([p.low[x].tobytes() + p.high[x].tobytes() for x in spans], pa.binary()),
                       pa.array([held[x].tobytes() for x in spans], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "page", "hashes", "held"])


def _summed(part: int, pages: list[int], hashes: list[bytes], held: list[bytes]) -> pa.RecordBatch:
    """Of all hashes of a part the documents they are in, in the places of the hashes."""
    sizes = [len(h) // 4 for h in held]
    low = np.concatenate([np.frombuffer(h, "<u8", n) for h, n in zip(hashes, sizes)])
    high = np.concatenate([np.frombuffer(h, "<u4", n, 8 * n) for h, n in zip(hashes, sizes)])
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    sums = np.add.reduceat(np.frombuffer(b"".join(held), "<u4")[order].astype(np.int64), np.flatnonzero(new))
    df = np.empty(len(order), np.int64)
    df[order] = sums[np.cumsum(new) - 1]
    own = np.split(df, np.cumsum(sizes)[:-1])
    return pa.RecordBatch.from_arrays(
        [pa.array(pages, pa.int64()), pa.array([part] * len(pages), pa.int32()), pa.array([x.max() for x in own], pa.int64()),
         pa.array([x.astype("<u4").tobytes() for x in own], pa.binary())], names=["page", "part", "df", "counts"])


def _part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_summed`` of rows that are sorted by part; one part is held at a time."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for part, own in groupby(rows, key=lambda r: r[0]):
        _, *columns = zip(*own)
        yield _summed(part, *map(list, columns))


def _leading(p: _Page, df: np.ndarray, n_docs: int) -> np.ndarray:
    """Rows of a page that may be among the ``TOP_N`` of their documents.

    Their scores are worked out and ranked by Spark, whose logarithm may differ from
    this one in its last digits; so all rows about as good as the last are taken, but
    of equal count and frequency only the first by phrase.
    """
    row = np.repeat(np.arange(len(p.sizes)), p.sizes)
    score = p.tf * np.log(n_docs / df)
    order = np.lexsort((p.tf, -score, row))         # stable, so by phrase where all are equal
    row, score, tf = row[order], score[order], p.tf[order]
    place, starts = np.arange(len(order)), np.cumsum(p.sizes, dtype=np.int64) - p.sizes
    last = score[np.minimum(starts + TOP_N, starts + p.sizes)[p.sizes > 0] - 1]
    least = np.repeat(last * (1 - 1e-9), p.sizes[p.sizes > 0])
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (score[1:] != score[:-1]) | (tf[1:] != tf[:-1])])[:len(order)]
    alike = place - np.maximum.accumulate(np.where(new, place, 0))
    return np.sort(order[(score >= least) & (alike < TOP_N)])


def _leading_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, phrase, tf, df) of pages with the counts found of their parts."""
    for batch in batches:
        for docs, ids, words, n, packed, found, n_docs in zip(*batch.columns):
            p = _Page(docs.as_py(), words.as_py(), n.as_py(), packed.as_py())
            df = np.ones(len(p.order), np.int64)
            for part, counts in zip(*(found.values.field(k).to_pylist() for k in ("part", "counts"))) if found.is_valid else ():
                df[p.order[p.starts[part]:p.starts[part + 1]]] = np.frombuffer(counts, "<u4")
            df = df[p.which]
            best = _leading(p, df, n_docs.as_py())
            row = np.repeat(np.arange(len(p.sizes)), p.sizes)[best]
            all_words = pa.array(p.words, pa.string())
            phrase = pc.binary_join_element_wise(all_words.take(pa.array(p.one[best])), all_words.take(pa.array(p.two[best])), " ")
            yield pa.RecordBatch.from_arrays([ids.values.take(pa.array(row)), phrase, pa.array(p.tf[best].astype(np.int64)), pa.array(df[best])],
                                             names=["id", "phrase", "tf", "df"])


def key_phrases(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """K4 + E8: top-20 bigrams per document by TF-IDF over the corpus.

    Rows ``(doc_id, rank, phrase, score)``.  Counts within a document need no
    shuffle: they are made from its row, by Arrow in the task, and stored as pages of
    about a million tokens.  For the document frequencies a page's phrases are shuffled
    as hashes, each once a page, and their counts travel back to the page by place; no
    phrase is shuffled but those that may be among the first of their document.  A
    frequent phrase is one hash a page, so none is skewed.
    """
    spark = docs.sparkSession
    listed = docs.select(F.col(doc_id).alias("id"), F.col(TOKENS) if TOKENS in docs.columns else _split(F.col(text)).alias(TOKENS))
    kind = listed.schema["id"].dataType.simpleString()
    # Read twice, for the frequencies and for the scores; tokenised once.
    pages = stored(listed.mapInArrow(_phrase_pages, _PAGE.format(kind)), "phrase-pages")
    # Phrases meet by 96 bits of hash within a part.
    hashes = pages.select("page", "docs", "words", "n", "packed").mapInArrow(_hash_parts, "part int, page long, hashes binary, held binary")
    dealt = hashes.repartition("part").sortWithinPartitions("part")
    with shuffles_freed(spark):
        counts = stored(dealt.mapInArrow(_part_sums, "page long, part int, df long, counts binary"), "phrase-frequencies")
    found = counts.filter(F.col("df") > 1).groupBy("page").agg(F.collect_list(F.struct("part", "counts")).alias("found"))
    # Corpus size as a scalar subquery (one value, no join).
    n_docs = pages.select(F.sum("docs")).scalar()
    counted = pages.join(found, "page", "left").select("docs", "ids", "words", "n", "packed", "found", n_docs.alias("n_docs"))
    leading = counted.mapInArrow(_leading_phrases, f"id {kind}, phrase string, tf long, df long")
    scored = leading.select(F.col("id").alias(doc_id), "phrase", (F.col("tf") * F.log(n_docs / F.col("df"))).alias("_s"))
    # One ranking pass: a group is what is left of one document.  The rows are dealt
    # out first, as otherwise they would be sorted before the shuffle, too.
    top = keyed.top_k(scored.repartition(doc_id), [doc_id], [F.col("_s").desc(), F.col("phrase")], TOP_N)
    return top.select(doc_id, "rank", "phrase", F.round("_s", 6).alias("score"))


def translation_worklist(df: DataFrame, targets: tuple[str, ...] = (TARGET_LANGUAGE,)) -> DataFrame:
    """One translation job per (document, target language) where the
    detected language is known and differs from the target."""
    jobs = once(df).withColumn("target_language", F.explode(F.array(*[F.lit(x) for x in targets])))
    return jobs.filter((F.col("source_language") != "und") & (F.col("target_language") != F.col("source_language")))


def assemble(docs: DataFrame, phrases: DataFrame, as_of: str | datetime,
             doc_id: str = "doc_id") -> DataFrame:
    """K6: one result row per file; ``key_phrases`` (<= 20 per document)
    joined on the document id; documents without phrases get []."""
    per_doc = (phrases.groupBy(doc_id)
               .agg(F.array_sort(F.collect_list(F.struct("rank", "phrase", "score"))).alias("_kp")))
    out = docs.join(per_doc, doc_id, "left")
    kp = F.coalesce(F.transform("_kp", lambda x: F.struct(x.phrase.alias("text"), x.score.alias("score"))),
                    F.array().cast("array<struct<text:string,score:double>>"))
    return out.withColumns({
        "processed_at": F.date_format(lit_ts(as_of), "yyyy-MM-dd'T'HH:mm:ss"),
        "key_phrases": kp,
        "text_info": F.struct(F.col("extracted_text"), F.col("full_text_length"),
                              F.col("text_source").alias("source"), F.col("overflow_path")),
    }).drop("_kp")


def read_contents(files: DataFrame, content: str = "content") -> DataFrame:
    """K1 for raw bytes: ``text``, and ``text_error`` where there is none.

    ``files`` are ``classify_files`` rows with the bytes of each file; no file
    makes the job fail: what can't be read has a null text and its reason.
    """
    text = F.try_validate_utf8(F.col(content).cast("string"))
    direct = F.col("route") == "direct_read"
    read = once(files.withColumn("text", F.when(direct, text)))
    return read.withColumn("text_error", F.when(~direct, F.concat(F.lit("no reader for "), F.col("file_type")))
                           .when(F.col(content).isNull(), F.lit("no content"))
                           .when(F.col("text").isNull(), F.lit("invalid UTF-8")))


def _part(value: Column, error: Column) -> Column:
    """One part of a result: its value, or why it has none."""
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))


def part_results(files: DataFrame, content: str = "content") -> DataFrame:
    """K6 + M1: one row per file with a part for its text, its analysis and its
    translation job, each ``struct<value, error>``.

    A failed part leaves the others as they are; a part that needs the text of
    a file without one is null, as it wasn't tried.  An empty text can't be
    analysed, and a text of unknown language can't be translated; one in the
    target language needs no job, which is no error.  ``status`` is ``ERROR``
    if the text failed, ``PARTIAL`` if another part did, else ``PROCESSED``.
    """
    read = extract_text(with_tokens(read_contents(files, content)))
    done = entities(sentiment(detect_language(read))).drop(TOKENS)
    have, blank = F.col("text_error").isNull(), F.col("text") == ""
    text = _part(F.struct("extracted_text", "full_text_length", "overflow_path"), F.col("text_error"))
    analysis = _part(F.struct("sentiment", "sentiment_scores", "entities"), F.when(blank, F.lit("empty text")))
    target = F.when(F.col("source_language") != TARGET_LANGUAGE, F.lit(TARGET_LANGUAGE))
    job = _part(F.struct("source_language", target.alias("target_language")),
                F.when(blank, F.lit("empty text")).when(F.col("source_language") == "und", F.lit("language not detected")))
    parts = done.withColumns({"text_part": text, "analysis_part": F.when(have, analysis), "translation_part": F.when(have, job)})
    status = (F.when(~have, F.lit("ERROR"))
              .when(F.coalesce("analysis_part.error", "translation_part.error").isNotNull(), F.lit("PARTIAL"))
              .otherwise(F.lit("PROCESSED")))
    return parts.select(*files.columns, "text_part", "analysis_part", "translation_part", status.alias("status")).drop(content)


def to_result_row(df: DataFrame) -> DataFrame:
    """Flatten for a key-value store: nested values as JSON text."""
    return df.select(
        "file_name", "processed_at", "file_type",
        F.to_json("text_info").alias("text"),
        "sentiment",
        F.to_json("sentiment_scores").alias("sentiment_scores"),
        F.to_json("entities").alias("entities"),
        F.to_json("key_phrases").alias("key_phrases"),
        "source_language",
    )


def latest_result(results: DataFrame, file_name: str | None = None, limit: int = 100) -> DataFrame:
    """K7: the newest result of one file, else the first ``limit`` results
    by file name (F2)."""
    if file_name:
        one = results.filter(F.col("file_name") == file_name)
        return keyed.latest(one, "file_name", ["processed_at"])
    return results.orderBy("file_name", "processed_at").limit(limit)

