"""Registered plans for document enrichment over ``documents``.

File name = ``<source>/doc-<doc_id>.txt``; every document is a text file
read directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import documents as D
from tidewater.plans.common import LAKE_AS_OF, t


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    d = d.withColumn("file_name", F.concat(F.col("source"), F.lit("/doc-"), F.col("doc_id"), F.lit(".txt")))
    return D.classify_files(d)


def doc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + B17 + B18: type, route, lengths and overflow pointer per file."""
    d = D.extract_text(_docs(spark, sf_dir))
    return d.select("doc_id", "file_name", "file_type", "route", "full_text_length",
                    F.char_length("extracted_text").alias("extracted_length"), "overflow_path")


def doc_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: texts over 5,000 characters with their overflow pointer."""
    d = D.overflow(D.extract_text(_docs(spark, sf_dir)))
    return d.select("doc_id", "overflow_path", "full_text_length")


def doc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: detected language per document and the given one."""
    d = D.detect_language(_docs(spark, sf_dir))
    return d.select("doc_id", "lang", "source_language", "language_hits")


def doc_language_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 check: per labelled language, documents and correct detections."""
    d = D.detect_language(_docs(spark, sf_dir))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"),
                                 F.count_if(F.col("lang") == F.col("source_language")).alias("correct"))


def doc_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: sentiment label and scores per document."""
    d = D.sentiment(_docs(spark, sf_dir))
    return d.select("doc_id", "sentiment", "sentiment_scores.positive", "sentiment_scores.negative",
                    "sentiment_scores.neutral", "sentiment_scores.mixed")


def doc_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + E8: first 20 entities per document, one row each."""
    d = D.entities(_docs(spark, sf_dir))
    return d.select("doc_id", F.posexplode("entities").alias("pos", "e")).select(
        "doc_id", (F.col("pos") + 1).alias("rank"), F.col("e.text").alias("text"),
        F.col("e.type").alias("type"), F.col("e.score").alias("score"))


def doc_key_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + E8: top-20 TF-IDF bigrams per document."""
    return D.key_phrases(_docs(spark, sf_dir))


def doc_translation_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to translate into Spanish."""
    d = D.translation_worklist(D.detect_language(_docs(spark, sf_dir)))
    return d.select("doc_id", "source_language", "target_language",
                    F.char_length("text").alias("chars"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).filter(F.col("route") != "unsupported")
    e = D.entities(D.sentiment(D.detect_language(D.with_tokens(D.extract_text(d)))))
    return D.assemble(e.drop(D.TOKENS), D.key_phrases(d), LAKE_AS_OF)


def doc_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + B24: one flattened result row per file."""
    r = D.to_result_row(_results(spark, sf_dir))
    return r.select("file_name", "processed_at", "file_type", "sentiment", "source_language",
                    F.get_json_object("text", "$.full_text_length").cast("bigint").alias("full_text_length"),
                    F.size(F.from_json("entities", "array<string>")).alias("n_entities"),
                    F.size(F.from_json("key_phrases", "array<string>")).alias("n_phrases"))


def doc_result_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 / F2: the first 100 results by file name."""
    r = D.latest_result(D.to_result_row(_results(spark, sf_dir)))
    return r.select("file_name", "processed_at", "sentiment", "source_language")


def doc_part_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + M1: parts and errors per file, over documents as bytes, of which some
    are missing, some are not UTF-8, some empty and some of a type without reader."""
    d = t(spark, sf_dir, "documents").select("doc_id", "text", "source")
    k = F.col("doc_id") % 20
    content = (F.when(k == 3, F.lit(None).cast("binary")).when(k == 5, F.concat(F.to_binary("text", F.lit("utf-8")), F.unhex(F.lit("C3"))))
               .when(k == 9, F.to_binary(F.lit(""), F.lit("utf-8"))).otherwise(F.to_binary("text", F.lit("utf-8"))))
    name = F.concat(F.col("source"), F.lit("/doc-"), F.col("doc_id"), F.when(k == 7, F.lit(".xyz")).otherwise(F.lit(".txt")))
    r = D.part_results(D.classify_files(d.select("doc_id", name.alias("file_name"), content.alias("content"))))
    return r.select("doc_id", "file_name", "status", F.col("text_part.error").alias("text_error"),
                    F.col("text_part.value.full_text_length").alias("full_text_length"),
                    F.col("analysis_part.error").alias("analysis_error"), F.col("analysis_part.value.sentiment").alias("sentiment"),
                    F.col("translation_part.error").alias("translation_error"),
                    F.col("translation_part.value.source_language").alias("source_language"),
                    F.col("translation_part.value.target_language").alias("target_language"))
