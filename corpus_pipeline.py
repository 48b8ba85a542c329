"""Corpus pipeline: the documents that are left to train on, and how often.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written
as Parquet and read again as the next stage's documents.

Defined results: null, empty and blank texts fail the quality rules; in the later
stages they are like nothing, overlap with nothing and are taken zero times.  Of
rows that are equal one stays, as of near copies; rows of equal id and other
text, and rows of null id, are documents of their own.  An empty table gives an
empty one; further columns are kept, whatever they are called, but for those the
last stage adds (size, source_size, target, copies, taken).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.decontaminate import without_leaks
from tidewater.llm.jaccard_join import one_of_each
from tidewater.llm.mixing import mixed
from tidewater.llm.quality_rules import accepted
from tidewater.llm.shared import materialise, table
from tidewater.llm.suffix_dedup import without_repeats

#: Near duplicates: shares of this percentage of shingles of so many words.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near duplicates."""
    return one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts byte strings that occur earlier out of the texts; all rows stay."""
    return without_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that overlap with a benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies`` and ``taken`` words."""
    return mixed(docs).where(F.col("copies") > 0)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("benchmark_leaks", benchmark_leaks), ("source_mix", source_mix)]

#: The first stage's forest has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
