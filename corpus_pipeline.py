"""The corpus pipeline: documents to packed sequences, one operator a stage.

Each stage is a function of (spark, docs, sf_dir).  All but the last return the
columns of ``documents``; a stage's result is written as Parquet in the shared
folder and read again as the next one's ``docs``, so a lost executor repeats
work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from murmuration.llm import exact, langid, neardup, packing, quality
from murmuration.llm.common import small_side, stored, table


#: Documents whose sets of five-word shingles are as similar, in percent, are one.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.keep_identified(spark, docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text, the one with the smallest id."""
    return exact.keep_first(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest id.

    Documents without an id are linked with nothing, so they stay.
    """
    found = neardup.near_duplicates(spark, docs.select("doc_id", "text"), percent=NEAR_PERCENT)
    gone = small_side(stored(spark, found.filter("NOT kept").select("doc_id").distinct(),
                             "near-copies"), 8)
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")  # whatever other columns are called


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and offset."""
    return packing.pack(spark, docs)


STAGES = [("quality_rules", quality_rules), ("language_id", language_id),
          ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", pack)]

#: Training a network and solving a linear program are not SQL; tests compare
#: the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
