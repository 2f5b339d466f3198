"""Exact dedup by a 128-bit content hash (operator 5).

Rows are grouped by the hash of the whole text; of a group the wanted end of
the ids stays.  Groups of two or more are looked at again: their texts are
compared byte by byte (grouped by the text itself), and the rows of a hash with
several texts (a collision) get a group for each text.

Defined results: a null text counts as empty, so null and empty texts are
equal; rows with the same doc_id and text form one group whose rows are all
marked ``kept`` when that id stays (``keep_first`` then returns one of them); a
null doc_id stays only where its whole group has none; an empty table gives an
empty result; other columns of the input are not read by ``groups_of``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.llm.common import fits, small_side, stored


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def annotated(spark: SparkSession, documents: DataFrame, keep: str = "min",
              content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """Every row of ``documents`` as a struct ``row``, so that its columns may have
    any names, with a struct ``_dedup``: keep_id, group_size, kept, text_sha256."""
    best = {"min": F.min, "max": F.max}[keep]
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = documents.select("doc_id", text.alias("text"), content_hash(text).alias("_h"))

    # pre-aggregated per task, so a hash with a third of the rows is no hot key
    groups = stored(spark, whole.groupBy("_h").agg(
        best("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_size")
    ).filter("_size > 1"), "hash-groups")
    size = groups.count()
    side = small_side(groups, 48, size)

    # bytes inside the groups: distinct per task first, so that a text with a third
    # of the rows arrives once a task; a hash left with several texts is a collision.
    # Too many groups to broadcast: all texts, as a join would bring hot hashes together.
    members = whole.join(side, "_h") if fits(size, 48) else whole
    differ = stored(spark, members.select("_h", "text").distinct().groupBy("_h").agg(
        F.count(F.lit(1)).alias("_texts")).filter("_texts > 1").select("_h"), "collisions")

    rows = documents.select(F.struct("*").alias("row"), content_hash(text).alias("_h"),
                            F.sha2(text.cast("binary"), 256).alias("_sha"))
    out = rows.join(side, "_h", "left")
    if not differ.isEmpty():
        by_text = (whole.join(differ, "_h", "left_semi").groupBy("_h", F.col("text").alias("_text"))
                   .agg(best("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_size")))
        own = F.coalesce(F.col("row.text"), F.lit(""))
        apart = rows.join(differ, "_h", "left_semi").withColumn("_text", own)
        out = out.join(differ, "_h", "left_anti").unionByName(
            apart.join(by_text, ["_h", "_text"]).drop("_text"))
    count = F.coalesce(F.col("_size"), F.lit(1).cast("long"))
    keep_id = F.when(count > 1, F.col("_keep")).otherwise(F.col("row.doc_id"))
    return out.select("row", F.struct(
        keep_id.alias("keep_id"), count.alias("group_size"),
        F.col("row.doc_id").eqNullSafe(keep_id).alias("kept"),
        F.col("_sha").alias("text_sha256")).alias("_dedup"))


def groups_of(spark: SparkSession, documents: DataFrame, keep: str = "min",
              content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    ``keep``: ``min`` or ``max`` of the ids stays.
    """
    rows = documents.select("doc_id", "text")
    return annotated(spark, rows, keep, content_hash).select("row.doc_id", "_dedup.*")


def keep_first(spark: SparkSession, documents: DataFrame, keep: str = "min") -> DataFrame:
    """One row of every distinct text, with the documents' own columns."""
    kept = annotated(spark, documents, keep).filter("_dedup.kept")
    # repeated rows of the id that stays: only groups can have them
    many = kept.filter("_dedup.group_size > 1").select("row", F.col("_dedup.text_sha256").alias("_sha"))
    return kept.filter("_dedup.group_size = 1").select("row.*").unionByName(
        many.dropDuplicates(["_sha"]).select("row.*"))
