"""Total orders without a single-task sort.

Rows are dealt to tasks by ranges of the sort keys, sorted inside each task and
written once; a row's rank is its place in its task's range plus the rows of the
ranges before.  No window runs over more than one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.session import scratch_path

_PLACE_BITS = 33  # monotonically_increasing_id: the task above, the row's place below


def in_order(df: DataFrame, order: Sequence[Column], salt: Column | None = None) -> DataFrame:
    """``df`` dealt by ranges of ``order`` and sorted inside each range.

    Rows with equal keys stay in one range unless ``salt`` tells them apart; it
    must be the same each time a row is computed.
    """
    if salt is None:
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    keys = [*order, F.col("_salt")]
    return df.withColumn("_salt", salt).repartitionByRange(*keys).sortWithinPartitions(
        *keys).drop("_salt")


def ranked(df: DataFrame, order: Sequence[Column], salt: Column | None = None,
           rank: str = "rank") -> DataFrame:
    """``df`` with its 1-based place in ``order`` (ties broken by ``salt``).

    The sorted rows are a table in the shared scratch folder, read back by the
    result; the starts of its ranges (one row per task) are the only join side.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    placed = in_order(df, order, salt).withColumn("_place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path).withColumn(
        "_range", F.shiftright("_place", _PLACE_BITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return rows.join(F.broadcast(starts), "_range").select(
        *df.columns, (F.col("_start") + inside + 1).alias(rank))
