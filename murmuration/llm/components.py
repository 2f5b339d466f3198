"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.llm.common import discard, stored


def _star(edges: DataFrame) -> DataFrame:
    """Link every neighbour of a node to the least of its neighbours and itself.

    The least ones are aggregated per task first; Spark broadcasts them by its
    size threshold or splits the edges of a hub as a skewed join.
    """
    return edges.join(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "u")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, comp) for the ends of ``edges`` (a, b); comp is the least id reachable.

    Each round writes its two tables in the shared folder and drops those it has
    read; the state is the edge table, so memory does not grow with a component.
    """
    now = stored(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        mid = stored(spark, large.filter("u <> v").distinct(), "large")
        small = _star(mid)
        linked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v")))
        before, now = now, stored(spark, linked.filter("u <> v").distinct(), "small")
        discard(before, mid)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(
        roots.select("id", F.col("id").alias("comp")))
