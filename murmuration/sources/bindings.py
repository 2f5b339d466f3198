"""Canonical views: the social tables and the point set bound to the driver's
TPC-H-like parquet tables (SURVEY §2A-detail).

Each view is a lazy projection / filter of a parquet scan, so Catalyst pushes
the filters into the scan and reads only the referenced columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ten start centers of the reference's centers file, in
# file order; center ids 0..9 follow that order.
START_CENTERS = [
    (3550, 2599), (2140, 2212), (3640, 866), (4278, 1659), (267, 4879),
    (1653, 2185), (1901, 3101), (1303, 900), (1580, 4996), (1647, 3755),
]


def start_centers() -> list[tuple[int, int, int]]:
    return [(i, x, y) for i, (x, y) in enumerate(START_CENTERS)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_key() -> F.Column:
    return F.get_json_object(F.col("props"), "$.k").cast(T.LongType())


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation: person_id, name, nationality, country_code, hobby.

    No join hint: nation is a small dimension and the planner broadcasts it
    by its measured size, falling back to a shuffled join if it were large.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
            .select(c.c_custkey.alias("person_id"), c.c_name.alias("name"),
                    n.n_name.alias("nationality"), n.n_nationkey.alias("country_code"),
                    c.c_mktsegment.alias("hobby")))


def padded_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``people`` whose text columns carry blanks and control characters around
    them, in a way that depends on the row."""
    def pad(c: str) -> F.Column:
        k = F.col("person_id")
        return F.concat(F.when(k % 3 == 1, " ").when(k % 3 == 2, "\t").otherwise(""), F.col(c),
                        F.when(k % 2 == 1, " \x01\n").otherwise("")).alias(c)
    p = people(spark, sf_dir)
    return p.select("person_id", pad("name"), pad("nationality"), "country_code", pad("hobby"))


def friends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All signup events as directed edges person_id → friend_id."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    return (e.select(F.col("event_id").alias("rel_id"), F.col("user_id").alias("person_id"),
                     _event_key().alias("friend_id"), F.to_date("ts").alias("since"),
                     F.col("event_type").alias("relation")))


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other events as page accesses by_who → what_page."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") != "signup")
    return e.select(F.col("event_id").alias("access_id"), F.col("user_id").alias("by_who"),
                    _event_key().alias("what_page"), F.col("event_type").alias("access_type"),
                    F.col("ts").alias("access_time"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as 2-D integer points (x = quantity·100, y = ⌊price / 21⌋)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_quantity") * 100).cast(T.LongType()).alias("x"),
                     F.floor(F.col("l_extendedprice") / 21).cast(T.LongType()).alias("y"))


def real_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as points of two doubles: quantity and price as they are."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.array("l_quantity", "l_extendedprice").alias("v"))


def real_start_centers() -> list[tuple[int, tuple[float, float]]]:
    """The start centers on the scale of ``real_points``."""
    return [(i, (x / 100.0, y * 21.0)) for i, x, y in start_centers()]


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as points."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"))
