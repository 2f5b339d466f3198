"""Inputs stored once by the key of later questions.

A bucketed table is dealt by the hash of its key and sorted by it, so joins and
aggregates on that key, of any number of such tables with the same number of
buckets, run without an exchange.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.session import drop_path, scratch_path


class BucketedInputs:
    """Tables bucketed alike, below the shared folder, until ``release``."""

    def __init__(self, spark: SparkSession, buckets: int) -> None:
        self.spark, self.buckets, self.kept = spark, buckets, []

    def store(self, df: DataFrame, *key: str) -> DataFrame:
        """``df`` as a table dealt by the first key column and sorted by all."""
        name = f"murmuration_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        dealt = df.repartition(self.buckets, key[0])  # one file a bucket
        dealt.write.bucketBy(self.buckets, key[0]).sortBy(*key).option("path", path).saveAsTable(name)
        self.kept.append((name, path))
        return self.spark.table(name)

    def release(self) -> None:
        for name, path in self.kept:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_path(self.spark, path)
        self.kept = []

    def __enter__(self) -> BucketedInputs:
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def profile(people: DataFrame, friends: DataFrame, access: DataFrame,
            key: str = "person_id") -> DataFrame:
    """For every person: friends listed, accesses, distinct pages and latest access.

    Three inputs on one key; with inputs of one ``BucketedInputs`` the plan has
    no exchange (a merge join on the stored order).
    """
    listed = friends.groupBy(key).agg(F.count(F.lit(1)).alias("n_friends"))
    seen = access.groupBy(key, "what_page").agg(
        F.count(F.lit(1)).alias("n"), F.max("access_time").alias("latest")).groupBy(key).agg(
        F.sum("n").alias("n_accesses"), F.count(F.lit(1)).alias("n_pages"),
        F.max("latest").alias("latest_access"))
    out = people.hint("merge").join(listed.hint("merge"), key, "left").join(
        seen.hint("merge"), key, "left")
    zero = F.lit(0).cast("long")
    return out.select(key, "name", *[F.coalesce(c, zero).alias(c) for c in
                                     ("n_friends", "n_accesses", "n_pages")], "latest_access")
