"""Registered queries: each operator bound to the driver's tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the parquet tables under ``sf_dir`` (SURVEY §2A-detail for the bindings).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.operators import social
from murmuration.operators.counters import written_with_counts
from murmuration.operators.heavy import heavy_hitters
from murmuration.operators.membership import in_set, not_in_set
from murmuration.operators.ordering import ranked
from murmuration.session import scratch_path
from murmuration.sources import bindings as b
from murmuration.sources.bucketed import BucketedInputs, profile

Q09_AS_OF = "2024-02-13 00:00:00"


def q01(spark: SparkSession, sf: str) -> DataFrame:
    return social.users_by_nationality(b.padded_people(spark, sf), " nation_7 ")


def q02(spark: SparkSession, sf: str) -> DataFrame:
    return social.top_pages(b.table(spark, sf, "lineitem"), b.table(spark, sf, "part"), n=10,
                            page_col="l_partkey", owner_key="p_partkey",
                            owner_cols=("p_name", "p_brand", "p_type"))


def q03(spark: SparkSession, sf: str) -> DataFrame:
    return social.count_by_country(b.padded_people(spark, sf))


def q04(spark: SparkSession, sf: str) -> DataFrame:
    # whole tables: suppliers as people, so owners outside get Unknown, and
    # their edges both ways, so suppliers without an edge get 0
    s = b.table(spark, sf, "supplier")
    people = s.select((F.col("s_suppkey") * 3).alias("person_id"), F.col("s_name").alias("name"))
    return social.friend_counts_outdegree(people, b.friends(spark, sf))


def q02_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Owner table with many rows of an id: suppliers by nation."""
    return social.top_pages(b.table(spark, sf, "customer"), b.table(spark, sf, "supplier"), n=10,
                            page_col="c_nationkey", owner_key="s_nationkey",
                            owner_cols=("s_name",), dedupe_owners=True)


def q11_text_times(spark: SparkSession, sf: str) -> DataFrame:
    """Access times as text, every seventh unreadable: such a row is skipped."""
    acc = b.access(spark, sf).withColumn("access_time", F.when(
        F.col("access_id") % 7 == 0, "no time").otherwise(
        F.date_format("access_time", "yyyy-MM-dd HH:mm:ss")))
    return social.disconnected_antijoin(b.people(spark, sf), social.readable_times(acc),
                                        Q09_AS_OF, 14)


def q02_heavy(spark: SparkSession, sf: str) -> DataFrame:
    """The ten most used suppliers by summaries and a proof, or a whole count."""
    top, _ = heavy_hitters(b.table(spark, sf, "lineitem"), "l_suppkey", 10)
    return top.select(F.col("key").alias("page_id"), F.col("count").alias("access_count"))


def q04_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Out-degrees with the number of edges counted by the job that made them."""
    def degrees(edges: DataFrame) -> DataFrame:
        return social.friend_counts_outdegree(b.people(spark, sf).select("person_id", "name"), edges)

    table, seen = written_with_counts(
        b.friends(spark, sf), {"n_edges": F.count(F.lit(1)), "n_self": F.count_if(F.expr("person_id = friend_id"))},
        degrees)
    return table.withColumns({k: F.lit(v).cast("long") for k, v in seen.items()})


def q04_text_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Out-degrees over text ids with blanks around them."""
    def text(c: str) -> F.Column:
        return F.concat(F.when(F.col(c) % 3 == 0, " ").otherwise(""), F.col(c).cast("string"),
                        F.when(F.col(c) % 2 == 0, "\t ").otherwise(""))

    people = b.people(spark, sf).select(text("person_id").alias("person_id"), "name")
    edges = b.friends(spark, sf).withColumn("person_id", F.concat(F.lit(" "), text("person_id")))
    return social.friend_counts_outdegree(social.trimmed_ids(people, "person_id"),
                                          social.trimmed_ids(edges, "person_id"))


def q05_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """In-degrees in order, ranked without a single-task sort."""
    counts = social.friend_counts_indegree(b.people(spark, sf), b.friends(spark, sf))
    return ranked(counts, [F.col("friend_count").desc(), F.col("person_id").asc()])


def q05(spark: SparkSession, sf: str) -> DataFrame:
    return social.friend_counts_indegree(b.people(spark, sf), b.friends(spark, sf))


def q06(spark: SparkSession, sf: str) -> DataFrame:
    return social.access_profile(b.access(spark, sf))


def q07(spark: SparkSession, sf: str) -> DataFrame:
    return social.neglectful_all(b.people(spark, sf), b.friends(spark, sf), b.access(spark, sf))


def q08(spark: SparkSession, sf: str) -> DataFrame:
    return social.neglectful_any(b.people(spark, sf), b.friends(spark, sf), b.access(spark, sf))


def q07_purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Only purchases count as visits."""
    visits = b.access(spark, sf).filter("access_type = 'purchase'")
    return social.neglectful_all(b.people(spark, sf), b.friends(spark, sf), visits)


def q08_fifths(spark: SparkSession, sf: str) -> DataFrame:
    """Edges and visits whose targets are k div 5, so that some meet and some do not."""
    friends = b.friends(spark, sf).withColumn("friend_id", F.expr("friend_id div 5"))
    access = b.access(spark, sf).withColumn("what_page", F.expr("what_page div 5"))
    return social.neglectful_any(b.people(spark, sf), friends, access)


def q06_profile(spark: SparkSession, sf: str) -> DataFrame:
    """People, edges and visits stored once by person, then asked without an exchange."""
    with BucketedInputs(spark, 8) as stored:
        visits = b.access(spark, sf).withColumnRenamed("by_who", "person_id")
        out = profile(stored.store(b.people(spark, sf).select("person_id", "name"), "person_id"),
                      stored.store(b.friends(spark, sf).select("person_id", "friend_id"), "person_id"),
                      stored.store(visits.select("person_id", "what_page", "access_time"),
                                   "person_id", "what_page"))
        path = scratch_path(spark, "profile")
        out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def q11_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Line items of parts that were never returned: a Bloom filter, then the set."""
    li = b.table(spark, sf, "lineitem")
    returned = li.filter("l_returnflag = 'R' AND l_quantity >= 49").select("l_partkey")
    return not_in_set(li, "l_partkey", returned, "l_partkey", ("l_orderkey", "l_linenumber"),
                      filter_bytes=1 << 16)


def q08_members(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of customers that signed up: the set's Bloom filter before the join."""
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return in_set(orders, "o_custkey", b.friends(spark, sf), "person_id", filter_bytes=1 << 16)


def q09(spark: SparkSession, sf: str) -> DataFrame:
    return social.disconnected(b.people(spark, sf), b.access(spark, sf), Q09_AS_OF, 14)


def q10(spark: SparkSession, sf: str) -> DataFrame:
    return social.disconnected_known(b.people(spark, sf), b.access(spark, sf), Q09_AS_OF, 14)


def q11(spark: SparkSession, sf: str) -> DataFrame:
    acc = b.access(spark, sf)
    # as_of = person 7's latest access + 14 days: that person sits exactly on
    # the cutoff.  A lazy scalar subquery, evaluated once inside the plan.
    as_of = (acc.filter(F.col("by_who") == 7)
             .select(F.max("access_time") + F.make_interval(days=F.lit(14))).scalar())
    return social.disconnected_antijoin(b.people(spark, sf), acc, as_of, 14)


def q12(spark: SparkSession, sf: str) -> DataFrame:
    return social.popular_people(b.table(spark, sf, "part"), b.table(spark, sf, "lineitem"),
                                 node_key="p_partkey", name_col="p_name", dst_col="l_partkey")


def q13(spark: SparkSession, sf: str) -> DataFrame:
    return social.popular_people_linked(b.people(spark, sf), b.friends(spark, sf))


SOCIAL_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_users_by_nationality": q01,
    "q02_top_pages": q02,
    "q02_top_pages_dedupe": q02_dedupe,
    "q02_heavy_hitters": q02_heavy,
    "q03_count_by_country": q03,
    "q04_friend_counts_outdegree": q04,
    "q04_degrees_with_counters": q04_counted,
    "q04_text_ids": q04_text_ids,
    "q05_friend_counts_indegree": q05,
    "q05_ranked": q05_ranked,
    "q06_access_profile": q06,
    "q06_profile_bucketed": q06_profile,
    "q07_neglectful_all": q07,
    "q07_neglectful_all_purchases": q07_purchases,
    "q08_neglectful_any": q08,
    "q08_neglectful_any_fifths": q08_fifths,
    "q08_members_filtered": q08_members,
    "q09_disconnected": q09,
    "q10_disconnected_known": q10,
    "q11_disconnected_antijoin": q11,
    "q11_text_times": q11_text_times,
    "q11_outsiders_filtered": q11_filtered,
    "q12_popular_people": q12,
    "q13_popular_people_linked": q13,
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(SOCIAL_QUERIES)
    from murmuration import queries_kmeans  # noqa: PLC0415
    out.update(queries_kmeans.KMEANS_QUERIES)
    return out
