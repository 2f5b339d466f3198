"""Cross-operator properties at sf0.01."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from murmuration import queries
from murmuration.operators import social
from murmuration.sources import bindings as b

from conftest import sf_dir


@pytest.fixture(scope="module")
def t(spark):
    sf = sf_dir("0.01")
    return {"people": b.people(spark, sf), "friends": b.friends(spark, sf),
            "access": b.access(spark, sf), "sf": sf}


def ids(df):
    return {r["person_id"] for r in df.select("person_id").collect()}


def test_q07_within_q08_on_known_people(t):
    known = ids(t["people"])
    q7 = ids(social.neglectful_all(t["people"], t["friends"], t["access"])) & known
    q8 = ids(social.neglectful_any(t["people"], t["friends"], t["access"]))
    assert q7 <= q8 and q7 != q8


def test_disconnected_variants_agree(t):
    acc = t["access"]
    as_of = acc.filter(F.col("by_who") == 7).agg(F.max("access_time")).collect()[0][0]
    import datetime as dt
    as_of = as_of + dt.timedelta(days=14)
    q9 = ids(social.disconnected(t["people"], acc, as_of))
    q10 = ids(social.disconnected_known(t["people"], acc, as_of))
    q11 = ids(social.disconnected_antijoin(t["people"], acc, as_of))
    never = ids(t["people"]) - {r["by_who"] for r in acc.select("by_who").distinct().collect()}
    assert q10 == q11 - never
    assert q9 <= q11 and q11 - q9 == {7}


def test_indegree_sums_to_known_edges(t):
    total = social.friend_counts_indegree(t["people"], t["friends"]).agg(F.sum("friend_count")).collect()[0][0]
    known = t["friends"].join(t["people"], t["friends"].friend_id == t["people"].person_id, "left_semi").count()
    assert total == known


def test_cluster_sizes_sum_to_points(spark, t):
    df = queries.SOCIAL_QUERIES  # noqa: F841
    from murmuration.queries_kmeans import q16
    sizes = q16(spark, t["sf"]).agg(F.sum("n")).collect()[0][0]
    assert sizes == b.points(spark, t["sf"]).count()
