"""Golden answers on the hand-made network (conftest.SOCIAL_FILES), worked out by hand."""

from __future__ import annotations

import pytest

from murmuration.operators import social

AS_OF = "2024-06-21 00:00:00"


def by_id(df, col):
    return {r["person_id"]: r[col] for r in df.collect()}


def ids(df):
    return sorted(r["person_id"] for r in df.collect())


def test_q01(social_tables):
    people = social_tables["people"]
    got = sorted(tuple(r) for r in social.users_by_nationality(people, "Peru").collect())
    assert got == [("Bo", "Go"), ("Cy", "Tea"), ("Flo", "Go")]
    # trimmed and case-folded by default, exact on request
    assert social.users_by_nationality(people, "  fRANCE ").count() == 1
    assert social.users_by_nationality(people, "france", case_sensitive=True).count() == 0


def test_q02_top_pages(social_tables):
    df = social.top_pages(social_tables["access"], social_tables["people"], n=3)
    rows = sorted(df.collect(), key=lambda r: r["page_rank"])
    # page 2 four times, 1 three times, then 0 and 4 once: the lower id
    assert [(r["page_id"], r["access_count"], r["page_rank"]) for r in rows] == [
        (2, 4, 1), (1, 3, 2), (0, 1, 3)]
    assert set(df.columns) == {"page_id", "name", "nationality", "hobby", "access_count", "page_rank"}


def test_q03_count_by_country(social_tables):
    got = {r["nationality"]: r["n_people"] for r in social.count_by_country(social_tables["people"]).collect()}
    assert got == {"France": 1, "Peru": 3, "Mali": 2}


def test_q04_outdegree(social_tables):
    got = by_id(social.friend_counts_outdegree(social_tables["people"], social_tables["friends"]),
                "friend_count")
    assert got == {0: 3, 1: 1, 2: 2, 3: 2, 4: 1, 5: 0, 9: 1}


def test_q05_indegree(social_tables):
    got = by_id(social.friend_counts_indegree(social_tables["people"], social_tables["friends"]),
                "friend_count")
    assert got == {0: 4, 1: 2, 2: 2, 3: 1, 4: 0, 5: 0}


def test_q06_access_profile(social_tables):
    df = social.access_profile(social_tables["access"])
    got = {r["person_id"]: (r["total_accesses"], r["distinct_pages"]) for r in df.collect()}
    assert got == {0: (3, 2), 1: (1, 1), 2: (2, 2), 3: (1, 1), 4: (1, 1), 9: (1, 1)}


def test_q07_neglectful_all(social_tables):
    t = social_tables
    # 0 visited 1 and 2, 2 visited 0, 4 visited 2; 1, 3 and the stranger visited no friend
    assert ids(social.neglectful_all(t["people"], t["friends"], t["access"])) == [1, 3, 9]


def test_q08_neglectful_any(social_tables):
    t = social_tables
    assert ids(social.neglectful_any(t["people"], t["friends"], t["access"])) == [1, 2, 3]


@pytest.mark.parametrize("task,want", [
    # the cutoff is 2024-06-07 00:00:00: person 1 sits exactly on it, 2 a second before
    (social.disconnected, [2, 4, 5]), (social.disconnected_known, [1, 2, 4]),
    (social.disconnected_antijoin, [1, 2, 4, 5])])
def test_q09_q10_q11_disconnected(social_tables, task, want):
    assert ids(task(social_tables["people"], social_tables["access"], AS_OF, 14)) == want


def test_q12_popular_people(social_tables):
    t = social_tables  # 10 edges over 6 people
    assert by_id(social.popular_people(t["people"], t["friends"]), "friend_count") == {0: 4, 1: 2, 2: 2}


def test_q13_popular_people_linked(social_tables):
    t = social_tables  # 10 edges over 6 owners
    assert ids(social.popular_people_linked(t["people"], t["friends"])) == [0, 2, 3]
