"""Hand-made edge inputs (FIXTURES.md §3) and the quirk-ledger decisions."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from murmuration import schemas
from murmuration.operators import clustering as km
from murmuration.operators import social
from murmuration.sources import csv_table, read_access, read_people, write_csv


def people_df(spark, rows):
    return spark.createDataFrame(rows, schemas.PEOPLE_SCHEMA)


def friends_df(spark, edges):
    rows = [(i, s, d, dt.date(2020, 1, 1), "x") for i, (s, d) in enumerate(edges)]
    return spark.createDataFrame(rows, schemas.FRIENDS_SCHEMA)


def access_df(spark, rows):
    data = [(i, s, d, "view", t) for i, (s, d, t) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.ACCESS_SCHEMA)


def pts_df(spark, pts):
    return spark.createDataFrame(pts, schemas.POINTS_SCHEMA)


P3 = [(1, "a", "X", 1, "h"), (2, "b", "Y", 2, "h"), (3, "c", "X", 1, "h")]


def test_empty_inputs(spark):
    p = people_df(spark, [])
    f = friends_df(spark, [])
    a = access_df(spark, [])
    assert social.count_by_country(p).count() == 0
    assert social.top_pages(a, p).count() == 0
    assert social.friend_counts_outdegree(p, f).count() == 0
    assert social.access_profile(a).count() == 0
    assert social.neglectful_all(p, f, a).count() == 0
    assert social.popular_people(p, f).count() == 0
    assert social.popular_people_linked(p, f).count() == 0
    assert social.disconnected(p, a, "2024-01-01 00:00:00").count() == 0


def test_unknown_and_self_and_repeated_edges(spark):
    p = people_df(spark, P3)
    # 1->1 self edge, 1->2 twice, 9->1 owner unknown
    f = friends_df(spark, [(1, 1), (1, 2), (1, 2), (9, 1)])
    out = {r["person_id"]: (r["name"], r["friend_count"])
           for r in social.friend_counts_outdegree(p, f).collect()}
    assert out == {1: ("a", 3), 2: ("b", 0), 3: ("c", 0), 9: ("Unknown", 1)}
    ind = {r["person_id"]: r["friend_count"] for r in social.friend_counts_indegree(p, f).collect()}
    assert ind == {1: 2, 2: 2, 3: 0}
    # Q07: owner 9 is unknown -> reported as Unknown; nobody visited anyone
    a = access_df(spark, [(1, 2, dt.datetime(2024, 1, 1))])
    q7 = {r["person_id"]: r["name"] for r in social.neglectful_all(p, f, a).collect()}
    assert q7 == {9: "Unknown"}  # 1 visited friend 2
    q8 = sorted(r["person_id"] for r in social.neglectful_any(p, f, a).collect())
    assert q8 == [1]  # 1 never visited itself (self edge); 9 has no name


def test_access_exactly_at_cutoff(spark):
    p = people_df(spark, P3)
    as_of = "2024-06-21 00:00:00"
    a = access_df(spark, [(1, 2, dt.datetime(2024, 6, 7, 0, 0, 0)),   # exactly as_of - 14d
                          (2, 1, dt.datetime(2024, 6, 20, 0, 0, 0))])  # recent
    q9 = sorted(r["person_id"] for r in social.disconnected(p, a, as_of).collect())
    q10 = sorted(r["person_id"] for r in social.disconnected_known(p, a, as_of).collect())
    q11 = sorted(r["person_id"] for r in social.disconnected_antijoin(p, a, as_of).collect())
    assert q9 == [3]          # strict: latest < cutoff is false for person 1
    assert q10 == [1]         # 14 whole days elapsed; 3 never accessed (inner)
    assert q11 == [1, 3]      # nothing strictly after the cutoff


def test_whole_days_not_calendar(spark):
    p = people_df(spark, P3)
    a = access_df(spark, [(1, 2, dt.datetime(2024, 6, 7, 0, 0, 1))])  # 13 days 23:59:59
    assert social.disconnected_known(p, a, "2024-06-21 00:00:00").count() == 0


def test_nobody_above_average(spark):
    p = people_df(spark, P3)
    f = friends_df(spark, [(1, 2), (2, 3), (3, 1)])
    assert social.popular_people(p, f).count() == 0
    assert social.popular_people_linked(p, f).count() == 0


def test_top_pages_ties_and_missing_owner(spark):
    p = people_df(spark, P3)
    a = access_df(spark, [(1, 9, dt.datetime(2024, 1, 1))] * 3
                  + [(1, 3, dt.datetime(2024, 1, 1))] * 2 + [(1, 2, dt.datetime(2024, 1, 1))] * 2)
    got = [(r["page_id"], r["access_count"], r["page_rank"])
           for r in social.top_pages(a, p, n=2).orderBy("page_rank").collect()]
    # page 9 (no owner) is cut first and drops out; tie 2 vs 3 -> lower id kept
    assert got == [(2, 2, 2)]


def test_csv_multi_file_and_modes(spark, tmp_dir):
    d = os.path.join(tmp_dir, "people")
    os.makedirs(d)
    hdr = "PersonID,Name,Nationality,Country Code,Hobby\n"
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write(hdr + "1,a,X,1,h\n2,b,Y,2,h\n")
    with open(os.path.join(d, "b.csv"), "w") as fh:
        fh.write(hdr + "3,c,X,1,h\n4,d,Z\n")  # short row
    assert len(read_people(spark, d, mode="DROPMALFORMED").collect()) == 3
    with pytest.raises(Exception):
        read_people(spark, d, mode="FAILFAST").collect()
    # header names are checked
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "a.csv"), "w") as fh:
        fh.write("Id,Name,Nationality,Country Code,Hobby\n1,a,X,1,h\n")
    with pytest.raises(Exception):
        read_people(spark, bad).collect()


def test_csv_roundtrip_and_overwrite(spark, tmp_dir):
    a = access_df(spark, [(1, 2, dt.datetime(2024, 6, 7, 1, 2, 3))])
    out = os.path.join(tmp_dir, "acc")
    write_csv(a, out)
    with pytest.raises(Exception):
        write_csv(a, out)  # refuses an existing output by default
    write_csv(a, out, mode="overwrite")
    back = csv_table(spark, out, schemas.ACCESS_SCHEMA)
    assert back.collect() == a.collect()


def test_unparseable_timestamp(spark, tmp_dir):
    d = os.path.join(tmp_dir, "acc")
    os.makedirs(d)
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime\n"
                 "1,1,2,view,2024-06-07 01:02:03\n2,1,2,view,not-a-time\n")
    assert len(read_access(spark, d, mode="DROPMALFORMED").collect()) == 1


# ---------------------------------------------------------------- k-means
def test_equidistant_centers_lowest_id(spark):
    pts = pts_df(spark, [(5, 0)])
    df = km.kmeans_step(pts, [(0, 0, 0), (1, 10, 0)])
    assert [(r["center_id"], r["n"]) for r in df.collect()] == [(0, 1)]
    df = km.kmeans_step(pts, [(3, 0, 0), (1, 10, 0)])
    assert [r["center_id"] for r in df.collect()] == [1]


@pytest.mark.parametrize("argmin", ["arrow", "builtin"])
def test_duplicate_and_empty_centers(spark, argmin):
    pts = pts_df(spark, [(0, 0), (1, 1), (100, 100)])
    df = km.kmeans_step(pts, [(0, 0, 0), (1, 0, 0), (2, 1000, 1000), (3, 100, 100)],
                        argmin=argmin)
    got = {r["center_id"]: (r["x"], r["y"], r["n"]) for r in df.collect()}
    assert got == {0: (1, 1, 2), 3: (100, 100, 1)}  # duplicate 1 and empty 2 vanish


def test_k_greater_than_points_and_r1(spark):
    pts = pts_df(spark, [(0, 0), (10, 10)])
    res = km.kmeans_converged(pts, [(i, i, i) for i in range(5)], r_max=1)
    try:
        assert res.passes == 1 and not res.converged
        assert res.centers.count() == 2
    finally:
        res.release()


def test_rounding_half_up_and_trunc(spark):
    pts = pts_df(spark, [(0, 0), (1, 0), (-3, -3), (-4, -4)])
    hu = km.kmeans_step(pts, [(0, 0, 0), (1, -3, -3)], rounding="half_up")
    tr = km.kmeans_step(pts, [(0, 0, 0), (1, -3, -3)], rounding="trunc")
    # means 0.5 and -3.5: half-up = floor(v + 1/2) -> 1 and -3; trunc -> 0 and -3
    assert {r["center_id"]: r["x"] for r in hu.collect()} == {0: 1, 1: -3}
    assert {r["center_id"]: r["x"] for r in tr.collect()} == {0: 0, 1: -3}


def test_large_coordinates(spark):
    big = 2**31 - 1
    pts = pts_df(spark, [(big, big), (big - 2, big), (0, 0)])
    df = km.kmeans_step(pts, [(0, big, big), (1, 0, 0)])
    got = {r["center_id"]: (r["x"], r["y"], r["n"]) for r in df.collect()}
    assert got == {0: (big - 1, big, 2), 1: (0, 0, 1)}


def test_weighted_points_are_exact(spark):
    pts = pts_df(spark, [(1, 1)] * 5 + [(4, 1)])
    with km.WeightedPoints(pts) as wp:
        assert sorted(tuple(r) for r in wp.df.collect()) == [(1, 1, 5), (4, 1, 1)]
        st = km.run_pass(wp.df, [(0, 0, 0)], "half_up", with_sse=True)
    assert st.centers_out == [(0, 2, 1)] and st.sizes == {0: 6}
    assert st.sse == 5 * 1 + 4  # 5·(1-2)² + (4-2)²


def test_seeds(spark):
    pts = pts_df(spark, [(i, i * 2) for i in range(50)] + [(1, 2)] * 10)
    s = km.kmeans_seeds_sample(pts, 5, seed=7)
    rows = s.collect()
    assert len(rows) == 5 and len({(r["x"], r["y"]) for r in rows}) == 5
    assert sorted(r["center_id"] for r in rows) == list(range(5))
    assert rows == km.kmeans_seeds_sample(pts, 5, seed=7).collect()
    u = km.kmeans_seeds_uniform(pts, 8, seed=7, lo=0, hi=5000).collect()
    assert len(u) == 8 and all(0 <= r["x"] <= 5000 and 0 <= r["y"] <= 5000 for r in u)
    d = km.kmeans_seeds_uniform(pts, 8, seed=7).collect()
    assert all(0 <= r["x"] <= 49 and 0 <= r["y"] <= 98 for r in d)


def test_sweep_cells_and_small_sweep(spark):
    assert len(km.sweep_cells()) == 15
    pts = pts_df(spark, [(i % 37, (i * 7) % 41) for i in range(400)])
    df = km.kmeans_sweep(pts, ks=(3, 4), rs=(1, 3), convergence=(False, True), tolerance=0.5)
    rows = df.collect()
    assert len(rows) == 6
    for r in rows:
        assert 1 <= r["passes"] <= r["r"] + (1 if r["convergence"] else 0)
        assert r["k_final"] <= r["k"] and r["wcss"] >= 0


def test_csv_permissive_keeps_bad_lines(spark, tmp_dir):
    d = os.path.join(tmp_dir, "people")
    os.makedirs(d)
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("PersonID,Name,Nationality,Country Code,Hobby\n1,a,X,1,h\nzz,b,Y,2,h\n")
    df = csv_table(spark, d, schemas.PEOPLE_SCHEMA, schemas.PEOPLE_FILE_COLUMNS,
                   mode="PERMISSIVE", corrupt_column="_bad")
    rows = sorted(df.collect(), key=lambda r: str(r["name"]))
    assert [r["_bad"] for r in rows] == [None, "zz,b,Y,2,h"]
    assert rows[1]["person_id"] is None


def test_tab_separated_sink(spark, tmp_dir):
    p = people_df(spark, P3)
    out = os.path.join(tmp_dir, "tsv")
    write_csv(p, out, sep="\t")
    back = csv_table(spark, out, schemas.PEOPLE_SCHEMA, sep="\t")
    assert sorted(back.collect()) == sorted(p.collect())


def test_points_must_be_integral(spark):
    df = spark.createDataFrame([(1.5, 2.0)], "x double, y double")
    with pytest.raises(TypeError):
        km.kmeans_step(df, [(0, 0, 0)])
    ints = spark.createDataFrame([(1, 2), (3, 4)], "x int, y int")
    assert km.kmeans_step(ints, [(0, 0, 0)]).collect()[0]["n"] == 2


def test_top_pages_repeated_owner_rows(spark):
    p = people_df(spark, P3 + [(2, "b2", "Y", 2, "h")])  # id 2 twice
    a = access_df(spark, [(1, 2, dt.datetime(2024, 1, 1))] * 2 + [(1, 3, dt.datetime(2024, 1, 1))])
    assert social.top_pages(a, p, n=2).count() == 3          # keyed join keeps both rows
    got = social.top_pages(a, p, n=2, dedupe_owners=True).collect()
    assert sorted((r["page_id"], r["name"]) for r in got) == [(2, "b"), (3, "c")]


def test_kmeans_on_no_points(spark):
    empty = pts_df(spark, [])
    assert km.kmeans_step(empty, [(0, 1, 1)]).count() == 0
    for res in (km.kmeans_fixed(empty, [(0, 1, 1)], r=3),
                km.kmeans_converged(empty, [(0, 1, 1)], r_max=3)):
        try:
            assert res.centers.count() == 0 and not res.converged
        finally:
            res.release()


def test_null_keys_never_count_as_visits(spark):
    p = people_df(spark, P3)
    f = spark.createDataFrame([(0, 1, None, dt.date(2020, 1, 1), "r"),
                               (1, None, 2, dt.date(2020, 1, 1), "r")], schemas.FRIENDS_SCHEMA)
    a = spark.createDataFrame([(0, 1, None, "view", dt.datetime(2024, 1, 1)),
                               (1, None, 2, "view", dt.datetime(2024, 1, 1))], schemas.ACCESS_SCHEMA)
    got = {(r["src"], r["n_friends"], r["n_visited"])
           for r in social.friend_visit_counts(f, a).collect()}
    assert got == {(1, 1, 0), (None, 1, 0)}
    q7 = {(r["person_id"], r["name"]) for r in social.neglectful_all(p, f, a).collect()}
    assert q7 == {(1, "a"), (None, "Unknown")}


def test_arrow_argmin_with_null_coordinates(spark):
    df = spark.createDataFrame([(0, 0), (None, 5), (9, 9)], "x long, y long")
    got = [r["c"] for r in df.select(km.assign_center(F.col("x"), F.col("y"),
                                                      [(0, 0, 0), (1, 10, 10)]).alias("c")).collect()]
    assert got == [0, None, 1]


def test_one_row_tables(spark):
    p = people_df(spark, [(1, "a", "X", 1, "h")])
    f = friends_df(spark, [(1, 1)])
    a = access_df(spark, [(1, 1, dt.datetime(2024, 1, 1))])
    assert [tuple(r) for r in social.count_by_country(p).collect()] == [("X", 1)]
    assert [(r["page_id"], r["page_rank"]) for r in social.top_pages(a, p).collect()] == [(1, 1)]
    assert social.neglectful_all(p, f, a).count() == 0      # visited their only friend
    assert social.neglectful_any(p, f, a).count() == 0
    assert social.popular_people(p, f).count() == 0         # 1 edge / 1 person: not above
    assert social.popular_people_linked(p, f).count() == 0
    assert social.disconnected(p, a, "2024-01-10 00:00:00").count() == 0
    assert social.disconnected(p, a, "2024-01-16 00:00:00").count() == 1


def test_points_table_is_split_and_deleted(spark):
    import os
    pts = spark.range(120_000).selectExpr("id AS x", "id % 977 AS y")
    with km.WeightedPoints(pts) as wp:
        path = wp.df.inputFiles()[0].replace("file://", "")
        assert wp.df.count() == 120_000 and len(wp.df.inputFiles()) >= 4
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_released_result_still_answers(spark):
    pts = pts_df(spark, [(i % 9, i % 7) for i in range(200)])
    a, b = (km.kmeans_fixed(pts, [(0, 0, 0), (1, 8, 6)], r=2) for _ in range(2))
    b.release()
    assert sorted(a.centers.collect()) == sorted(b.centers.collect())
    a.release()


def test_incomplete_points_belong_to_no_cluster(spark):
    pts = spark.createDataFrame([(1, 1), (2, 2), (None, 5), (7, None), (9, 9)], "x long, y long")
    centers = [(0, 1, 1), (1, 9, 9)]
    assert sum(r["n"] for r in km.kmeans_step(pts, centers).collect()) == 3
    res = km.kmeans_converged(pts, centers, r_max=3)
    assert sum(r["n"] for r in res.centers.collect()) == 3
    assert km.kmeans_assign(pts, res).count() == 3
    res.release()
    assert km.kmeans_seeds_sample(pts, 5).count() == 3


def test_large_coordinates_do_not_overflow(spark):
    big = 4 * 10**9
    pts = spark.createDataFrame([(big, -big), (big + 2, -big)], "x long, y long")
    row = km.pass_frame(km._weighted(pts), [(0, big, -big)], with_sse=True).first()
    assert (row["x"], row["y"], row["n"], row["sse"]) == (big + 1, -big, 2, 2.0)


def test_centers_file_errors(spark, tmp_path):
    from murmuration.sources import read_centers
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.write_text("x,y\n1,1\n2.5,3.5 Old:0,0\n")
    bad.write_text("1,1\nx2,2\n")
    assert read_centers(spark, str(good), k=2) == [(0, 1, 1), (1, 3, 4)]
    with pytest.raises(ValueError):
        read_centers(spark, str(good), k=1)
    with pytest.raises(ValueError):
        read_centers(spark, str(bad))


def test_trim_takes_every_character_up_to_space(spark):
    p = spark.createDataFrame([(1, " a\t", "France", "x"), (2, "b", " France ", "y"),
                               (3, "c", "\tFrance\x01", "z"), (4, "d", None, "z")],
                              "person_id long, name string, nationality string, hobby string")
    assert {r["nationality"]: r["n_people"] for r in social.count_by_country(p).collect()} == \
        {"France": 3, None: 1}
    assert sorted(r["name"] for r in social.users_by_nationality(p, "\tFRANCE").collect()) == ["a", "b", "c"]


def test_sweep_on_shared_points(spark):
    pts = pts_df(spark, [(i % 37, (i * 7) % 41) for i in range(400)])
    own = km.kmeans_sweep(pts, ks=(3,), rs=(1, 3), tolerance=0.5).collect()
    with km.WeightedPoints(pts) as wp:
        shared = km.kmeans_sweep(pts, ks=(3,), rs=(1, 3), tolerance=0.5, weighted=wp).collect()
        assert wp.df.count() > 0
    assert sorted(own) == sorted(shared)
