"""Ranks, membership filters, heavy hitters, counters and bucketed inputs."""

from __future__ import annotations

import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import murmuration.operators.heavy as heavy
from murmuration.operators.counters import written_with_counts
from murmuration.operators.membership import filter_words, in_set, may_hold, not_in_set
from murmuration.operators.ordering import in_order, ranked
from murmuration.operators import clustering as km
from murmuration.plans.inspect import plan_string, scan_details
from murmuration.session import ensure_checkpoint_dir, release_scratch, scratch_path
from murmuration.sources import write_csv
from murmuration.sources.bindings import start_centers
from murmuration.sources.bucketed import BucketedInputs, profile

from conftest import grid_points


def numbers(spark, values, n=4):
    return spark.createDataFrame([(v,) for v in values], "v long").repartition(n)


def test_ranks_equal_a_global_sort(spark):
    rng = random.Random(1)
    values = [rng.randrange(50) for _ in range(3000)] + [7] * 3000
    got = ranked(numbers(spark, values), [F.col("v").desc()], salt=F.monotonically_increasing_id()).collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["rank"])] == sorted(values, reverse=True)
    assert sorted(r["rank"] for r in got) == list(range(1, 6001))
    assert ranked(numbers(spark, []), [F.col("v")]).collect() == []


def test_files_follow_one_another_in_key_order(spark, tmp_dir):
    rng = random.Random(2)
    values = [rng.randrange(10**6) for _ in range(5000)]
    path = os.path.join(tmp_dir, "sorted")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_csv(in_order(numbers(spark, values), [F.col("v")]), path, header=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(glob.glob(os.path.join(path, "part-*")))
    lines = [int(x) for f in files for x in open(f).read().split()]
    assert len(files) > 1 and lines == sorted(values)


@pytest.mark.parametrize("size", [64, 1 << 14])
def test_membership_is_exact_for_any_filter(spark, size):
    rng = random.Random(3)
    rows = [rng.randrange(4000) for _ in range(6000)] + [None]
    members = rng.sample(range(4000), 900) + [None]
    df, of = numbers(spark, rows), numbers(spark, members)
    inside = {m for m in members if m is not None}
    got = [r["v"] for r in in_set(df, "v", of, "v", size).collect()]
    assert Counter(got) == Counter(v for v in rows if v in inside)
    out = [r["v"] for r in not_in_set(df, "v", of, "v", ("v",), size).collect()]
    assert Counter(out) == Counter(v for v in rows if v not in inside)
    words = filter_words(of, "v", size)
    assert words.nbytes <= size
    passed = may_hold(df, "v", words).count()
    assert passed >= len(got) and (size < 1000 or passed < len(rows) / 2)


def test_membership_of_texts_and_empty_sets(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert [r["v"] for r in in_set(df, "v", df.filter("v = 'b'"), "v", 64).collect()] == ["b"]
    assert in_set(df, "v", df.limit(0), "v", 64).collect() == []
    assert not_in_set(df, "v", df.limit(0), "v", ("v",), 64).count() == 3


def top(values, n):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda kv: (-kv[1], kv[0]))[:n]


def test_heavy_hitters_are_proven_on_skewed_data(spark):
    rng = random.Random(4)
    values = [int(rng.paretovariate(1.1)) for _ in range(20000)] + [None] * 50
    got, proven = heavy.heavy_hitters(numbers(spark, values, 5), "v", 5, counters=64)
    assert proven and sorted(map(tuple, got.collect()), key=lambda kv: (-kv[1], kv[0])) == top(values, 5)


def test_heavy_hitters_fall_back_on_flat_data(spark):
    values = [i % 1000 for i in range(9000)]
    got, proven = heavy.heavy_hitters(numbers(spark, values, 3), "v", 7, counters=32)
    assert not proven and sorted(map(tuple, got.collect()), key=lambda kv: (-kv[1], kv[0])) == top(values, 7)


def test_heavy_hitters_of_few_keys_and_texts(spark):
    df = spark.createDataFrame([("x",)] * 3 + [("y",)] * 2 + [(None,)], "v string")
    got, proven = heavy.heavy_hitters(df, "v", 9)
    assert proven and {tuple(r) for r in got.collect()} == {("x", 3), ("y", 2)}
    got, proven = heavy.heavy_hitters(df.limit(0), "v", 2)
    assert proven and got.collect() == []


def test_counts_are_taken_while_the_table_is_written(spark):
    df = numbers(spark, [1, 1, 2, None], 3)
    out, seen = written_with_counts(
        df, {"n": F.count(F.lit(1)), "none": F.count_if(F.col("v").isNull())},
        lambda d: d.groupBy("v").agg(F.count(F.lit(1)).alias("k")))
    assert seen == {"n": 4, "none": 1}
    assert {tuple(r) for r in out.collect()} == {(1, 2), (2, 1), (None, 1)}


def test_bucketed_inputs_need_no_exchange(spark):
    people = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "person_id long, name string")
    friends = spark.createDataFrame([(i % 30, i) for i in range(100)], "person_id long, friend_id long")
    access = spark.createDataFrame([(i % 25, i % 4, i) for i in range(200)],
                                   "person_id long, what_page long, access_time long")
    want = {tuple(r) for r in profile(people, friends, access).collect()}
    with BucketedInputs(spark, 4) as stored:
        df = profile(stored.store(people, "person_id"), stored.store(friends, "person_id"),
                     stored.store(access, "person_id", "what_page"))
        assert "Exchange" not in plan_string(df) and {tuple(r) for r in df.collect()} == want
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("murmuration_")]


def test_both_outputs_come_from_one_scan_of_the_points(spark, tmp_dir):
    pts = spark.createDataFrame(grid_points(500), "x long, y long")
    source = os.path.join(tmp_dir, "points")
    pts.write.parquet(source)
    pts = spark.read.parquet(source)
    res = km.kmeans_converged(pts, start_centers(), 5)
    res.release()
    df = km.tagged_outputs(res, pts)
    assert [d["scan"].strip() for d in scan_details(df)].count("Scan parquet") == 1
    path = os.path.join(tmp_dir, "out")
    km.write_tagged_outputs(res, pts, path)
    got = {tuple(r) for r in spark.read.parquet(path).select(df.columns).collect()}
    assert got == {tuple(r) for r in df.collect()}
    sizes = Counter(r["center_id"] for r in km.kmeans_assign(pts, res).collect())
    assert {(r[1], r[6]) for r in got if r[0] == "centers"} == set(sizes.items())


def test_scratch_folders_are_deleted_on_request(spark, tmp_dir):
    path = scratch_path(spark, "gone")
    numbers(spark, [1]).write.parquet(path)
    before = ensure_checkpoint_dir(spark)
    release_scratch(spark)
    assert not glob.glob(os.path.join(before.removeprefix("file:"), "murmuration-gone-*"))
