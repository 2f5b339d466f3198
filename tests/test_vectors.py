"""Real-valued k-means: exact sums, any partitioning, the center index, resumed runs."""

from __future__ import annotations

import math
import os
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmuration.functions.nearest import Nearest, squared
from murmuration.operators import clustering as km
from murmuration.operators import vectors
from murmuration.sources.bindings import start_centers

from conftest import grid_points

CENTERS = [(0, (0.0, 0.0, 0.0)), (3, (5.0, 5.0, 5.0)), (7, (-4.0, 2.0, 1.0))]


def frame(spark, rows, n=3):
    return spark.createDataFrame([([float(x) for x in r],) for r in rows],
                                 "v array<double>").repartition(n)


@pytest.mark.parametrize("scale", [1.0, 1e-300, 1e270])
def test_sums_of_doubles_are_exact(scale):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(5000, 2)) * np.exp(rng.normal(size=(5000, 2)) * 12) * scale
    values[::7] = 0.0
    row = rng.integers(0, 3, len(values))
    sums = vectors.ExactSums(3, 2)
    for at in range(0, len(values), 700):
        sums.add(row[at:at + 700], values[at:at + 700])
    parts = list(sums.settled())
    for r in range(3):
        for d in range(2):
            own = [(at, int(total[r, d])) for at, total in parts]
            exact = sum(map(Fraction, values[row == r, d].tolist()))
            assert vectors.quotient(own, 7) == float(exact / 7)


def brute_pass(rows, centers):
    out = {}
    for p in rows:
        best = min(centers, key=lambda c: (sum((a - b) * (a - b) for a, b in zip(p, c[1])), c[0]))
        out.setdefault(best[0], []).append(p)
    return {c: (tuple(float(sum(map(Fraction, x)) / len(own)) for x in zip(*own)), len(own))
            for c, own in out.items()}


def test_pass_gives_the_same_bits_for_any_partitioning(spark):
    rng = np.random.default_rng(4)
    rows = (rng.normal(size=(800, 3)) * 4 + rng.integers(-1, 2, (800, 1)) * 1e-9).tolist()
    want = brute_pass(rows, CENTERS)
    for n in (1, 5, 11):
        got = vectors.vector_pass(frame(spark, rows, n), CENTERS).collect()
        assert {r["center_id"]: (tuple(r["v"]), r["n"]) for r in got} == want


def test_incomplete_points_are_left_out(spark):
    rows = [([1.0, 1.0, 1.0],), ([None, 1.0, 1.0],), (None,), ([math.nan, 0.0, 0.0],),
            ([math.inf, 0.0, 0.0],), ([1.0, 1.0],), ([3.0, 3.0, 3.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    got = vectors.vector_pass(df, CENTERS).collect()
    assert {r["center_id"]: (tuple(r["v"]), r["n"]) for r in got} == {
        0: ((1.0, 1.0, 1.0), 1), 3: ((3.0, 3.0, 3.0), 1)}
    assert vectors.vector_assign(df, CENTERS).count() == 2
    none = df.limit(0)
    assert vectors.vector_pass(none, CENTERS).collect() == []
    res = vectors.vector_kmeans(none, CENTERS, 5, 1.0)
    assert res.centers == [] and not res.converged


def test_loop_follows_the_integer_loop_on_its_own_rule(spark):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(300, 3)) * 3
    cur, runs = CENTERS, []
    for _ in range(8):
        runs.append(brute_pass(rows.tolist(), cur))
        new = sorted((c, v) for c, (v, _) in runs[-1].items())
        runs[-1] = (new, max(math.dist(v, dict(cur)[c]) for c, v in new))
        cur = new
    tolerance = runs[3][1]
    stop = next(i for i, (_, m) in enumerate(runs, 1) if m <= tolerance)
    res = vectors.vector_kmeans(frame(spark, rows), CENTERS, 8, tolerance)
    assert res.converged and res.passes == stop + 1 and res.centers == runs[stop][0]
    assert res.history == [m for _, m in runs[:stop]]
    fixed = vectors.vector_kmeans(frame(spark, rows), CENTERS, 3, tolerance, check=False)
    assert fixed.passes == 3 and fixed.centers == runs[2][0] and fixed.centers_in == runs[1][0]


def test_index_equals_every_pair_with_ties():
    rng = np.random.default_rng(6)
    for dims, spread in ((2, 400), (3, 60), (16, 3)):
        places = rng.integers(0, spread, (5000, dims)).astype(float)  # many equal and equidistant
        ids = rng.permutation(9000)[:5000]
        points = np.concatenate([rng.integers(0, spread, (700, dims)), places[:200],
                                 rng.random((100, dims)) * spread]).astype(float)
        search = Nearest(ids, places)
        got, taken = search.find(points)
        d = squared(points, search.centers)
        assert np.array_equal(got, search.ids[np.argmin(d, axis=1)])
        if dims < 4:
            assert taken < d.size / 5


def test_indexed_pass_of_5000_centers(spark):
    pts = spark.createDataFrame(grid_points(4000), "x long, y long")
    seeds = km.collect_centers(km.kmeans_seeds_sample(pts, 2000))
    rows = [sorted(map(tuple, km.kmeans_step(pts, seeds, argmin=a).collect())) for a in ("arrow", "indexed")]
    assert rows[0] == rows[1]
    real = pts.select(vectors.as_vector("x", "y").alias("v"))
    centers = [(i, (float(x), float(y))) for i, x, y in seeds]
    assert vectors.distances_taken(real, centers) < 4000 * 2000 / 5


def test_a_killed_run_goes_on(spark, tmp_dir, monkeypatch):
    pts = spark.createDataFrame(grid_points(1500), "x long, y long")
    whole = km.kmeans_converged(pts, start_centers(), 20)
    want, passes = sorted(map(tuple, whole.centers.collect())), whole.passes
    whole.release()
    path, real, calls = os.path.join(tmp_dir, "log"), km.run_pass, []

    def dies(*a, **k):
        calls.append(1)
        if len(calls) == 6:
            raise KeyboardInterrupt
        return real(*a, **k)

    monkeypatch.setattr(km, "run_pass", dies)
    with pytest.raises(KeyboardInterrupt):
        km.kmeans_converged(pts, start_centers(), 20, log_path=path)
    calls.append(1)
    res = km.kmeans_converged(pts, start_centers(), 20, log_path=path)
    assert sorted(map(tuple, res.centers.collect())) == want and res.passes == passes
    assert len(calls) - 7 == passes - 1 - 5  # five passes were there
    res.release()
    with pytest.raises(ValueError):
        km.kmeans_converged(pts, start_centers(), 20, tolerance=3.0, log_path=path)


def test_real_run_goes_on_with_the_same_bits(spark, tmp_dir):
    rows = np.random.default_rng(8).normal(size=(200, 3))
    path = os.path.join(tmp_dir, "log")
    vectors.vector_kmeans(frame(spark, rows), CENTERS, 3, 0.0, check=False, log_path=path)
    got = vectors.vector_kmeans(frame(spark, rows, 7), CENTERS, 6, 0.0, check=False, log_path=path)
    want = vectors.vector_kmeans(frame(spark, rows), CENTERS, 6, 0.0, check=False)
    assert got == want


def test_one_array_or_many_columns(spark):
    df = spark.createDataFrame([(1, 2.5, [1.0, 2.5])], "a int, b double, v array<float>")
    row = df.select(vectors.as_vector("a", "b").alias("x"), vectors.as_vector("v").alias("y")).first()
    assert row["x"] == row["y"] == [1.0, 2.5]
    assert vectors.vector_seeds(df.withColumn("k", F.lit(1)), 3, "k") == [(0, (1.0, 2.5))]
