"""k-means on points made by a rule, against plain Python."""

from __future__ import annotations

import math
import os

import pytest

from murmuration.operators import clustering as km
from murmuration.sources import read_centers, read_points
from murmuration.sources.bindings import start_centers

from conftest import grid_points


@pytest.fixture(scope="module")
def pts(spark, data_dir):
    return read_points(spark, os.path.join(data_dir, "points.csv"))


@pytest.fixture(scope="module")
def centers(spark, data_dir):
    return read_centers(spark, os.path.join(data_dir, "centers.txt"))


def one_pass(points, centers, rounding):
    """[(center_id, x, y, n, moved)] by enumeration."""
    groups = {}
    for x, y in points:
        best = min(centers, key=lambda c: ((x - c[1]) ** 2 + (y - c[2]) ** 2, c[0]))
        groups.setdefault(best[0], []).append((x, y))
    old = {c[0]: c[1:] for c in centers}
    out = []
    for i, own in sorted(groups.items()):
        n = len(own)
        mean = [math.floor((2 * s + n) / (2 * n)) if rounding == "half_up" else s // n
                for s in map(sum, zip(*own))]
        out.append((i, *mean, n, math.dist(mean, old[i])))
    return out


def trajectory(centers, rounding, passes):
    runs, cur = [], centers
    for _ in range(passes):
        runs.append(one_pass(grid_points(), cur, rounding))
        cur = [c[:3] for c in runs[-1]]
    return runs


@pytest.fixture(scope="module")
def half_up():
    return trajectory(start_centers(), "half_up", 20)


def xyn(df):
    return [tuple(r)[:4] for r in sorted(df.select("center_id", "x", "y", "n").collect())]


def first_within(runs, tolerance=50.0):
    return next(i for i, run in enumerate(runs, 1) if max(c[4] for c in run) <= tolerance)


def test_centers_file(centers):
    assert centers == start_centers()


@pytest.mark.parametrize("argmin", ["arrow", "builtin"])
def test_q14_one_pass_half_up(pts, centers, half_up, argmin):
    df = km.kmeans_step(pts, centers, rounding="half_up", argmin=argmin)
    assert xyn(df) == [c[:4] for c in half_up[0]]
    got = {r["center_id"]: r["moved"] for r in df.collect()}
    assert got == {c[0]: pytest.approx(c[4]) for c in half_up[0]}


def test_q15_six_passes_trunc(pts, centers):
    res = km.kmeans_fixed(pts, centers, r=6, rounding="trunc")
    try:
        assert res.passes == 6 and not res.converged
        assert xyn(res.centers) == [c[:4] for c in trajectory(centers, "trunc", 6)[-1]]
    finally:
        res.release()


def test_q16_converged_half_up(pts, centers, half_up):
    stop = first_within(half_up)
    res = km.kmeans_converged(pts, centers, r_max=20, tolerance=50.0)
    try:
        assert res.converged and res.passes == stop + 1 and len(res.history) == stop
        assert res.history == [pytest.approx(max(c[4] for c in run)) for run in half_up[:stop]]
        assert xyn(res.centers) == [c[:4] for c in half_up[stop]]
        # every point is assigned; cluster sizes add up to the points
        assigned = km.kmeans_assign(pts, res)
        assert assigned.count() == 3000
        sizes = {r["center_id"]: r["n"] for r in res.centers.collect()}
        got = {r["center_id"]: r["count"] for r in assigned.groupBy("center_id").count().collect()}
        assert got == sizes
    finally:
        res.release()


def test_q16_fixed_r_reports_previous_move(pts, centers, half_up):
    # without the check, R passes run; the flag reflects pass R-1's moves
    stop = first_within(half_up)
    res = km.kmeans_converged(pts, centers, r_max=stop + 1, check=False)
    try:
        assert res.passes == stop + 1 and res.converged
        assert xyn(res.centers) == [c[:4] for c in half_up[stop]]
    finally:
        res.release()
    one = km.kmeans_converged(pts, centers, r_max=1)
    try:
        assert one.passes == 1 and not one.converged  # nothing measured yet
    finally:
        one.release()


def test_q15_with_check_stops_without_closing_pass(pts, centers, half_up):
    stop = first_within(half_up)
    res = km.kmeans_fixed(pts, centers, r=20, rounding="half_up", check=True)
    try:
        assert res.passes == stop and res.converged
        assert xyn(res.centers) == [c[:4] for c in half_up[stop - 1]]
    finally:
        res.release()


def test_seeds_file_with_header(spark, data_dir):
    seeds = read_centers(spark, os.path.join(data_dir, "points.csv"))
    assert len(seeds) == 3000 and seeds[1] == (1, *grid_points()[1])


def test_runs_share_prepared_points(pts, centers, half_up):
    with km.WeightedPoints(pts) as wp:
        a = km.kmeans_fixed(pts, centers, r=6, rounding="trunc", weighted=wp)
        b = km.kmeans_converged(pts, centers, r_max=20, weighted=wp)
        a.release(); b.release()          # the shared points stay
        assert wp.df.count() > 0
        assert a.passes == 6 and b.passes == first_within(half_up) + 1
