"""The command line runs the library functions over a folder of CSV files."""

from __future__ import annotations

import glob
import os

import pytest

from murmuration.cli import run


def _read(out):
    lines = []
    for f in sorted(glob.glob(os.path.join(out, "part-*.csv"))):
        with open(f) as fh:
            rows = fh.read().splitlines()
        lines += rows[1:]
    return lines


def test_cli_nationality_and_kmeans(spark, tmp_dir, data_dir):
    out = os.path.join(tmp_dir, "a")
    assert run(["users-by-nationality", "--input", data_dir, "--output", out]) == 0
    assert _read(out) == ["Ada,Chess"]
    out2 = os.path.join(tmp_dir, "k")
    assert run(["kmeans", "--input", data_dir, "--output", out2, "--r", "20", "--check",
                "--centers", os.path.join(data_dir, "centers.txt")]) == 0
    centers = _read(os.path.join(out2, "centers"))
    assert len(centers) == 10 and all(",true," in c for c in centers)
    assert len(_read(os.path.join(out2, "clustered"))) == 3000


@pytest.mark.parametrize("task,extra,rows", [
    ("count-by-country", [], 3),
    ("top-pages", ["--n", "2"], 2),
    ("neglectful-all", [], 3),
    ("disconnected", ["--as-of", "2024-06-21 00:00:00"], 3),
    ("popular-linked", [], 3),
])
def test_cli_social_tasks(spark, tmp_dir, data_dir, task, extra, rows):
    out = os.path.join(tmp_dir, task)
    assert run([task, "--input", data_dir, "--output", out, *extra]) == 0
    assert len(_read(out)) == rows


def test_cli_uniform_seeds_default_range(spark, tmp_dir, data_dir):
    out = os.path.join(tmp_dir, "u")
    assert run(["seeds-uniform", "--input", data_dir, "--output", out, "--k", "20"]) == 0
    rows = [tuple(int(v) for v in line.split(",")) for line in _read(out)]
    assert len(rows) == 20 and all(0 <= x <= 5000 and 0 <= y <= 5000 for _, x, y in rows)


def test_cli_kmeans_fixed_with_uniform_init(spark, tmp_dir, data_dir):
    out = os.path.join(tmp_dir, "kf")
    assert run(["kmeans-fixed", "--input", data_dir, "--output", out, "--k", "10", "--r", "3"]) == 0
    rows = _read(out)
    assert 1 <= len(rows) <= 10 and all(r.endswith(",false,3") for r in rows)


def test_cli_explain_writes_nothing(spark, tmp_dir, data_dir, capsys):
    out = os.path.join(tmp_dir, "never")
    assert run(["top-pages", "--input", data_dir, "--output", out, "--explain"]) == 0
    assert not os.path.exists(out)
