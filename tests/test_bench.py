"""bench.py prints exactly one JSON line with the contract's keys."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import sf_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=sf_dir("0.001"), BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "q01", "q18"],
                         env=env, cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"q01_users_by_nationality", "q18_kmeans_seeds_sample"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01  # both rounded to ms
