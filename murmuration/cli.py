"""Command line: run one task over a folder of headed CSV files.

    python -m murmuration <task> --input DIR --output DIR [options]

The input folder holds the reference's file names (``pages.csv``,
``friends.csv``, ``access_logs.csv``, ``points.csv``); results are written as
headed CSV part files to ``--output`` (refused if it exists, unless
``--overwrite``).  Every task is the library function of the same name;
nothing here computes anything itself.
"""

from __future__ import annotations

import argparse
import os
import sys

from murmuration.operators import clustering as km
from murmuration.operators import social
from murmuration.session import build_session
from murmuration.sources import (
    read_access,
    read_centers,
    read_friends,
    read_people,
    read_points,
    write_csv,
)

SOCIAL_TASKS = {
    "users-by-nationality": "Q01 people of one nationality (--nationality)",
    "top-pages": "Q02 the n most accessed pages (--n)",
    "count-by-country": "Q03 people per nationality",
    "friend-counts-out": "Q04 rows each person lists (full outer)",
    "friend-counts-in": "Q05 how often each person is listed (left outer)",
    "access-profile": "Q06 total and distinct pages per visitor",
    "neglectful-all": "Q07 friends, none of them visited",
    "neglectful-any": "Q08 at least one friend never visited",
    "disconnected": "Q09 latest access before as_of - days, or never",
    "disconnected-known": "Q10 whole days since latest access >= days",
    "disconnected-antijoin": "Q11 no access after as_of - days",
    "popular": "Q12 in-degree above edges / people",
    "popular-linked": "Q13 out-degree above mean of linked people",
}
KMEANS_TASKS = {
    "kmeans-step": "Q14 one pass from --centers",
    "kmeans-fixed": "Q15 R passes, truncating mean (--r, --check)",
    "kmeans": "Q16/Q22 passes until converged + closing pass; centers and clustered outputs",
    "seeds-sample": "Q18 k start centers drawn from the points",
    "seeds-uniform": "Q19 k uniform start centers (--lo, --hi)",
    "sweep": "Q20 the (K, R, convergence) grid",
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="murmuration", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("task", choices=sorted({**SOCIAL_TASKS, **KMEANS_TASKS}))
    p.add_argument("--input", required=True, help="folder with the input CSV files")
    p.add_argument("--output", required=True, help="output folder (CSV part files)")
    p.add_argument("--overwrite", action="store_true", help="replace an existing output")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    p.add_argument("--mode", default="FAILFAST", help="CSV parse mode: FAILFAST|DROPMALFORMED|PERMISSIVE")
    p.add_argument("--explain", action="store_true",
                   help="print the formatted physical plan instead of writing (lazy tasks)")
    p.add_argument("--nationality", default="France")
    p.add_argument("--case-sensitive", action="store_true")
    p.add_argument("--n", type=int, default=10)
    p.add_argument("--as-of", default=None, help="'yyyy-MM-dd HH:mm:ss' (Q09–Q11)")
    p.add_argument("--days", type=int, default=14)
    p.add_argument("--points", default="points.csv")
    p.add_argument("--centers", default=None, help="centers file (x,y per line, no header)")
    p.add_argument("--init", choices=("uniform", "sample"), default="uniform",
                   help="start centers without --centers: uniform in [--lo, --hi] "
                        "(as the reference) or k distinct points of the data")
    p.add_argument("--k", type=int, default=10)
    p.add_argument("--r", type=int, default=20)
    p.add_argument("--check", action="store_true", help="stop on convergence")
    p.add_argument("--tolerance", type=float, default=km.DEFAULT_TOLERANCE)
    p.add_argument("--rounding", choices=km.ROUNDINGS, default=None)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--lo", type=int, default=0, help="uniform seeds: lower bound (default 0)")
    p.add_argument("--hi", type=int, default=5000, help="uniform seeds: upper bound (default 5000)")
    p.add_argument("--data-range", action="store_true",
                   help="uniform seeds: draw within the points' own range instead")
    return p


def _start_centers(spark, a, pts):
    if a.centers:
        return read_centers(spark, a.centers)
    if a.init == "uniform":
        lo, hi = (None, None) if a.data_range else (a.lo, a.hi)
        return km.collect_centers(km.kmeans_seeds_uniform(pts, a.k, a.seed, lo, hi))
    return km.collect_centers(km.kmeans_seeds_sample(pts, a.k, a.seed))


def _emit(df, a, mode: str) -> int:
    if a.explain:
        df.explain("formatted")
    else:
        write_csv(df, a.output, mode=mode)
    return 0


def run(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = build_session(a.master, app_name=f"murmuration-{a.task}")
    mode = "overwrite" if a.overwrite else "errorifexists"
    path = lambda name: os.path.join(a.input, name)
    t = a.task
    if t in SOCIAL_TASKS:
        people = read_people(spark, path("pages.csv"), a.mode)
        friends = read_friends(spark, path("friends.csv"), a.mode)
        access = read_access(spark, path("access_logs.csv"), a.mode)
        if t.startswith("disconnected") and not a.as_of:
            raise SystemExit("--as-of is required for the disconnected tasks")
        out = {
            "users-by-nationality": lambda: social.users_by_nationality(
                people, a.nationality, a.case_sensitive),
            "top-pages": lambda: social.top_pages(access, people, a.n),
            "count-by-country": lambda: social.count_by_country(people),
            "friend-counts-out": lambda: social.friend_counts_outdegree(people, friends),
            "friend-counts-in": lambda: social.friend_counts_indegree(people, friends),
            "access-profile": lambda: social.access_profile(access),
            "neglectful-all": lambda: social.neglectful_all(people, friends, access),
            "neglectful-any": lambda: social.neglectful_any(people, friends, access),
            "disconnected": lambda: social.disconnected(people, access, a.as_of, a.days),
            "disconnected-known": lambda: social.disconnected_known(people, access, a.as_of, a.days),
            "disconnected-antijoin": lambda: social.disconnected_antijoin(
                people, access, a.as_of, a.days),
            "popular": lambda: social.popular_people(people, friends),
            "popular-linked": lambda: social.popular_people_linked(people, friends),
        }[t]()
        return _emit(out, a, mode)
    pts = read_points(spark, path(a.points), a.mode)
    if t == "kmeans-step":
        return _emit(km.kmeans_step(pts, _start_centers(spark, a, pts), a.rounding or "half_up"),
                     a, mode)
    elif t == "kmeans-fixed":
        res = km.kmeans_fixed(pts, _start_centers(spark, a, pts), a.r, a.rounding or "trunc",
                              a.check, a.tolerance)
        try:
            write_csv(km.with_run_flags(res), a.output, mode=mode)
        finally:
            res.release()
    elif t == "kmeans":
        res = km.kmeans_converged(pts, _start_centers(spark, a, pts), a.r, a.tolerance,
                                  a.check, a.rounding or "half_up")
        try:
            km.kmeans_outputs(res, pts, a.output, mode=mode)
        finally:
            res.release()
    elif t == "seeds-sample":
        return _emit(km.kmeans_seeds_sample(pts, a.k, a.seed), a, mode)
    elif t == "seeds-uniform":
        lo, hi = (None, None) if a.data_range else (a.lo, a.hi)
        return _emit(km.kmeans_seeds_uniform(pts, a.k, a.seed, lo, hi), a, mode)
    elif t == "sweep":
        write_csv(km.kmeans_sweep(pts, seed=a.seed, tolerance=a.tolerance), a.output, mode=mode)
    return 0


def main() -> None:
    sys.exit(run())


if __name__ == "__main__":
    main()
