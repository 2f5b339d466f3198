"""Operators against plain-Python brute force on random small inputs.

Each seed draws a social graph with duplicate and self edges, owners and
targets outside ``people``, people who never accessed anything, and random
integer point sets; every answer is recomputed here by direct enumeration.
"""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest

from murmuration import schemas
from murmuration.operators import clustering as km
from murmuration.operators import social

SEEDS = [1, 2, 3]
AS_OF = dt.datetime(2024, 3, 1, 12, 0, 0)


def draw(seed):
    rnd = random.Random(seed)
    ids = rnd.sample(range(40), 25)
    people = [(i, f"p{i}", rnd.choice(["A", " a", "B", "C "]), 1, rnd.choice(["x", "y"]))
              for i in ids]
    edges = [(rnd.randrange(45), rnd.randrange(45)) for _ in range(120)]
    edges += edges[:10]  # repeats
    base = dt.datetime(2024, 1, 1)
    access = [(rnd.randrange(45), rnd.randrange(45),
               base + dt.timedelta(seconds=rnd.randrange(70 * 86400))) for _ in range(150)]
    return people, edges, access


def frames(spark, people, edges, access):
    p = spark.createDataFrame(people, schemas.PEOPLE_SCHEMA)
    f = spark.createDataFrame([(i, s, d, dt.date(2020, 1, 1), "r") for i, (s, d) in enumerate(edges)],
                              schemas.FRIENDS_SCHEMA)
    a = spark.createDataFrame([(i, s, d, "view", t) for i, (s, d, t) in enumerate(access)],
                              schemas.ACCESS_SCHEMA)
    return p, f, a


@pytest.mark.parametrize("seed", SEEDS)
def test_social_against_brute_force(spark, seed):
    people, edges, access = draw(seed)
    p, f, a = frames(spark, people, edges, access)
    names = {i: n for i, n, *_ in people}

    # Q01 (trimmed, case-folded)
    got = sorted(tuple(r) for r in social.users_by_nationality(p, "a").collect())
    assert got == sorted((n, h) for _, n, nat, _, h in people if nat.strip().lower() == "a")

    # Q02
    cnt = Counter(d for _, d, _ in access)
    top = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    exp = {(pg, c, rank) for rank, (pg, c) in enumerate(top, 1) if pg in names}
    got = {(r["page_id"], r["access_count"], r["page_rank"]) for r in social.top_pages(a, p, 5).collect()}
    assert got == exp

    # Q03
    got = {r["nationality"]: r["n_people"] for r in social.count_by_country(p).collect()}
    assert got == dict(Counter(None if nat is None else nat.strip("".join(map(chr, range(33))))
                               for _, _, nat, _, _ in people))

    # Q04 / Q05
    out = Counter(s for s, _ in edges)
    exp = {i: (n, out.get(i, 0)) for i, n in names.items()}
    exp.update({s: ("Unknown", c) for s, c in out.items() if s not in names})
    got = {r["person_id"]: (r["name"], r["friend_count"])
           for r in social.friend_counts_outdegree(p, f).collect()}
    assert got == exp
    inn = Counter(d for _, d in edges)
    got = {r["person_id"]: r["friend_count"] for r in social.friend_counts_indegree(p, f).collect()}
    assert got == {i: inn.get(i, 0) for i in names}

    # Q06
    pages = defaultdict(list)
    for s, d, _ in access:
        pages[s].append(d)
    got = {r["person_id"]: (r["total_accesses"], r["distinct_pages"])
           for r in social.access_profile(a).collect()}
    assert got == {s: (len(v), len(set(v))) for s, v in pages.items()}

    # Q07 / Q08
    fr = defaultdict(set)
    for s, d in edges:
        fr[s].add(d)
    vis = {s: set(v) for s, v in pages.items()}
    exp7 = {s: names.get(s, "Unknown") for s, fs in fr.items() if not fs & vis.get(s, set())}
    got7 = {r["person_id"]: r["name"] for r in social.neglectful_all(p, f, a).collect()}
    assert got7 == exp7
    exp8 = {(s, names[s]) for s, fs in fr.items() if fs - vis.get(s, set()) and s in names}
    got8 = {(r["person_id"], r["name"]) for r in social.neglectful_any(p, f, a).collect()}
    assert got8 == exp8 and len(got8) == social.neglectful_any(p, f, a).count()

    # Q09 / Q10 / Q11
    cutoff = AS_OF - dt.timedelta(days=14)
    latest = {}
    for s, _, t in access:
        latest[s] = max(latest.get(s, t), t)
    as_of = AS_OF.strftime("%Y-%m-%d %H:%M:%S")
    exp9 = {i for i in names if i not in latest or latest[i] < cutoff}
    assert {r["person_id"] for r in social.disconnected(p, a, as_of).collect()} == exp9
    exp10 = {i for i in names if i in latest
             and math.floor((AS_OF - latest[i]).total_seconds() / 86400) >= 14}
    assert {r["person_id"] for r in social.disconnected_known(p, a, as_of).collect()} == exp10
    exp11 = {i for i in names if not any(s == i and t > cutoff for s, _, t in access)}
    assert {r["person_id"] for r in social.disconnected_antijoin(p, a, as_of).collect()} == exp11

    # Q12 / Q13
    avg = len(edges) / len(people)
    exp12 = {(i, names[i], c) for i, c in inn.items() if c > avg and i in names}
    got12 = {(r["person_id"], r["name"], r["friend_count"]) for r in social.popular_people(p, f).collect()}
    assert got12 == exp12
    mean = sum(out.values()) / len(out)
    exp13 = {(s, names[s]) for s, c in out.items() if c > mean and s in names}
    got13 = {(r["person_id"], r["name"]) for r in social.popular_people_linked(p, f).collect()}
    assert got13 == exp13


def brute_pass(points, centers, rounding):
    cs = sorted(centers)
    sums = {}
    for x, y in points:
        cid = min(cs, key=lambda c: (float(x - c[1]) ** 2 + float(y - c[2]) ** 2, c[0]))[0]
        sx, sy, n = sums.get(cid, (0, 0, 0))
        sums[cid] = (sx + x, sy + y, n + 1)
    out = {}
    for cid, (sx, sy, n) in sums.items():
        if rounding == "half_up":
            out[cid] = ((2 * sx + n) // (2 * n), (2 * sy + n) // (2 * n), n)
        else:
            q = lambda s: abs(s) // n * (1 if s >= 0 else -1)
            out[cid] = (q(sx), q(sy), n)
    return out


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("rounding", ["half_up", "trunc"])
def test_kmeans_against_brute_force(spark, seed, rounding):
    rnd = random.Random(seed)
    pts = [(rnd.randrange(-50, 60), rnd.randrange(-40, 70)) for _ in range(300)]
    pts += pts[:40]  # duplicates
    centers = [(i * 3, rnd.randrange(-50, 60), rnd.randrange(-40, 70)) for i in range(6)]
    centers.append((100, centers[0][1], centers[0][2]))  # a duplicate center
    df = spark.createDataFrame(pts, schemas.POINTS_SCHEMA)
    got = {r["center_id"]: (r["x"], r["y"], r["n"]) for r in km.kmeans_step(df, centers, rounding).collect()}
    assert got == brute_pass(pts, centers, rounding)

    # the converging loop, replayed by brute force
    cur, hist = centers, []
    for _ in range(8):
        nxt = brute_pass(pts, cur, rounding)
        old = {c[0]: (c[1], c[2]) for c in cur}
        hist.append(max(math.dist(old[k], v[:2]) for k, v in nxt.items()))
        cur = sorted((k, v[0], v[1]) for k, v in nxt.items())
    res = km.kmeans_fixed(df, centers, r=8, rounding=rounding)
    try:
        got = sorted((r["center_id"], r["x"], r["y"]) for r in res.centers.collect())
        assert got == cur and res.history == pytest.approx(hist[:-1])
    finally:
        res.release()
