"""DuckDB oracle SQL for the k-means queries and the CSV round trip.

Each pass is a pair of materialized CTEs: ``a{j}`` assigns every distinct
point to its nearest center of ``c{j-1}`` by brute force (cross join + arg_min
on ``(d2, center_id)``), ``c{j}`` takes the rounded means and the moves.  The
loop and the stop rule are unrolled into SQL text; no Spark code is shared.
"""

from __future__ import annotations

from murmuration.oracle import VIEWS
from murmuration.sources.bindings import START_CENTERS

TOL = 50.0


def _floor_div(a: str, b: str) -> str:
    return f"(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"


def _mean(s: str, n: str, rounding: str) -> str:
    if rounding == "half_up":
        return _floor_div(f"2 * {s} + {n}", f"2 * {n}")
    return f"({s}) // ({n})"


def _d2(px: str, py: str, cx: str, cy: str) -> str:
    return (f"CAST({px} - {cx} AS DOUBLE) * CAST({px} - {cx} AS DOUBLE) + "
            f"CAST({py} - {cy} AS DOUBLE) * CAST({py} - {cy} AS DOUBLE)")


def _values(centers) -> str:
    rows = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(centers))
    return ("SELECT CAST(center_id AS BIGINT) AS center_id, CAST(x AS BIGINT) AS x, "
            f"CAST(y AS BIGINT) AS y FROM (VALUES {rows}) t(center_id, x, y)")


def _passes(prefix: str, r: int, rounding: str, pts: str = "pts") -> list[str]:
    """CTEs {prefix}a1..ar, {prefix}c1..cr from {prefix}c0."""
    out = []
    for j in range(1, r + 1):
        prev, a, c = f"{prefix}c{j - 1}", f"{prefix}a{j}", f"{prefix}c{j}"
        out.append(f"""{a} AS MATERIALIZED (
  SELECT p.x, p.y, p.w,
         arg_min(c.center_id, {{'d': {_d2('p.x', 'p.y', 'c.x', 'c.y')}, 'c': c.center_id}}) AS center_id
  FROM {pts} p CROSS JOIN {prev} c GROUP BY p.x, p.y, p.w)""")
        out.append(f"""{c} AS MATERIALIZED (
  SELECT s.center_id, s.nx AS x, s.ny AS y, s.n,
         sqrt(CAST(s.nx - o.x AS DOUBLE) * CAST(s.nx - o.x AS DOUBLE)
              + CAST(s.ny - o.y AS DOUBLE) * CAST(s.ny - o.y AS DOUBLE)) AS moved
  FROM (SELECT center_id,
               CAST({_mean('sum(x * w)', 'sum(w)', rounding)} AS BIGINT) AS nx,
               CAST({_mean('sum(y * w)', 'sum(w)', rounding)} AS BIGINT) AS ny,
               CAST(sum(w) AS BIGINT) AS n
        FROM {a} GROUP BY center_id) s
  JOIN {prev} o ON s.center_id = o.center_id)""")
    return out


def _sql(ctes: list[str], body: str) -> str:
    return "WITH " + VIEWS.strip() + ",\n" + ",\n".join(ctes) + "\n" + body.strip()


PTS = "pts AS MATERIALIZED (SELECT x, y, count(*) AS w FROM points GROUP BY x, y)"


def _converged_run(prefix: str, r: int, check: bool, tol: float = TOL) -> list[str]:
    """Stop rule of the converging run: final pass f and its flag."""
    moves = " UNION ALL ".join(f"SELECT {j} AS j, max(moved) AS mv FROM {prefix}c{j}"
                               for j in range(1, r + 1))
    allc = " UNION ALL ".join(f"SELECT {j} AS j, center_id, x, y, n, moved FROM {prefix}c{j}"
                              for j in range(1, r + 1))
    prev_ok = (f"(SELECT max(mv) FROM {prefix}moves WHERE j = {r - 1}) <= {tol}"
               if r > 1 else "false")
    if check:
        fin = f"""{prefix}fin AS (
  SELECT CAST(coalesce(js + 1, {r}) AS BIGINT) AS f,
         CASE WHEN js IS NOT NULL THEN true ELSE coalesce({prev_ok}, false) END AS conv
  FROM (SELECT min(j) AS js FROM {prefix}moves WHERE j <= {r - 1} AND mv <= {tol}) s)"""
    else:
        fin = f"""{prefix}fin AS (
  SELECT CAST({r} AS BIGINT) AS f, coalesce({prev_ok}, false) AS conv)"""
    cin = " UNION ALL ".join(f"SELECT {j} AS j, center_id, x, y FROM {prefix}c{j - 1}"
                             for j in range(1, r + 1))
    return [f"{prefix}moves AS ({moves})", fin,
            f"{prefix}allc AS ({allc})", f"{prefix}allin AS ({cin})"]


def _q14() -> str:
    ctes = [PTS, f"c0 AS ({_values(START_CENTERS)})"] + _passes("", 1, "half_up")
    return _sql(ctes, "SELECT center_id, x, y, n, moved FROM c1")


def _q15() -> str:
    ctes = [PTS, f"c0 AS ({_values(START_CENTERS)})"] + _passes("", 6, "trunc")
    return _sql(ctes, """SELECT center_id, x, y, n, moved, false AS converged,
       CAST(6 AS BIGINT) AS passes FROM c6""")


def _q15_check(r: int = 20, tol: float = TOL) -> str:
    """The pass within the tolerance is the last one, or pass R."""
    ctes = [PTS, f"c0 AS ({_values(START_CENTERS)})"] + _passes("", r, "trunc")
    ctes += _converged_run("", r, True, tol)[:1] + _converged_run("", r, True, tol)[2:3]
    ctes.append(f"""last AS (SELECT CAST(coalesce(min(j) FILTER (WHERE mv <= {tol}), {r}) AS BIGINT) AS f,
         coalesce(bool_or(mv <= {tol}), false) AS conv FROM moves)""")
    return _sql(ctes, """
SELECT a.center_id, a.x, a.y, a.n, a.moved, last.conv AS converged, last.f AS passes
FROM allc a JOIN last ON a.j = last.f""")


def _q16_ctes() -> list[str]:
    return ([PTS, f"c0 AS ({_values(START_CENTERS)})"] + _passes("", 20, "half_up")
            + _converged_run("", 20, True))


def _q16() -> str:
    return _sql(_q16_ctes(), """
SELECT a.center_id, a.x, a.y, a.n, a.moved, fin.conv AS converged, fin.f AS passes
FROM allc a JOIN fin ON a.j = fin.f""")


def _q17_ctes() -> list[str]:
    return _q16_ctes() + [
        "cin AS (SELECT i.center_id, i.x, i.y FROM allin i JOIN fin ON i.j = fin.f)",
        "cout AS (SELECT a.center_id, a.x, a.y, a.n FROM allc a JOIN fin ON a.j = fin.f)",
        f"""asg AS (SELECT p.x, p.y,
         arg_min(c.center_id, {{'d': {_d2('p.x', 'p.y', 'c.x', 'c.y')}, 'c': c.center_id}}) AS center_id
  FROM pts p CROSS JOIN cin c GROUP BY p.x, p.y)"""]


def _q17() -> str:
    return _sql(_q17_ctes(), """
SELECT p.l_orderkey, p.l_linenumber, p.x, p.y, s.center_id, co.x AS center_x, co.y AS center_y
FROM points p JOIN asg s ON p.x = s.x AND p.y = s.y JOIN cout co ON s.center_id = co.center_id""")


def _seed_sample(k: int, seed: int = 42, pts: str = "pts") -> str:
    return f"""SELECT CAST(rn - 1 AS BIGINT) AS center_id, x, y FROM (
  SELECT x, y, row_number() OVER (ORDER BY md5(concat_ws(':', '{seed}', CAST(x AS VARCHAR), CAST(y AS VARCHAR))), x, y) AS rn
  FROM {pts}) s WHERE rn <= {k}"""


def _q18() -> str:
    return _sql([PTS], _seed_sample(10))


def _q19() -> str:
    def axis(a: str) -> str:
        h = (f"CAST(('0x' || substr(md5(concat_ws(':', '42', CAST(id AS VARCHAR), '{a}')), 1, 8)) AS BIGINT)")
        return f"CAST(b.lo_{a} + ({h} % (b.hi_{a} - b.lo_{a} + 1)) AS BIGINT)"
    return _sql(["bnd AS (SELECT min(x) AS lo_x, max(x) AS hi_x, min(y) AS lo_y, max(y) AS hi_y FROM points)"],
                f"""SELECT CAST(id AS BIGINT) AS center_id, {axis('x')} AS x, {axis('y')} AS y
FROM range(10) r(id), bnd b""")


def _q20(ks=(10, 20, 50), rs=(1, 6, 20)) -> str:
    ctes = [PTS]
    r_top = max(rs)
    parts = []
    for k in ks:
        p = f"k{k}_"
        ctes.append(f"{p}c0 AS MATERIALIZED ({_seed_sample(k)})")
        ctes += _passes(p, r_top, "half_up")
        sse = " UNION ALL ".join(
            f"""SELECT {j} AS j, count(DISTINCT a.center_id) AS kf,
       CAST(sum(a.w * ((a.x - c.x) * (a.x - c.x) + (a.y - c.y) * (a.y - c.y))) AS DOUBLE) AS sse
  FROM {p}a{j} a JOIN {p}c{j} c ON a.center_id = c.center_id"""
            for j in range(1, r_top + 1))
        ctes.append(f"{p}stats AS ({sse})")
        moves = " UNION ALL ".join(f"SELECT {j} AS j, max(moved) AS mv FROM {p}c{j}"
                                   for j in range(1, r_top + 1))
        ctes.append(f"{p}moves AS ({moves})")
        for r in rs:
            for check in (False, True):
                if r == 1 and check:
                    continue
                prev_ok = (f"coalesce((SELECT mv FROM {p}moves WHERE j = {r - 1}) <= {TOL}, false)"
                           if r > 1 else "false")
                if check:
                    fin = f"""(SELECT CAST(coalesce(js + 1, {r}) AS BIGINT) AS f,
          CASE WHEN js IS NOT NULL THEN true ELSE {prev_ok} END AS conv
   FROM (SELECT min(j) AS js FROM {p}moves WHERE j <= {r - 1} AND mv <= {TOL}) s)"""
                else:
                    fin = f"(SELECT CAST({r} AS BIGINT) AS f, {prev_ok} AS conv)"
                parts.append(f"""SELECT CAST({k} AS BIGINT) AS k, CAST({r} AS BIGINT) AS r,
       {str(check).lower()} AS convergence, fin.f AS passes, fin.conv AS converged,
       CAST(st.kf AS BIGINT) AS k_final, st.sse AS wcss
FROM {fin} fin JOIN {p}stats st ON st.j = fin.f""")
    return _sql(ctes, "\nUNION ALL\n".join(parts))


def _q21() -> str:
    return "WITH " + VIEWS.strip() + "\nSELECT person_id, name, nationality, country_code, hobby FROM people"


def _q22() -> str:
    return _sql(_q17_ctes(), """
SELECT 'centers' AS output, a.center_id, a.x, a.y,
       a.x AS center_x, a.y AS center_y, a.n, fin.conv AS converged
FROM allc a JOIN fin ON a.j = fin.f
UNION ALL
SELECT 'clustered' AS output, s.center_id, p.x, p.y, co.x AS center_x, co.y AS center_y,
       CAST(1 AS BIGINT) AS n, fin.conv AS converged
FROM points p JOIN asg s ON p.x = s.x AND p.y = s.y JOIN cout co ON s.center_id = co.center_id,
     fin""")


def _q14_many(k: int = 5000) -> str:
    ctes = [PTS, f"c0 AS MATERIALIZED ({_seed_sample(k)})"] + _passes("", 1, "half_up")
    return _sql(ctes, "SELECT center_id, x, y, n, moved FROM c1")


def _q16_fractional(r: int = 20) -> str:
    """The converging run on doubles; ``fsum`` is DuckDB's compensated sum."""
    start = ", ".join(f"({i}, {x / 100.0}, {y * 21.0})" for i, (x, y) in enumerate(START_CENTERS))
    ctes = ["rp AS MATERIALIZED (SELECT l_quantity AS x, l_extendedprice AS y, count(*) AS w "
            "FROM lineitem GROUP BY 1, 2)",
            "c0 AS (SELECT CAST(i AS BIGINT) AS center_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y "
            f"FROM (VALUES {start}) t(i, x, y))"]
    for j in range(1, r + 1):
        ctes.append(f"""a{j} AS MATERIALIZED (
  SELECT p.x, p.y, p.w,
         arg_min(c.center_id, {{'d': {_d2('p.x', 'p.y', 'c.x', 'c.y')}, 'c': c.center_id}}) AS center_id
  FROM rp p CROSS JOIN c{j - 1} c GROUP BY p.x, p.y, p.w)""")
        ctes.append(f"""c{j} AS MATERIALIZED (
  SELECT s.center_id, s.nx AS x, s.ny AS y, s.n, sqrt((s.nx - o.x) ^ 2 + (s.ny - o.y) ^ 2) AS moved
  FROM (SELECT center_id, fsum(x * w) / sum(w) AS nx, fsum(y * w) / sum(w) AS ny,
               CAST(sum(w) AS BIGINT) AS n FROM a{j} GROUP BY center_id) s
  JOIN c{j - 1} o ON s.center_id = o.center_id)""")
    return _sql(ctes + _converged_run("", r, True), """
SELECT a.center_id, round(a.x, 6) AS x, round(a.y, 6) AS y, a.n, round(a.moved, 6) AS moved,
       fin.conv AS converged, fin.f AS passes
FROM allc a JOIN fin ON a.j = fin.f""")


def _q17_embeddings(k: int = 8, r: int = 4) -> str:
    ctes = ["vp AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
            f"""c0 AS MATERIALIZED (SELECT CAST(rn - 1 AS BIGINT) AS center_id, v FROM (
  SELECT v, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) AS rn FROM vp) s WHERE rn <= {k})"""]
    for j in range(1, r + 1):
        ctes.append(f"""a{j} AS MATERIALIZED (
  SELECT p.vec_id, arg_min(c.center_id, {{'d': list_distance(p.v, c.v), 'c': c.center_id}}) AS center_id
  FROM vp p CROSS JOIN c{j - 1} c GROUP BY p.vec_id)""")
        ctes.append(f"""c{j} AS MATERIALIZED (
  SELECT center_id, list(m ORDER BY i) AS v FROM (
    SELECT center_id, i, fsum(v[i]) / count(*) AS m
    FROM vp JOIN a{j} USING (vec_id), range(1, (SELECT max(len(v)) + 1 FROM vp)) q(i)
    GROUP BY center_id, i) GROUP BY center_id)""")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT vec_id, center_id FROM a{r}"


KMEANS_SQL: dict[str, str] = {
    "q14_kmeans_step": _q14(),
    "q14_kmeans_step_5000": _q14_many(),
    "q15_kmeans_fixed": _q15(),
    "q15_kmeans_fixed_check": _q15_check(),
    "q16_kmeans_converged": _q16(),
    "q16_kmeans_fractional": _q16_fractional(),
    "q16_kmeans_resumed": _q16(),
    "q17_kmeans_assign": _q17(),
    "q17_kmeans_embeddings": _q17_embeddings(),
    "q18_kmeans_seeds_sample": _q18(),
    "q19_kmeans_seeds_uniform": _q19(),
    "q20_kmeans_sweep": _q20(),
    "q21_csv_roundtrip": _q21(),
    "q21_lenient_load": """
SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS person_id, ' ' || c_name AS name,
       CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS nation, c_acctbal AS balance,
       CASE WHEN c_custkey % 9 <> 0 THEN TIMESTAMP '2024-01-01 08:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER)) END AS since,
       CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment WHEN c_custkey % 13 = 0 THEN 'over' END AS segment
FROM customer""",
    "q21_lenient_casualties": """
SELECT f.field, CASE f.field
         WHEN 'segment' THEN (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 13 <> 0)
         WHEN '<extra>' THEN (SELECT count(*) FROM customer WHERE c_custkey % 13 = 0)
         ELSE 0 END AS n_missing,
       CASE f.field WHEN 'person_id' THEN (SELECT count(*) FROM customer WHERE c_custkey % 7 = 0)
         WHEN 'since' THEN (SELECT count(*) FROM customer WHERE c_custkey % 9 = 0) ELSE 0 END AS n_uncast
FROM (VALUES ('person_id'), ('name'), ('nation'), ('balance'), ('since'), ('segment'), ('<extra>')) f(field)""",
    "q21_texts_roundtrip": "WITH " + VIEWS.strip() + r"""
SELECT person_id, CASE person_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' || name || chr(9) || ' '
         WHEN 3 THEN '"a", "' || name WHEN 4 THEN name || chr(10) || 'next,line' || chr(10)
         WHEN 5 THEN name || chr(92) ELSE name END AS name, hobby FROM people""",
    "q22_kmeans_outputs": _q22(),
    "q22_kmeans_outputs_one_job": _q22(),
}
