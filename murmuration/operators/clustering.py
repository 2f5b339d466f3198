"""Exact integer k-means on 2-D points.

Execution model
---------------
* The points are reduced once to *weighted distinct points* ``(x, y, w)``
  (an exact rewrite: a cluster's sums are ``Σ w·x``, ``Σ w·y``, ``Σ w``) and
  written once to the shared scratch folder, so a lost executor costs a re-read
  of that table, never a re-run of the scan; ``release`` deletes it.
* One pass = one Spark job: every point picks its nearest center (an
  Arrow-batched NumPy argmin by default, see ``functions.vectorized`` for
  the measurement; ``argmin="builtin"`` uses a codegen'd ``least`` over the
  centers inlined as literals), a partial + final ``groupBy(center_id)``
  sums, and at most K rows come back to the driver.  The centers re-enter
  the next pass as literals, so the plan and its lineage stay the same size
  at every pass.
* Means are exact integers (``half_up``: ``floor(s/n + 1/2)``, ``trunc``:
  ``s div n``); distances for the argmin are squared, which orders like the
  Euclidean distance, and the lowest center id wins ties.

Only centers that receive points survive a pass (K may shrink), as in the
the definition; ``center_id`` is stable across passes so the survivors are known.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.functions import hash_to_range, nearest_center
from murmuration.functions.vectorized import (
    nearest_center_arrow,
    nearest_center_indexed,
    nearest_centers_arrow,
)
from murmuration.operators.progress import PassLog
from murmuration.session import drop_path, scratch_path

Center = tuple[int, int, int]  # (center_id, x, y)
ROUNDINGS = ("half_up", "trunc")
DEFAULT_TOLERANCE = 50.0
ARGMIN_METHODS = ("arrow", "builtin", "indexed")  # indexed: for thousands of centers
#: Rows in a file of the points' table: small tables still give every core a
#: file, large ones have files of about 64 MB.
ROWS_PER_FILE = (25_000, 4_000_000)
POINT_BYTES = 24

PASS_SCHEMA = T.StructType([
    T.StructField("center_id", T.LongType()),
    T.StructField("x", T.LongType()),
    T.StructField("y", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("moved", T.DoubleType()),
    T.StructField("sse", T.DoubleType()),
])


# ------------------------------------------------------------------ points
class WeightedPoints:
    """Points with multiplicities as a table in the shared scratch folder.

    Written once and read by every pass, so a lost executor costs its own tasks
    only.  ``dedupe`` merges equal points first (one shuffle on both
    coordinates): it pays where points repeat, as on an integer grid, and not
    where nearly all differ.  A point that lacks a coordinate belongs to no
    cluster and is left out, here as in every operator of this module.

    Use as a context manager, or call ``release``: it deletes the table.
    """

    def __init__(self, points: DataFrame, dedupe: bool = True, x: str = "x", y: str = "y"):
        wp = _weighted(points, x, y)
        if dedupe:
            wp = wp.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
        spark = points.sparkSession
        self._path = scratch_path(spark, "points")
        wp.write.option("maxRecordsPerFile", _rows_per_file(points)).parquet(self._path)
        self.df = spark.read.schema(wp.schema).parquet(self._path)

    def release(self) -> None:
        drop_path(self.df.sparkSession, self._path)

    def __enter__(self) -> WeightedPoints:
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def _rows_per_file(points: DataFrame) -> int:
    """From the planner's size of the points: four files a core, within ROWS_PER_FILE."""
    size = int(str(points._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = points.sparkSession.sparkContext.defaultParallelism
    return min(max(size // POINT_BYTES // (4 * cores), ROWS_PER_FILE[0]), ROWS_PER_FILE[1])


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _check_points(points: DataFrame, x: str = "x", y: str = "y") -> None:
    """Coordinates must be integral: means are exact integer arithmetic."""
    for c in (x, y):
        if c not in points.columns:
            raise ValueError(f"points need a column {c!r}")
        if not isinstance(points.schema[c].dataType, _INTEGRAL):
            raise TypeError(f"point column {c!r} must be integral, "
                            f"not {points.schema[c].dataType.simpleString()}")


def _weighted(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Points as (x, y, w=1) without any shuffle; incomplete ones are left out."""
    _check_points(points, x, y)
    return points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast(T.LongType()).alias("x"), F.col(y).cast(T.LongType()).alias("y"),
        F.lit(1).cast(T.LongType()).alias("w"))


# ------------------------------------------------------------------ one pass
def _check_centers(centers: Sequence[Center]) -> list[Center]:
    cs = [(int(i), int(x), int(y)) for i, x, y in centers]
    if not cs:
        raise ValueError("at least one center is needed")
    if len({c[0] for c in cs}) != len(cs):
        raise ValueError("center ids must be unique")
    return cs


def assign_center(x: F.Column, y: F.Column, centers: Sequence[Center],
                  argmin: str = "arrow") -> F.Column:
    """Nearest-center id column (lowest id on ties)."""
    if argmin not in ARGMIN_METHODS:
        raise ValueError(f"argmin must be one of {ARGMIN_METHODS}")
    cs = _check_centers(centers)
    if argmin == "builtin":
        return nearest_center(x, y, cs)
    if argmin == "indexed":
        return nearest_center_indexed(x, y, cs)
    return nearest_center_arrow(x, y, cs)


def pass_frame(wpoints: DataFrame, centers: Sequence[Center], rounding: str = "half_up",
               with_sse: bool = False, argmin: str = "arrow") -> DataFrame:
    """One Lloyd pass as a lazy DataFrame over weighted points ``(x, y, w)``.

    Columns: ``center_id, x, y, n, moved`` (+ ``sse`` with ``with_sse``): the
    new rounded mean of every center that received points, its size, and the
    distance it moved.  ``sse`` is Σ w·|p − new center|² of the cluster, taken
    exactly from per-cluster moment sums.
    """
    return multi_pass_frame(wpoints, [centers], rounding, with_sse, argmin)


def _lookup(values: dict[int, int], key: str) -> str:
    """SQL for ``values[key]``: an array indexed by position where the ids are
    dense (as the library numbers them), so a lookup does not scan K entries."""
    span = max(values, default=0) + 1
    if min(values, default=0) >= 0 and span <= 4 * len(values):
        items = ", ".join(f"CAST({values[i]} AS BIGINT)" if i in values else "CAST(NULL AS BIGINT)"
                          for i in range(span))
        return f"get(array({items}), CAST({key} AS INT))"
    kv = ", ".join(f"CAST({k} AS BIGINT), CAST({v} AS BIGINT)" for k, v in values.items())
    return f"try_element_at(map({kv}), {key})"


def multi_pass_frame(wpoints: DataFrame, runs: Sequence[Sequence[Center]],
                     rounding: str = "half_up", with_sse: bool = False,
                     argmin: str = "arrow", with_moved: bool = True) -> DataFrame:
    """One pass of several independent runs over the same points, in one job.

    Each point is assigned once per run (one Arrow round trip for all runs),
    then ``groupBy(run, center_id)`` sums; the result has a ``run`` column
    (index into ``runs``) when there is more than one run.  Used by the
    sweep, whose runs share the points.  The plan is built in three steps
    (assign, aggregate, project) to keep driver-side planning per pass short.
    """
    if rounding not in ROUNDINGS:
        raise ValueError(f"rounding must be one of {ROUNDINGS}")
    if not runs:
        raise ValueError("at least one run is needed")
    runs = [_check_centers(cs) for cs in runs]
    x, y = F.col("x"), F.col("y")
    multi = len(runs) > 1
    if not multi:
        assigned = wpoints.select("x", "y", "w",
                                  assign_center(x, y, runs[0], argmin).alias("center_id"))
        keys = ["center_id"]
    else:
        if argmin == "arrow":
            # one Python call per batch for all runs (weighted points have
            # no null coordinates)
            both = nearest_centers_arrow(x, y, runs).alias("_ids")
            ids = [F.col("_ids").getField(f"_c{i}").alias(f"_c{i}") for i in range(len(runs))]
            staged = wpoints.select("x", "y", "w", both).select("x", "y", "w", *ids)
        else:
            ids = [assign_center(x, y, cs, argmin).alias(f"_c{i}") for i, cs in enumerate(runs)]
            staged = wpoints.select("x", "y", "w", *ids)
        pairs = F.array(*[F.struct(F.lit(i).alias("run"), F.col(f"_c{i}").alias("center_id"))
                          for i in range(len(runs))])
        assigned = staged.select("x", "y", "w", F.inline(pairs))
        keys = ["run", "center_id"]
    # exact sums of LONGs as LONG sums of three limbs (22, 21, 21 bits): no sum
    # passes 63 bits below 2^41 rows a cluster
    limbs = ("shiftright({}, 42)", "(shiftright({}, 21) & 2097151)", "({} & 2097151)")
    aggs = [f"sum({limb.format(c)} * w) AS s{c}{i}" for c in "xy" for i, limb in enumerate(limbs)]
    aggs.append("sum(w) AS n")
    wide = "CAST({} AS DECIMAL(20,0))"
    if with_sse:
        aggs += [f"sum(CAST({wide.format('x')} * x AS DECIMAL(38,0)) * w) AS sxx",
                 f"sum(CAST({wide.format('y')} * y AS DECIMAL(38,0)) * w) AS syy"]
    g = assigned.groupBy(*keys).agg(*[F.expr(a) for a in aggs])
    whole = [f"CAST(CAST(s{c}0 AS DECIMAL(38,0)) * {1 << 42} + CAST(s{c}1 AS DECIMAL(38,0)) "
             f"* {1 << 21} + s{c}2 AS DECIMAL(38,0)) AS s{c}" for c in "xy"]
    g = g.selectExpr(*keys, *whole, "n", *(["sxx", "syy"] if with_sse else []))

    # Exact integer means: half-up = floor((2s + n) / 2n), trunc = s div n.
    def mean(sc: str) -> str:
        if rounding == "half_up":
            a, b = f"(2 * {sc} + n)", "(2 * n)"
            return f"CAST((({a} - pmod({a}, {b})) div {b}) AS BIGINT)"
        return f"CAST(({sc} div n) AS BIGINT)"

    nx, ny = mean("sx"), mean("sy")
    cols = [*keys, f"{nx} AS x", f"{ny} AS y", "n"]
    if with_moved:
        span = max(c[0] for cs in runs for c in cs) + 1
        key = f"run * CAST({span} AS BIGINT) + center_id" if multi else "center_id"

        def old(idx: int) -> str:
            return _lookup({r * span + c[0]: c[idx] for r, cs in enumerate(runs) for c in cs}, key)

        dx, dy = f"CAST({nx} - {old(1)} AS DOUBLE)", f"CAST({ny} - {old(2)} AS DOUBLE)"
        cols.append(f"sqrt({dx} * {dx} + {dy} * {dy}) AS moved")
    if with_sse:
        def part(s2: str, s1: str, m: str) -> str:
            m = f"CAST({m} AS DECIMAL(38,0))"
            return f"({s2} - CAST({s1} AS DECIMAL(38,0)) * {m} * 2 + CAST(n AS DECIMAL(38,0)) * {m} * {m})"

        cols.append(f"CAST({part('sxx', 'sx', nx)} + {part('syy', 'sy', ny)} AS DOUBLE) AS sse")
    return g.selectExpr(*cols)


@dataclass
class PassStats:
    centers_in: list[Center]
    centers_out: list[Center]
    sizes: dict[int, int]
    moved: dict[int, float]
    sse: float | None = None

    @property
    def max_moved(self) -> float:
        return max(self.moved.values()) if self.moved else 0.0


def _moved(new: tuple[int, int], old: tuple[int, int]) -> float:
    """Distance moved, with the same IEEE steps as the Spark expression
    (LONG differences cast to DOUBLE, squared, summed, square root)."""
    dx, dy = float(new[0] - old[0]), float(new[1] - old[1])
    return math.sqrt(dx * dx + dy * dy)


def _stats(rows, centers: Sequence[Center], with_sse: bool) -> PassStats:
    rows = sorted(rows, key=lambda r: r["center_id"])
    old = {c[0]: (c[1], c[2]) for c in centers}
    return PassStats(
        centers_in=list(centers),
        centers_out=[(r["center_id"], r["x"], r["y"]) for r in rows],
        sizes={r["center_id"]: r["n"] for r in rows},
        moved={r["center_id"]: _moved((r["x"], r["y"]), old[r["center_id"]]) for r in rows},
        sse=(sum(r["sse"] for r in rows) if with_sse else None))


def run_pass(wpoints: DataFrame, centers: Sequence[Center], rounding: str,
             with_sse: bool = False, argmin: str = "arrow") -> PassStats:
    """Run one pass and bring back its <= K result rows."""
    return run_passes(wpoints, [centers], rounding, with_sse, argmin)[0]


def run_passes(wpoints: DataFrame, runs: Sequence[Sequence[Center]], rounding: str,
               with_sse: bool = False, argmin: str = "arrow") -> list[PassStats]:
    """One pass of every run in one job; brings back <= sum(K) rows."""
    rows = multi_pass_frame(wpoints, runs, rounding, with_sse, argmin, with_moved=False).collect()
    by_run: dict[int, list] = {i: [] for i in range(len(runs))}
    for r in rows:
        by_run[r["run"] if len(runs) > 1 else 0].append(r)
    return [_stats(by_run[i], runs[i], with_sse) for i in range(len(runs))]


# ------------------------------------------------------------------ Q14
def kmeans_step(points: DataFrame, centers: Sequence[Center],
                rounding: str = "half_up", argmin: str = "arrow") -> DataFrame:
    """One pass from ``centers`` (Q14): ``center_id, x, y, n, moved``.

    Lazy: a single map stage plus a K-row shuffle, no driver round trip.
    """
    return pass_frame(_weighted(points), centers, rounding, argmin=argmin)


# ------------------------------------------------------------------ loops
@dataclass
class KMeansResult:
    """Outcome of a k-means run.

    ``centers`` holds the final centers (``center_id, x, y, n, moved``) as a
    lazy frame of the last pass; ``centers_in`` the centers that pass started
    from (the points' assignment); ``history`` the largest move of every pass
    run before it.
    """

    centers: DataFrame
    centers_in: list[Center]
    passes: int
    converged: bool
    history: list[float] = field(default_factory=list)
    weighted: WeightedPoints | None = None
    argmin: str = "arrow"

    def release(self) -> None:
        """Run the final pass, if that is still to do, and delete the points' table."""
        if self.weighted is not None:
            self.finalize()
            self.weighted.release()
            self.weighted = None

    def finalize(self) -> KMeansResult:
        """Run the final pass once and keep its <= K rows, so later uses
        (centers output, assignment lookup) do not recompute it."""
        rows = self.centers.select("center_id", "x", "y", "n", "moved").collect()
        spark = self.centers.sparkSession
        self.centers = spark.createDataFrame(
            [tuple(r) + (None,) for r in rows], PASS_SCHEMA).drop("sse")
        return self


def _small_frame(spark: SparkSession, stats: PassStats) -> DataFrame:
    rows = [(cid, x, y, stats.sizes[cid], stats.moved[cid], None)
            for cid, x, y in stats.centers_out]
    return spark.createDataFrame(rows, PASS_SCHEMA).drop("sse")


def kmeans_fixed(points: DataFrame, centers: Sequence[Center], r: int,
                 rounding: str = "trunc", check: bool = False,
                 tolerance: float = DEFAULT_TOLERANCE, dedupe: bool = True,
                 argmin: str = "arrow",
                 weighted: WeightedPoints | None = None) -> KMeansResult:
    """R passes, optionally stopping early (Q15).

    With ``check`` the run stops after the first pass in which every center
    moved at most ``tolerance`` (never when ``r == 1``), without a closing
    pass, and ``converged`` reports whether the last pass run was within the
    tolerance.  The returned centers are those of the last pass run.
    ``weighted`` reuses points prepared once for several runs (the caller
    keeps ownership: releasing the result leaves them in place).
    """
    if r < 1:
        raise ValueError("r must be >= 1")
    wp = weighted or WeightedPoints(points, dedupe=dedupe)
    owned = wp if weighted is None else None
    cur = _check_centers(centers)
    history: list[float] = []
    for i in range(r):
        if i == r - 1 and not (check and r > 1):
            # nothing to decide after the last pass: return it lazily
            frame = pass_frame(wp.df, cur, rounding, argmin=argmin)
            return KMeansResult(frame, cur, i + 1, False, history, owned, argmin)
        st = run_pass(wp.df, cur, rounding, argmin=argmin)
        if not st.centers_out:  # no points at all: nothing to iterate on
            return KMeansResult(_small_frame(points.sparkSession, st), cur, i + 1, False,
                                history, owned, argmin)
        history.append(st.max_moved)
        if i == r - 1 or (check and r > 1 and st.max_moved <= tolerance):
            return KMeansResult(_small_frame(points.sparkSession, st), cur, i + 1,
                                st.max_moved <= tolerance, history, owned, argmin)
        cur = st.centers_out
    raise AssertionError("unreachable")


def kmeans_converged(points: DataFrame, centers: Sequence[Center], r_max: int,
                     tolerance: float = DEFAULT_TOLERANCE, check: bool = True,
                     rounding: str = "half_up", dedupe: bool = True,
                     argmin: str = "arrow",
                     weighted: WeightedPoints | None = None,
                     log_path: str | None = None) -> KMeansResult:
    """Passes until every center moved at most ``tolerance``, then one closing
    pass (Q16).

    With ``log_path`` each measured pass's centers are kept below it, and a run
    with the same settings goes on after the last complete pass (same points;
    the caller names another folder for others).

    Passes i = 0 … r_max−1.  At i = r_max−1 the closing pass runs and
    ``converged`` says whether the previous pass's moves were all within the
    tolerance (false for r_max = 1: nothing was measured).  Before that, when
    ``check`` is on and a pass's moves are all within the tolerance, one more
    (closing) pass runs with ``converged = True``.  The closing pass updates
    the centers too; it is returned lazily.
    """
    if r_max < 1:
        raise ValueError("r_max must be >= 1")
    wp = weighted or WeightedPoints(points, dedupe=dedupe)
    owned = wp if weighted is None else None
    cur = _check_centers(centers)
    history: list[float] = []
    log = PassLog(wp.df.sparkSession, log_path, {
        "centers": cur, "rounding": rounding, "tolerance": tolerance, "check": check,
        "kind": "integers"}) if log_path else None
    for i in range(r_max):
        if i == r_max - 1:
            conv = bool(history) and history[-1] <= tolerance
            return KMeansResult(pass_frame(wp.df, cur, rounding, argmin=argmin), cur, i + 1,
                                conv, history, owned, argmin)
        st = _logged_pass(log, i + 1, wp.df, cur, rounding, argmin)
        if not st.centers_out:  # no points at all: nothing to iterate on
            return KMeansResult(_small_frame(points.sparkSession, st), cur, i + 1, False,
                                history, owned, argmin)
        history.append(st.max_moved)
        cur = st.centers_out
        if check and st.max_moved <= tolerance:
            return KMeansResult(pass_frame(wp.df, cur, rounding, argmin=argmin), cur, i + 2,
                                True, history, owned, argmin)
    raise AssertionError("unreachable")


def _logged_pass(log: PassLog | None, number: int, wpoints: DataFrame,
                 centers: list[Center], rounding: str, argmin: str) -> PassStats:
    """A pass, taken from the log where it is complete there."""
    if log is None:
        return run_pass(wpoints, centers, rounding, argmin=argmin)

    def run() -> dict:
        st = run_pass(wpoints, centers, rounding, argmin=argmin)
        return {"rows": [[c, x, y, st.sizes[c]] for c, x, y in st.centers_out]}

    rows = log.once(number, run)["rows"]
    return _stats([{"center_id": c, "x": x, "y": y, "n": n} for c, x, y, n in rows], centers, False)


def with_run_flags(result: KMeansResult) -> DataFrame:
    """The final centers with the run's ``converged`` flag and pass count."""
    return result.centers.select(
        "center_id", "x", "y", "n", "moved",
        F.lit(result.converged).alias("converged"),
        F.lit(result.passes).cast(T.LongType()).alias("passes"))


# ------------------------------------------------------------------ Q17
def kmeans_assign(points: DataFrame, result: KMeansResult,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Every point with its assigned center and that center's final position
    (Q17).

    The assignment is the argmin against the centers the final pass started
    from; the final position is that pass's new mean.  The final centers (at
    most K rows) are brought to the driver once and looked up per point from
    a map literal: a single narrow projection, the points are never shuffled
    or joined.  (A join on the computed id would make the optimizer infer a
    null filter on it and evaluate the argmin twice.)
    """
    final = collect_centers(result.centers)
    whole = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    assigned = whole.select(*keep, "x", "y",
                             assign_center(F.col("x"), F.col("y"), result.centers_in,
                                           result.argmin).alias("center_id"))

    def coord(idx: int) -> str:
        return _lookup({c[0]: c[idx] for c in final}, "center_id")

    # every center a point is assigned to received that point in the final
    # pass, so the lookup always hits (no filter: it would be pushed below
    # the projection and re-run the argmin)
    return assigned.selectExpr(*keep, "x", "y", "center_id",
                               f"{coord(1)} AS center_x", f"{coord(2)} AS center_y")


# ------------------------------------------------------------------ Q18/Q19
def kmeans_seeds_sample(points: DataFrame, k: int, seed: int = 42,
                        distinct: bool = True) -> DataFrame:
    """k distinct points of the data as start centers, reproducibly (Q18).

    Order: md5 of ``"seed:x:y"``, then x, y.  ``orderBy().limit(k)`` is a
    TakeOrderedAndProject: every task keeps k rows, no global sort.  The
    sample for k is a prefix of the sample for any larger k.  Pass
    ``distinct=False`` when the points are already distinct (weighted points).
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    d = points.select("x", "y").filter("x IS NOT NULL AND y IS NOT NULL")
    if distinct:
        d = d.distinct()
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("x").cast("string"),
                          F.col("y").cast("string")))
    top = d.select("x", "y", h.alias("h")).orderBy("h", "x", "y").limit(k)
    w = Window.orderBy("h", "x", "y")  # over <= k rows
    return top.select((F.row_number().over(w) - 1).cast(T.LongType()).alias("center_id"),
                      "x", "y")


def kmeans_seeds_uniform(points: DataFrame, k: int, seed: int = 42,
                         lo: int | None = None, hi: int | None = None) -> DataFrame:
    """k integer centers drawn uniformly in ``[lo, hi]`` per axis (Q19).

    Without bounds, each axis uses the points' own range (lazy scalar
    subqueries, one aggregate over the points).  Values come from the md5 of
    ``"seed:id:axis"``, so any engine reproduces them.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = points.sparkSession
    if None in (lo, hi):
        # all four bounds from one aggregate over the points (one scalar
        # subquery, evaluated once however often it is referenced)
        box = points.select(F.struct(F.min("x").alias("lo_x"), F.max("x").alias("hi_x"),
                                     F.min("y").alias("lo_y"), F.max("y").alias("hi_y"))).scalar()

    def bound(val, field_name):
        return F.lit(int(val)) if val is not None else box.getField(field_name)

    ids = spark.range(k).select(F.col("id").alias("center_id"))
    return ids.select(
        "center_id",
        hash_to_range(bound(lo, "lo_x"), bound(hi, "hi_x"),
                      F.lit(str(seed)), F.col("center_id"), F.lit("x")).alias("x"),
        hash_to_range(bound(lo, "lo_y"), bound(hi, "hi_y"),
                      F.lit(str(seed)), F.col("center_id"), F.lit("y")).alias("y"))


def collect_centers(seeds: DataFrame) -> list[Center]:
    """The K rows of a centers frame, K being the caller's own number."""
    return [(r["center_id"], r["x"], r["y"])
            for r in seeds.select("center_id", "x", "y").orderBy("center_id").collect()]


# ------------------------------------------------------------------ Q20
SWEEP_KS = (10, 20, 50)
SWEEP_RS = (1, 6, 20)

SWEEP_SCHEMA = T.StructType([
    T.StructField("k", T.LongType()),
    T.StructField("r", T.LongType()),
    T.StructField("convergence", T.BooleanType()),
    T.StructField("passes", T.LongType()),
    T.StructField("converged", T.BooleanType()),
    T.StructField("k_final", T.LongType()),
    T.StructField("wcss", T.DoubleType()),
])


def sweep_cells(ks: Iterable[int] = SWEEP_KS, rs: Iterable[int] = SWEEP_RS,
                convergence: Iterable[bool] = (False, True)) -> list[tuple[int, int, bool]]:
    """The (K, R, convergence) grid, without R = 1 with convergence on."""
    return [(k, r, c) for k in ks for r in rs for c in convergence if not (r == 1 and c)]


def _closing_index(history: list[float], r: int, check: bool, tol: float) -> tuple[int, bool]:
    """Final pass number and ``converged`` flag of a Q16 run with R = r, from the
    moves of the passes of one trajectory (``history[j-1]`` = pass j)."""
    if check:
        for j in range(1, r):
            if history[j - 1] <= tol:
                return j + 1, True
    conv = r > 1 and history[r - 2] <= tol
    return r, conv


def kmeans_sweep(points: DataFrame, ks: Iterable[int] = SWEEP_KS,
                 rs: Iterable[int] = SWEEP_RS, convergence: Iterable[bool] = (False, True),
                 seed: int = 42, tolerance: float = DEFAULT_TOLERANCE,
                 rounding: str = "half_up", argmin: str = "arrow",
                 weighted: WeightedPoints | None = None) -> DataFrame:
    """The parameter sweep (Q20): one row per (K, R, convergence) of the grid.

    Start centers per K: ``kmeans_seeds_sample(points, K, seed)``.  Every run
    of a given K follows the same trajectory of centers (passes only depend
    on the previous centers), so each K is run once for max(R) passes and
    every cell is read off that trajectory: passes run, converged flag,
    surviving K and the within-cluster sum of squares of its closing pass.
    The trajectories of all K advance together, one job per step.
    """
    ks, rs, convergence = list(ks), list(rs), list(convergence)
    cells = sweep_cells(ks, rs, convergence)
    r_top = max(rs)
    out = []
    with (nullcontext(weighted) if weighted is not None else WeightedPoints(points)) as wp:
        # the samples of all K are prefixes of the largest one: one job
        top = collect_centers(kmeans_seeds_sample(wp.df, max(ks), seed, distinct=False))
        if not top:
            raise ValueError("the points are empty: nothing to cluster")
        cur = [top[:k] for k in ks]
        trajs: list[list[PassStats]] = [[] for _ in ks]
        for j in range(1, r_top + 1):
            # A cell's closing pass is pass R, or the pass right after the
            # first pass within tolerance; only those need the (DECIMAL) sums
            # of squares, and both are known before pass j runs.
            first_conv = [pass_no for pass_no in (
                next((i + 1 for i, st in enumerate(t) if st.max_moved <= tolerance), None)
                for t in trajs) if pass_no is not None]
            need_sse = j in rs or (j - 1) in first_conv
            # all K's advance together: one scan of the points per step
            for traj, st in zip(trajs, run_passes(wp.df, cur, rounding, need_sse, argmin)):
                traj.append(st)
            cur = [t[-1].centers_out for t in trajs]
            if not all(cur):
                raise ValueError("the points are empty: nothing to cluster")
        for k, traj in zip(ks, trajs):
            history = [s.max_moved for s in traj]
            for ck, r, c in cells:
                if ck != k:
                    continue
                f, conv = _closing_index(history, r, c, tolerance)
                last = traj[f - 1]
                out.append((k, r, c, f, conv, len(last.centers_out), float(last.sse)))
    return points.sparkSession.createDataFrame(out, SWEEP_SCHEMA)


# ------------------------------------------------------------------ Q22
def tagged_outputs(result: KMeansResult, points: DataFrame) -> DataFrame:
    """Both outputs of a run as one table: ``output`` (centers or clustered),
    center_id, x, y, center_x, center_y, n, converged.

    A center is its own point with weight n, a clustered row has weight 1.  The
    centers (at most K) are rows of the plan, so the points are scanned once.
    """
    final = result.finalize().centers.collect()
    spark = points.sparkSession
    kinds = ("output string, center_id long, x long, y long, center_x long, center_y long, "
             "n long, converged boolean")
    centers = spark.createDataFrame(
        [("centers", r["center_id"], r["x"], r["y"], r["x"], r["y"], r["n"], result.converged)
         for r in final], kinds)
    clustered = kmeans_assign(points, result).select(
        F.lit("clustered").alias("output"), "center_id", "x", "y", "center_x", "center_y",
        F.lit(1).cast(T.LongType()).alias("n"), F.lit(result.converged).alias("converged"))
    return centers.unionByName(clustered)


def write_tagged_outputs(result: KMeansResult, points: DataFrame, path: str,
                         mode: str = "errorifexists") -> None:
    """Write both outputs in one job, one folder each (``path/output=...``)."""
    tagged_outputs(result, points).write.mode(mode).partitionBy("output").parquet(path)


def kmeans_outputs(result: KMeansResult, points: DataFrame, path: str,
                   keep: Sequence[str] = (), mode: str = "errorifexists") -> tuple[str, str]:
    """Write the two named outputs of a run (Q22) below ``path``:
    ``centers`` (center, size, converged flag) and ``clustered`` (every point
    with its center).  Both are CSV with a header; returns the two folders.
    """
    from murmuration.sources.csv import write_csv  # noqa: PLC0415

    centers_dir, clustered_dir = f"{path.rstrip('/')}/centers", f"{path.rstrip('/')}/clustered"
    result.finalize()  # one run of the final pass serves both outputs
    write_csv(with_run_flags(result), centers_dir, mode=mode)
    write_csv(kmeans_assign(points, result, keep), clustered_dir, mode=mode)
    return centers_dir, clustered_dir
