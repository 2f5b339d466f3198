"""k-means on real-valued points of any dimension (Q14, Q16, Q17 beyond integers).

Points carry their coordinates in one array column.  A pass sums doubles
exactly: each is split into 32-bit chunks of a fixed-point number, chunks are
added as integers per (center, coordinate, place), and a mean is the correctly
rounded quotient of the exact sum.  Distances are taken in a fixed order too
(``functions.nearest``), so a run gives the same bits for any partitioning.

One pass is one job: every task assigns its points and adds up chunks (K x D
rows and their places leave it), Spark sums the chunks, and K rows of D numbers come
to the driver, where the loop of Q16 decides.  A point that lacks a coordinate,
or whose coordinate is not finite, belongs to no cluster and is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuration.functions.nearest import Nearest
from murmuration.functions.shipping import ship_by_value
from murmuration.operators.progress import PassLog

ship_by_value(__name__)

VectorCenter = tuple[int, tuple[float, ...]]  # (center_id, coordinates)
PLACE = 32  # bits of a chunk


def as_vector(*columns: str) -> Column:
    """Numeric columns, or one array column, as the coordinates of a point."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in columns])


def whole(v: Column, dims: int) -> Column:
    """Whether a point has all its coordinates, each a finite number."""
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) == dims) & finite


def _check(centers: Sequence[VectorCenter]) -> list[VectorCenter]:
    out = sorted((int(i), tuple(float(x) for x in v)) for i, v in centers)
    if not out:
        raise ValueError("at least one center is needed")
    if len({i for i, _ in out}) != len(out) or len({len(v) for _, v in out}) != 1:
        raise ValueError("center ids must be unique and of one dimension")
    if not all(math.isfinite(x) for _, v in out for x in v):
        raise ValueError("centers must be finite")
    return out


# ------------------------------------------------------------------ exact sums
def chunks(values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each double as an integer in three chunks: the place of the lowest one
    (in units of PLACE bits), and the chunks at that place and the two above."""
    part, exponent = np.frexp(values)
    digits = np.ldexp(part, 53).astype(np.int64)
    exponent = exponent.astype(np.int64) - 53
    place = exponent // PLACE
    shift = exponent - place * PLACE
    mask = (1 << PLACE) - 1
    low, high = (digits & mask) << shift, (digits >> PLACE) << shift
    return place, [low & mask, (low >> PLACE) + (high & mask), high >> PLACE]


class ExactSums:
    """Sums of doubles per (row of ``width`` coordinates, coordinate), as chunks."""

    def __init__(self, rows: int, width: int) -> None:
        self.shape, self.places = (rows, width), {}

    def add(self, row: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(row, kind="stable")
        row, values = row[order], values[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        place, parts = chunks(values)
        place[values == 0] = place[values != 0].min(initial=0)
        for at in range(int(place.min(initial=0)), int(place.max(initial=0)) + 3):
            own = np.zeros(values.shape, np.int64)
            for k, part in enumerate(parts):
                own += np.where(place == at - k, part, 0)
            if own.any():
                total = self.places.setdefault(at, np.zeros(self.shape, np.int64))
                total[row[first]] += np.add.reduceat(own, first, axis=0)

    def settled(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place, chunk sums) with every carry handed up; only the highest is negative."""
        carry = np.zeros(self.shape, np.int64)
        if not self.places:
            return
        low, high = min(self.places), max(self.places)
        for at in range(low, high + 1):
            total = self.places.get(at, 0) + carry
            carry = total >> PLACE if at < high else np.zeros(self.shape, np.int64)
            yield at, total - (carry << PLACE)


def quotient(parts: list[tuple[int, int]], n: int) -> float:
    """(sum of chunk * 2^(PLACE * place)) / n, correctly rounded."""
    if not parts:
        return 0.0
    low = min(at for at, _ in parts)
    total = sum(value << (PLACE * (at - low)) for at, value in parts)
    scale = PLACE * low
    return total * (1 << scale) / n if scale >= 0 else total / (n << -scale)


# ------------------------------------------------------------------ one pass
def vector_pass(points: DataFrame, centers: Sequence[VectorCenter], v: str = "v") -> DataFrame:
    """center_id, v (the new mean), n of every center that received points."""
    cs = _check(centers)
    ids, places = [i for i, _ in cs], np.array([c for _, c in cs])
    width = places.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Nearest(ids, places)
        sums, n = ExactSums(len(ids), width), np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                own = batch.column(0).flatten().to_numpy().reshape(-1, width)
                row = np.searchsorted(search.ids, search.find(own)[0])
                sums.add(row, own)
                n += np.bincount(row, minlength=len(ids))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(search.ids[used]), pa.array(np.full(len(used), -1, np.int32)),
             pa.array(np.zeros(len(used), np.int32)), pa.array(n[used])], names=names)
        for at, total in sums.settled():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(search.ids[used], width)),
                 pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                 pa.array(np.full(len(used) * width, at, np.int32)),
                 pa.array(total[used].ravel())], names=names)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for parts in batch.column(1).to_pylist():
                own: list[list] = [[] for _ in range(width)]
                n = 0
                for p in parts:
                    if p["dim"] < 0:
                        n = int(p["total"])
                    else:
                        own[p["dim"]].append((p["place"], int(p["total"])))
                found.append([quotient(x, n) for x in own])
                sizes.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64())), pa.array(sizes, pa.int64())],
                names=["center_id", "v", "n"])

    names = ["center_id", "dim", "place", "total"]
    used = points.filter(whole(F.col(v), width)).select(F.col(v).alias("v"))
    added = used.mapInArrow(run, "center_id long, dim int, place int, total long").groupBy(
        "center_id", "dim", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    rows = added.groupBy("center_id").agg(F.collect_list(F.struct("dim", "place", "total")).alias("parts"))
    return rows.mapInArrow(means, "center_id long, v array<double>, n long")


def vector_assign(points: DataFrame, centers: Sequence[VectorCenter], v: str = "v",
                  keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and center_id of every whole point; no shuffle."""
    cs = _check(centers)
    ids, places = [i for i, _ in cs], np.array([c for _, c in cs])
    width = places.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Nearest(ids, places)
        for batch in batches:
            own = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, width)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(search.find(own)[0])], names=[*keep, "center_id"])

    rows = points.filter(whole(F.col(v), width)).select(*keep, F.col(v).alias("_v"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*fields, "center_id long"]))


def distances_taken(points: DataFrame, centers: Sequence[VectorCenter], v: str = "v") -> int:
    """How many point-to-center distances an assignment takes."""
    cs = _check(centers)
    ids, places = [i for i, _ in cs], np.array([c for _, c in cs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Nearest(ids, places)
        taken = sum(search.find(b.column(0).flatten().to_numpy().reshape(-1, places.shape[1]))[1]
                    for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([taken], pa.int64())], names=["n"])

    rows = points.filter(whole(F.col(v), places.shape[1])).select(F.col(v).alias("v"))
    return rows.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


# ------------------------------------------------------------------ loops
def vector_seeds(points: DataFrame, k: int, key: str, v: str = "v", seed: int = 42,
                 dims: int | None = None) -> list[VectorCenter]:
    """k points as start centers: the first by md5 of ``"seed:key"``, then the key."""
    if k < 1:
        raise ValueError("k must be >= 1")
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    rows = points.filter(whole(F.col(v), dims) if dims else F.col(v).isNotNull())
    top = rows.select(F.col(v).alias("v"), h.alias("h"), F.col(key).alias("k")).orderBy("h", "k").limit(k)
    return [(i, tuple(r["v"])) for i, r in enumerate(top.orderBy("h", "k").collect())]


@dataclass
class VectorResult:
    """``centers_in``: what the last pass started from; None of the passes is pending."""

    centers: list[VectorCenter]
    centers_in: list[VectorCenter]
    sizes: dict[int, int]
    moved: dict[int, float]
    passes: int
    converged: bool
    history: list[float] = field(default_factory=list)


def vector_kmeans(points: DataFrame, centers: Sequence[VectorCenter], r_max: int,
                  tolerance: float, check: bool = True, v: str = "v",
                  log_path: str | None = None) -> VectorResult:
    """Passes until every center moved at most ``tolerance``, then one closing
    pass; the rule of ``clustering.kmeans_converged``.

    With ``log_path`` each pass's centers are kept below it, and a run with the
    same settings goes on after the last complete pass.
    """
    if r_max < 1:
        raise ValueError("r_max must be >= 1")
    cur = _check(centers)
    log = None
    if log_path:
        log = PassLog(points.sparkSession, log_path,
                      {"centers": cur, "tolerance": tolerance, "check": check, "kind": "vectors"})

    def one(start: list[VectorCenter]) -> dict:
        rows = vector_pass(points, start, v).collect()
        return {"rows": sorted([r["center_id"], list(r["v"]), r["n"]] for r in rows)}

    history: list[float] = []
    converged = False
    for i in range(r_max):
        rows = (log.once(i + 1, lambda: one(cur)) if log else one(cur))["rows"]
        old = dict(cur)
        moved = {c: math.dist(x, old[c]) for c, x, _ in rows}
        closing = converged or i == r_max - 1
        if closing and i == r_max - 1 and not converged:
            converged = bool(history) and history[-1] <= tolerance
        out = [(c, tuple(x)) for c, x, _ in rows]
        if closing or not out:
            return VectorResult(out, cur, {c: n for c, _, n in rows}, moved, i + 1,
                                converged and bool(out), history)
        history.append(max(moved.values()))
        cur = out
        converged = check and history[-1] <= tolerance
    raise AssertionError("unreachable")
