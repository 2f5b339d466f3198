"""Packing by cutting-stock column generation (operator 6).

Documents become token pieces of at most ``WINDOW`` ids.  The histogram of
piece lengths, in units of ``UNIT`` ids (256 bins, whatever the corpus size),
is a cutting-stock problem: a linear program over patterns, whose columns are
priced by a knapsack dynamic program.  Whole parts of the solution are used as
they are, the remainder is packed best-fit; pieces are then ranked inside their
length bin and take the places that the patterns hold for that bin.  Pieces of
the last bin leave no room for another and are sequences of their own.

The histogram and the patterns, both bounded by the bins, are handled in one
task; nothing else meets in one place.  Ids are those of the tokenizer file: its
added tokens are matched in the text and cut it; only what lies between is
encoded.  Defined results: a null or empty text is one piece, the closing id
alone; a document longer than WINDOW is cut into full pieces and a rest;
repeated rows are packed each; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.bpe import Encoder
from murmuration.llm.common import slices, spread_rank, stored, text_bytes

ship_by_value(__name__)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 2048
UNIT = 8
CLOSING_ID = 1
BUCKETS = 256  # rank buckets of a length bin
PER_BUCKET = 1 << 17  # most full pieces of a bucket, on average


def added_tokens(path: str) -> dict[bytes, int]:
    """Id of every token that the tokenizer file matches in plain text."""
    with open(path, encoding="utf-8") as f:
        return {t["content"].encode(): t["id"] for t in json.load(f)["added_tokens"]}


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bin int")
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")


def encode(encoder: Encoder, data: np.ndarray, offsets: np.ndarray,
           added: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts and the n+1 offsets of their ids; an added token is one id."""
    raw = data.tobytes()
    found = []
    if any(t in raw for t in added):
        either = re.compile(b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)))
        found = [(m.start(), m.end(), added[m.group()])
                 for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                 for m in either.finditer(raw, a, b)]
    if not found:
        return encoder.encode(data, offsets)
    starts, ends, own = (np.array(x, np.int64) for x in zip(*found))
    bounds = np.sort(np.concatenate([offsets, starts, ends]))
    ids, at = encoder.encode(data, bounds)
    one = np.isin(bounds[:-1], starts) & (np.diff(bounds) > 0)  # the parts that are an added token
    length = np.diff(at)
    keep = np.repeat(~one, length)
    keep[at[:-1][one]] = True
    ids[at[:-1][one]] = own
    at = np.concatenate([[0], np.cumsum(np.where(one, 1, length))])
    return ids[keep], at[np.searchsorted(bounds, offsets)]


def pieces(documents: DataFrame, ranks: str = RANKS, pattern: str = PATTERN,
           window: int = WINDOW, unit: int = UNIT,
           added: dict[bytes, int] | None = None) -> DataFrame:
    """One row per token piece of every document; ``added``: by default the
    added tokens of TOKENIZER."""
    if added is None:
        added = added_tokens(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        for batch in slices(batches, "text", 2 << 20):
            ids, ends = encode(encoder, *text_bytes(batch.column(1)), added)
            ids = ids.astype("<u4")
            size = np.diff(ends) + 1  # with the closing id
            count = -(-size // window)
            doc = np.repeat(np.arange(len(size)), count)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * window
            length = np.minimum(window, size[doc] - start)
            closing = np.array([CLOSING_ID], "<u4").tobytes()
            crc = np.empty(len(doc), np.int64)
            for k, (d, s, n) in enumerate(zip(doc.tolist(), start.tolist(), length.tolist())):
                at = int(ends[d]) + s
                last = s + n == size[d]
                part = zlib.crc32(ids[at:at + n - last].tobytes())
                crc[k] = zlib.crc32(closing, part) if last else part
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length),
                 pa.array(crc), pa.array(size[doc]),
                 pa.array((-(-length // unit)).astype(np.int32))],
                names=[f.split()[0] for f in PIECES.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, PIECES)


# --- the linear program (on the histogram) ------------------------------------

def best_pattern(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of greatest value that fits ``room``."""
    best = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        fits = int(np.searchsorted(sizes, c, side="right"))
        if fits:
            gain = values[:fits] + best[c - sizes[:fits]]
            k = int(np.argmax(gain))
            if gain[k] > best[c] + 1e-12:
                best[c], choice[c] = gain[k], k
    pattern, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(best[room]), pattern


def greedy_basis(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """A feasible basis: largest size first, each pattern used until one of its
    sizes is met.  A met size is in no later pattern, so the columns are
    triangular (up to order) and hence independent."""
    m = len(sizes)
    columns, x = np.zeros((m, m)), np.zeros(m)
    left, open_ = demand.astype(float).copy(), np.ones(m, bool)
    for j in range(m):
        free = room
        for i in np.flatnonzero(open_)[::-1]:
            columns[i, j] = free // sizes[i]
            free -= int(columns[i, j]) * int(sizes[i])
        held = np.flatnonzero(columns[:, j])
        met = held[np.argmin(left[held] / columns[held, j])]
        x[j] = left[met] / columns[met, j]
        left = np.maximum(left - x[j] * columns[:, j], 0.0)
        left[met], open_[met] = 0.0, False
    return columns, x


def solve(sizes: np.ndarray, demand: np.ndarray, room: int,
          gap: float = 5e-4) -> list[tuple[np.ndarray, float]]:
    """Patterns and their fractional counts: revised simplex with generated columns.

    Stops when the objective is within ``gap`` of a lower bound (all pieces
    without padding, or the objective over the best price); the basis is
    feasible at every step, so the pivot limit only bounds the driver's work.
    """
    m = len(sizes)
    scale = float(demand.sum())
    demand = demand / scale
    columns, x = greedy_basis(sizes, demand, room)
    cost = np.ones(m)
    inverse = np.linalg.inv(columns)
    least = float(demand @ sizes) / room
    for pivot in range(20 * m):
        if cost @ x <= least * (1 + gap):
            break
        prices = cost @ inverse
        low = int(np.argmin(prices))
        if prices[low] < -1e-9:  # allow more places than asked of this size
            enter, price = np.zeros(m), 0.0
            enter[low] = -1.0
        else:
            value, pattern = best_pattern(np.maximum(prices, 0), sizes, room)
            if value <= 1 + gap:
                break
            enter, price = pattern.astype(float), 1.0
        step = inverse @ enter
        up = np.flatnonzero(step > 1e-9)
        if len(up) == 0:
            break
        out = up[np.argmin(x[up] / step[up])]
        amount = x[out] / step[out]
        x = np.maximum(x - amount * step, 0.0)
        x[out] = amount
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
        columns[:, out], cost[out] = enter, price
        if pivot % 100 == 99:  # shed the rounding of many updates
            inverse = np.linalg.inv(columns)
            x = np.maximum(inverse @ demand, 0.0)
    return [(columns[:, j].astype(np.int64), float(x[j] * scale)) for j in range(m) if cost[j] > 0]


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(size -> places, number of sequences), with a place for every piece."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram))
    left = np.array([histogram[s] for s in sizes.tolist()], dtype=object)
    out: list[tuple[dict[int, int], int]] = []
    for pattern, count in solve(sizes, np.array([float(v) for v in left]), room):
        held = np.flatnonzero(pattern)
        n = min([int(count + 1e-7), *(left[i] // int(pattern[i]) for i in held)])
        if n > 0:
            out.append(({int(sizes[i]): int(pattern[i]) for i in held}, n))
            for i in held:
                left[i] -= n * int(pattern[i])
    # the remainder: largest first into the fullest open sequence with room
    open_: list[list[dict[int, int]]] = [[] for _ in range(room + 1)]
    for i in range(len(sizes) - 1, -1, -1):
        size = int(sizes[i])
        for _ in range(left[i]):
            free = next((c for c in range(size, room) if open_[c]), room)
            held = open_[free].pop() if free < room else {}
            held[size] = held.get(size, 0) + 1
            open_[free - size].append(held)
    same: dict[tuple, int] = {}
    for held in (h for group in open_ for h in group):
        key = tuple(sorted(held.items()))
        same[key] = same.get(key, 0) + 1
    return out + [(dict(key), n) for key, n in sorted(same.items())]


def places(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(bin, first rank, end rank, places a sequence, first sequence) of every pattern's sizes."""
    filled: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, n in patterns:
        for size, each in pattern.items():
            first = filled.get(size, 0)
            out.append((size, first, first + each * n, each, sequence))
            filled[size] = first + each * n
        sequence += n
    return out


def assigned(histogram: DataFrame, room: int) -> DataFrame:
    """``places`` of the patterns for a histogram (bin, n), which has at most
    ``room`` rows and is solved in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {r["bin"]: r["n"] for b in batches for r in b.to_pylist()}
        columns = list(zip(*places(plan(counts, room)))) or [[]] * 5
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                         names=["bin", "lo", "hi", "each", "base"])

    return histogram.coalesce(1).mapInArrow(run, "bin int, lo long, hi long, each long, base long")


def pack(spark: SparkSession, documents: DataFrame, ranks: str = RANKS, pattern: str = PATTERN,
         window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    if window % unit:
        raise ValueError("the window must be whole units")
    room = window // unit
    cut = stored(spark, pieces(documents, ranks, pattern, window, unit), "pieces")
    full, rest = cut.filter(F.col("bin") == room), cut.filter(F.col("bin") < room)
    histogram = rest.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    held = stored(spark, assigned(histogram, room), "places")
    key = F.xxhash64("doc_id", "start")
    order = [key, "doc_id", "start", "ids_crc32"]
    ranked = spread_rank(rest, ["bin"], order, key, BUCKETS, "rank")
    r, h = ranked.alias("r"), F.broadcast(held).alias("h")
    put = r.join(h, (F.col("r.bin") == F.col("h.bin")) & (F.col("rank") >= F.col("lo"))
                 & (F.col("rank") < F.col("hi"))).select(
        *COLUMNS, (F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("each")))
        .cast("long").alias("sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy(
        F.desc("length"), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    shared = put.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))

    # a full piece is a sequence of its own: no pattern, and as many buckets as there are rows for
    used = held.agg(F.max(F.expr("base + (hi - lo) div each"))).first()[0] or 0
    buckets = max(BUCKETS, -(-full.count() // PER_BUCKET))
    alone = spread_rank(full, ["bin"], order, key, buckets, "rank").select(
        *COLUMNS, (F.col("rank") + used).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return shared.unionByName(alone)
