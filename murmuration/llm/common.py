"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.session import drop_path, scratch_path

ship_by_value(__name__)

#: A side is broadcast only when its counted rows times their width stay below this.
BROADCAST_BYTES = 64 << 20
#: What a hashed relation holds of a row beside its fields: two to four 16-byte
#: slots of its key and address, the row's header and its link.
HASHED_ROW = 96


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later jobs
    start from files that outlive any executor."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again."""
    for df in tables:
        drop_path(df.sparkSession, df.scratch)


def fits(rows: int, row_bytes: int) -> bool:
    """Whether so many rows of that width may be broadcast, hashed as they are there."""
    return rows * (row_bytes + HASHED_ROW) <= BROADCAST_BYTES


def small_side(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df`` (a stored table) with a broadcast hint when its counted size is
    below BROADCAST_BYTES; else unhinted, so the join shuffles and AQE may
    split skewed partitions.  ``rows``: the count, where the caller has it."""
    return F.broadcast(df) if fits(df.count() if rows is None else rows, row_bytes) else df


def spread_rank(df: DataFrame, groups: Sequence[str], order: Sequence[Column],
                salt: Column, buckets: int, out: str) -> DataFrame:
    """Gapless 0-based rank of each row inside its group, without a task per
    group: rows are ranked inside (group, bucket) and buckets are stacked.

    ``df`` is a stored table; the bucket table has at most
    (number of groups) x ``buckets`` rows, which the callers keep bounded, so
    it may be broadcast.  Group columns must not be null.
    """
    df = df.withColumn("_bucket", F.pmod(salt, F.lit(buckets)).cast("int"))
    keys = [*groups, "_bucket"]
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .drop("_n"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (df.join(F.broadcast(starts), keys)
            .withColumn(out, (F.col("_start") + inside - 1).cast("long"))
            .drop("_bucket", "_start"))


# --- texts of an Arrow batch as one byte buffer -----------------------------

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str,
           limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``limit`` bytes of text (a longer text is a batch of its own)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


# --- word hashes -------------------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix64), vectorised."""
    x = (x + _MULT).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word: a run without space, \\t, \\n, \\v, \\f, \\r inside one text."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span data[start:end].

    A span is read in blocks of 8 bytes; each block is mixed with its number and
    the mixed blocks are added, so no algebra relates the hashes of like words.
    """
    with np.errstate(over="ignore"):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # at every byte
        kept = np.array([0, *[(1 << 8 * k) - 1 for k in range(1, 9)]], np.uint64)
        size = ends - starts
        out = np.zeros(len(starts), np.uint64)
        live, first = np.arange(len(starts)), 0
        while len(live) and first < 512:
            at = starts[live] + first
            block = blocks[at] & kept[np.minimum(ends[live] - at, 8)]
            out[live] += mix(block ^ mix(np.array([first], np.uint64)))
            first += 8
            live = live[size[live] > first]
        for i in live.tolist():  # the rest of long spans
            for at in range(int(starts[i]) + first, int(ends[i]), 1 << 20):
                place = np.arange(at, min(at + (1 << 20), int(ends[i])), 8)
                block = blocks[place] & kept[np.minimum(ends[i] - place, 8)]
                out[i] += mix(block ^ mix((place - starts[i]).astype(np.uint64))).sum(dtype=np.uint64)
        return mix(out + size.astype(np.uint64))
