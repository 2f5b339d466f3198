"""Importance resampling towards a target corpus (operator 11).

Separators of a lower-cased text collapse to single spaces; for each n a regular
expression with boundary lookarounds, scanned with ``overlapped=True``, then
gives every run of n words as a span of that string, which is counted under its
CRC modulo ``BUCKETS``.  A bucket's gain is the scaled log ratio of its smoothed
shares in target and source; a document weighs the mean gain of its features,
and weight plus Gumbel noise keyed by its id is its score.  The highest scores
are drawn, which samples without replacement in proportion to the ratios.

The features' buckets of a document are kept as a table, so texts are scanned
once.  Counts are bounded by BUCKETS rows; distinct scores are bounded too (a gain by
1000 ln of the counts, the noise by 32 bits), so their histogram finds the score
of the last one drawn, and only rows from there on are ranked (by ranges).

Defined results: a null text has no words; a null doc_id is hashed as ''; rows
that share id and text are scored alike and ranked one after the other; without
words the weight is 0; an empty table gives an empty result; an empty target
counts nothing; other columns of the inputs are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from operator import methodcaller
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.common import discard, slices, stored
from murmuration.operators.ordering import ranked

ship_by_value(__name__)

BUCKETS = 10_000
LONGEST = 1         # words of the longest run that is a feature
PERCENT = 10        # of the documents long enough
LEAST_WORDS = 20
SEED = 2024
KNOWN = 1 << 18     # buckets of spans remembered by a task

SEPARATORS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # all bytes of one-byte characters


def run_pattern(n: int) -> bytes:
    """n words of a string whose words are parted by single spaces."""
    return rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)


def features(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``texts`` with ``text`` replaced by ``n_words`` and the buckets of its features."""
    at = texts.columns.index("text")
    others = [f for f in texts.schema.fields if f.name != "text"]
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separators = regex.compile(SEPARATORS)
        runs = [regex.compile(run_pattern(n)) for n in range(1, longest + 1)]
        span = methodcaller("group")

        class Buckets(dict):
            def __missing__(self, key: bytes) -> int:
                value = self[key] = crc32(key) % buckets
                return value

        known = Buckets()
        for batch in slices(batches, "text", 4 << 20):
            words, ends, flat = [], [0], []
            for text in batch.column(at).cast(pa.large_binary()).to_pylist():
                line = separators.sub(b" ", (text or b"").lower()).strip(b" ")
                words.append(line.count(b" ") + 1 if line else 0)
                own = [np.fromiter(map(known.__getitem__,
                                       map(span, r.finditer(line, overlapped=True))), np.int32)
                       for r in runs]
                flat += own
                ends.append(ends[-1] + sum(map(len, own)))
                if len(known) > KNOWN:
                    known.clear()
            kept = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(words, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))],
                names=[*names, "n_words", "buckets"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in others]
    return texts.mapInArrow(run, ", ".join([*fields, "n_words long", "buckets array<int>"]))


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket: each task counts its own, then
    at most ``buckets`` sums come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])],
                                         names=["bucket", "n"])

    sums = rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in sums:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln of target over source share) of each bucket, add-one smoothed."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for s, t in zip(source.tolist(), target.tolist())]


def scored(rows: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = np.array(gain, np.int64)
        for batch in batches:
            flat = batch.column(2)
            n = np.diff(flat.offsets.to_numpy())
            ends = np.concatenate([[0], np.cumsum(gain_of[flat.flatten().to_numpy()])])
            total = np.diff(ends[np.concatenate([[0], np.cumsum(n)])])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            noise = []
            for doc_id in batch.column(0).to_pylist():
                key = f"{seed}:{'' if doc_id is None else doc_id}"
                h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
                noise.append(math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), pa.array(weight),
                 pa.array(weight + np.array(noise, np.int64))], names=names)

    return rows.select("doc_id", "n_words", "buckets").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(spark: SparkSession, documents: DataFrame, target: DataFrame,
             longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null where not drawn) of every document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = stored(spark, features(docs, longest, buckets), "features")
    gain = gains(bucket_counts(own, buckets),
                 bucket_counts(features(target.select("text"), longest, buckets), buckets))
    rows = stored(spark, scored(own, gain, seed), "scores")
    discard(own)

    able = F.col("n_words") >= least_words
    histogram = sorted(((r["score"], r["n"]) for r in rows.filter(able).groupBy("score").agg(
        F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in histogram) // 100
    last, left = math.inf, wanted  # the score of the last one drawn
    for value, n in histogram:
        if left <= 0:
            break
        last, left = value, left - n
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if wanted == 0:
        return rows.select(*columns, none)
    high = able & (F.col("score") >= last)
    placed = ranked(rows.filter(high).select(*columns),
                    [F.col("score").desc(), F.col("doc_id").asc_nulls_last()],
                    salt=F.monotonically_increasing_id())
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return drawn.unionByName(rows.filter(~high).select(*columns, none))
