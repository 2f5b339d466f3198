"""The n most frequent keys without shuffling every key.

Every task keeps a Misra-Gries summary of at most ``counters`` keys: a key with
more than one (counters + 1)-th of the task's rows is in it.  So every key with more
than that share of all rows is in the summary of some task.  The candidates are
counted again exactly; if the n-th of them has more rows than any key outside
can have, the answer is proven, and only candidates were shuffled.  Else (flat
data) all keys are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value

ship_by_value(__name__)

COUNTERS = 4096


def summary(df: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """(key, over): the summaries of all tasks.  A task also gives a row with a
    null key, whose ``over`` bounds how many of its rows any key left out has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, cut = None, np.zeros(0, np.int64), 0
        for batch in batches:
            own = pc.value_counts(batch.column(0).drop_null())
            values, counts = own.field(0), own.field(1).to_numpy()
            keys = values if keys is None else pa.concat_arrays([keys, values])
            code = keys.dictionary_encode()
            at = code.indices.to_numpy()
            n = np.bincount(at, weights=np.concatenate([n, counts]),
                            minlength=len(code.dictionary)).astype(np.int64)
            keys = code.dictionary
            if len(n) > counters:  # take the (counters + 1)-th largest count from all
                least = int(np.partition(n, len(n) - counters - 1)[len(n) - counters - 1])
                cut, n = cut + least, n - least
                keys, n = keys.filter(pa.array(n > 0)), n[n > 0]
        if keys is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([keys, pa.nulls(1, keys.type)]),
                 pa.array(np.append(n, cut))], names=["key", "over"])

    rows = df.select(F.col(key).alias("key"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, over long")


def heavy_hitters(df: DataFrame, key: str, n: int, counters: int = COUNTERS) -> tuple[DataFrame, bool]:
    """(key, count) of the n most frequent keys, ties to the smaller key, and
    whether the summaries alone proved them.  Null keys are not counted.

    Of the merged candidates at most ``counters`` are counted again: those that
    may have most.  ``bound`` is the most rows that any other key can have.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    parts = summary(df, key, counters)
    merged = parts.groupBy("key").agg(F.sum("over").alias("over")).orderBy(
        F.col("key").isNull().desc(), F.desc("over")).limit(counters + 2).collect()
    cut = sum(r["over"] for r in merged if r["key"] is None)
    found = [r for r in merged if r["key"] is not None]
    bound = cut + (found[counters]["over"] if len(found) > counters else 0)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key")).filter("key IS NOT NULL")
    names = df.sparkSession.createDataFrame([(r["key"],) for r in found[:counters]], f"key {kind}")
    top = rows.join(F.broadcast(names), "key", "left_semi").groupBy("key").agg(
        F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "key").limit(n).collect()
    proven = bound == 0 or len(top) == n and top[-1]["count"] > bound
    if proven:
        return df.sparkSession.createDataFrame([tuple(r) for r in top], f"key {kind}, count long"), True
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), "key").limit(n), False
