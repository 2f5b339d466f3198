"""Membership in a set that is too big to broadcast: a Bloom filter, then the set.

The filter is an aggregate: keys of the set become bit positions, and the bits of
each 63-bit word are or-ed.  Its size follows from a parameter, not from the
data, so it may be broadcast whatever the set is.  Rows it lets through meet the
set itself in a join, so the answer is exact; rows it stops never shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value

ship_by_value(__name__)

WORD = 63  # bits of a LONG used by the filter
FILTER_BYTES = 8 << 20
HASHES = 4


def _places(key: Column, words: int, hashes: int) -> Column:
    """Bit positions of a key: double hashing of its 64-bit hash."""
    bits = F.lit(words * WORD)
    one = F.pmod(F.xxhash64(key), bits)
    two = F.pmod(F.xxhash64(F.lit(1), key), bits)
    return F.array(*[F.pmod(one + two * k, bits) for k in range(hashes)])


def filter_words(members: DataFrame, key: str, filter_bytes: int = FILTER_BYTES,
                 hashes: int = HASHES) -> np.ndarray:
    """The filter of a set's keys; at most ``filter_bytes`` come to the driver."""
    words = max(1, filter_bytes // 8)
    places = members.filter(F.col(key).isNotNull()).select(
        F.explode(_places(F.col(key), words, hashes)).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(WORD)).cast("int"))
    rows = places.groupBy(F.expr(f"p div {WORD}").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(words, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out


def _held(df: DataFrame, key: str, words: np.ndarray, hashes: int) -> Column:
    """Whether the filter lets a row's key through; null does not pass."""
    shared = df.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def held(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        filled = shared.value
        for places in parts:
            at = np.stack(places.to_numpy()) if len(places) else np.zeros((0, hashes), np.int64)
            yield pd.Series((filled[at // WORD] >> (at % WORD) & 1).all(axis=1))

    return F.col(key).isNotNull() & held(_places(F.col(key), len(words), hashes))


def may_hold(df: DataFrame, key: str, words: np.ndarray, hashes: int = HASHES) -> DataFrame:
    """The rows whose key may be in the set; no row of a member is lost."""
    return df.filter(_held(df, key, words, hashes))


def in_set(df: DataFrame, key: str, members: DataFrame, member_key: str,
           filter_bytes: int = FILTER_BYTES, hashes: int = HASHES) -> DataFrame:
    """Rows of ``df`` whose key is among the members (null is in no set)."""
    words = filter_words(members, member_key, filter_bytes, hashes)
    some = may_hold(df, key, words, hashes)
    own = members.select(F.col(member_key).alias("_member"))
    return some.join(own, F.col(key) == F.col("_member"), "left_semi")


def not_in_set(df: DataFrame, key: str, members: DataFrame, member_key: str,
               keep: tuple[str, ...], filter_bytes: int = FILTER_BYTES,
               hashes: int = HASHES) -> DataFrame:
    """Rows (``keep``) whose key is not among the members; a null key is not.

    What the filter stops is surely outside; only the rest meets the set.
    """
    words = filter_words(members, member_key, filter_bytes, hashes)
    marked = df.select(*keep, F.col(key).alias("_key"), _held(df, key, words, hashes).alias("_may"))
    outside = marked.filter(~F.col("_may"))
    own = members.select(F.col(member_key).alias("_member"))
    met = marked.filter("_may").join(own, F.col("_key") == F.col("_member"), "left_anti")
    return outside.select(*keep).unionByName(met.select(*keep))
