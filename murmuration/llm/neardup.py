"""MinHash near-dedup by a multi-index Hamming join (operator 8).

A document's signature has ``SYMBOLS`` minhash values of 16 bits.  Two
documents whose signatures differ in at most ``DISTANCE`` symbols agree, in at
least one of the ``CHUNKS`` chunks, on all but DISTANCE // CHUNKS = 1 symbol
(pigeonhole).  Each document is therefore filed under every chunk with each one
symbol left out (the allowed error, enumerated): two documents within the
distance meet under at least one key.  The three values follow from the
similarity asked for (``scheme``): a pair at it exceeds the distance with
probability below ``MISS``; such a pair may still meet.

Documents with equal shingle sets are one class, joined through its least id.
Under a key, every class is checked on full sets against the least one (a star,
not all pairs).  Where that leaves several components under a key, the classes
are compared block against block, and only links are returned.

Defined results: no words or null text: an empty set, linked with nothing;
fewer words than a shingle: the whole sequence is one shingle; rows sharing a
doc_id are one document; a null doc_id is never linked; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.common import (lowered, mix, slices, small_side, stored, text_bytes,
                                    word_bounds, word_hashes)
from murmuration.llm.components import components

ship_by_value(__name__)

WORDS = 5
PERCENT = 85
SYMBOLS, CHUNKS, DISTANCE = 32, 7, 13  # what PERCENT needs
MISS = 1e-4
BLOCK = 128  # classes compared with a block of as many

SIGNATURE_SCHEMA = ("doc_id long, n_shingles long, set_a long, set_b long, keys array<long>")


def miss_probability(percent: int, count: int, distance: int) -> float:
    """Of a pair at the similarity: that more than ``distance`` of ``count`` symbols differ."""
    p = percent / 100
    return sum(comb(count, k) * (1 - p) ** k * p ** (count - k)
               for k in range(distance + 1, count + 1))


def scheme(percent: int) -> tuple[int, int, int]:
    """Symbols, chunks and distance whose miss probability is below MISS: the
    fewest symbols, then chunks, with the longest keys that allow it."""
    for least in (4, 3, 2):  # symbols of a chunk; a key holds one less
        for count in range(32, 257, 4):
            for chunks in range(1, count // least + 1):
                if miss_probability(percent, count, 2 * chunks - 1) < MISS:
                    return count, chunks, 2 * chunks - 1
    raise ValueError(f"no signature for a similarity of {percent} %")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of every text."""
    data = lowered(data)
    starts, ends = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)  # of each text's words
    with np.errstate(over="ignore"):
        factor = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
        whole = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
        for k in range(words):
            whole += hashes[k:k + len(whole)] * factor[k]
        whole = mix(whole)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= words:
                out.append(np.unique(whole[a:b - words + 1]))
            elif b > a:
                tag = np.uint64(b - a)
                out.append(mix(np.array([(hashes[a:b] * factor[:b - a]).sum() ^ tag], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def symbols(shingles: np.ndarray, count: int = SYMBOLS) -> np.ndarray:
    """The signature: 16 bits of the least value under each of ``count`` hashes."""
    with np.errstate(over="ignore"):
        seeds = mix(np.arange(1000, 1000 + 2 * count, dtype=np.uint64))
        scale, shift = seeds[:count] | np.uint64(1), seeds[count:]
        least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 4096):
            part = shingles[at:at + 4096, None] * scale
            part += shift
            np.minimum(least, part.min(axis=0), out=least)
        return mix(least) >> np.uint64(48)


def chunk_keys(signatures: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """A key for every chunk and every symbol of it left out, for each signature (row)."""
    with np.errstate(over="ignore"):
        out, salt = [], 0
        for own in np.array_split(np.arange(signatures.shape[1]), chunks):
            for skip in own:
                value = np.zeros(len(signatures), np.uint64)
                for i in own:
                    if i != skip:
                        value = value * np.uint64(65536) + signatures[:, i]
                out.append(value ^ mix(np.array([salt], np.uint64))[0])
                salt += 1
        return mix(np.stack(out, axis=1))


def signatures(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Set size, 128-bit set digest and index keys of every document."""
    count, chunks, _ = scheme(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text", 2 << 20):
                sets = shingle_sets(*text_bytes(batch.column(1)), words)
                keys = chunk_keys(np.array([symbols(s, count) for s in sets], np.uint64), chunks)
                size = np.array([len(s) for s in sets], np.int64)
                a = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                b = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                              for s in sets], np.uint64)
                held = np.where(size > 0, keys.shape[1], 0)  # an empty set has no keys
                ends = np.concatenate([[0], np.cumsum(held)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size), pa.array(a.view(np.int64)),
                     pa.array(b.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(
                         keys[size > 0].ravel().view(np.int64)))],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "keys"])

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, SIGNATURE_SCHEMA)


def set_table(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, shingles): the full shingle set of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets = shingle_sets(*text_bytes(batch.column(1)), words)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "shingles"])

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, shingles array<long>")


def sets_of(spark: SparkSession, documents: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Stored shingle sets of the documents named in ``ids`` (a stored table)."""
    wanted = documents.join(small_side(ids, 8), "doc_id", "left_semi")
    return stored(spark, set_table(wanted, words).dropDuplicates(["doc_id"]), "sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(right, "b").join(left, "a").filter(
        (F.lit(100) * both >= F.lit(percent) * (F.size("x") + F.size("y") - both))
    ).select("a", "b")


def block_links(members: DataFrame, percent: int) -> DataFrame:
    """Links between members of one group that are in different components.

    ``members``: grp, block, blocks, doc_id, comp, shingles.  A block meets each
    block of its group once, so a task holds two blocks, whatever the group.  Sets
    are intersected only where components differ and sizes and signatures allow a
    link; only links that join something are returned.
    """
    count, _, distance = scheme(percent)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low, high = key[1], key[2]
        rows = rows.sort_values("doc_id", kind="stable")
        ids, comps, blocks = (rows[c].to_numpy() for c in ("doc_id", "comp", "block"))
        sets = [np.asarray(s) for s in rows["shingles"]]
        root = {c: c for c in set(comps.tolist())}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        size = np.array([len(s) for s in sets], np.int64)
        signs = np.array([symbols(s.view(np.uint64), count) for s in sets], np.uint64).astype(np.uint16)
        found = []
        for i in range(len(ids)):
            own = (comps[i + 1:] != comps[i]) & ((low == high) | (blocks[i + 1:] != blocks[i]))
            own &= 100 * np.minimum(size[i + 1:], size[i]) >= percent * np.maximum(size[i + 1:], size[i])
            own = i + 1 + np.flatnonzero(own)
            own = own[(signs[own] != signs[i]).sum(axis=1) <= distance]
            for j in own.tolist():
                p, q = find(comps[i]), find(comps[j])
                if p == q:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[j] - both):
                    root[max(p, q)] = min(p, q)
                    found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    other = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = other.select(
        "grp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "doc_id", "comp", "shingles")
    return met.groupBy("grp", "low", "high").applyInPandas(run, "a long, b long")


def near_duplicates(spark: SparkSession, documents: DataFrame, words: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = stored(spark, signatures(docs, words, percent), "signatures")
    usable = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL")

    # classes of equal sets: partial aggregates keep a class with a third of the rows cheap
    classes = stored(spark, usable.groupBy("n_shingles", "set_a", "set_b").agg(
        F.min(F.struct("doc_id", "keys")).alias("first"), F.count(F.lit(1)).alias("n"))
        .select("n_shingles", "set_a", "set_b", "n", "first.*"), "classes")
    filed = classes.select(F.col("doc_id").alias("b"), F.explode("keys").alias("key"))
    hubs = stored(spark, filed.groupBy("key").agg(
        F.min("b").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "hubs")
    hits = stored(spark, filed.join(small_side(hubs, 32), "key"), "hits")
    pairs = stored(spark, hits.filter("a <> b").select("a", "b").distinct(), "pairs")
    ids = stored(spark, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
                 .distinct(), "ids")
    sets = sets_of(spark, docs, ids, words)
    links = stored(spark, confirm(pairs, sets, percent), "links")
    labels = stored(spark, components(spark, links), "labels")

    # keys under which several components are left, and more than the pairs checked
    member = hits.filter("n > 2").join(
        small_side(labels.withColumnRenamed("id", "b"), 24), "b", "left"
    ).withColumn("comp", F.coalesce("comp", "b"))
    open_keys = stored(spark, member.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key"),
        "open-keys")
    if not open_keys.isEmpty():
        left = stored(spark, member.join(small_side(open_keys, 16), "key", "left_semi")
                      .select("a", "b", "comp"), "left")
        groups = stored(spark, components(spark, left.select("a", "b")), "groups")
        rows = left.select(F.col("b").alias("doc_id"), "comp").distinct().join(
            groups.select(F.col("id").alias("doc_id"), F.col("comp").alias("grp")), "doc_id")
        rows = stored(spark, rows, "left-rows")
        sizes = stored(spark, rows.groupBy("grp").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "left-sizes")
        members = rows.join(small_side(sizes, 12), "grp").withColumn(
            "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).join(sets, "doc_id")
        more = stored(spark, block_links(members, percent), "block-links")
        labels = stored(spark, components(spark, links.unionByName(more)), "labels")

    same = classes.filter("n > 1").select("n_shingles", "set_a", "set_b", F.col("doc_id").alias("rep"))
    out = sig.drop("keys").join(small_side(stored(spark, same, "same"), 32),
                                ["n_shingles", "set_a", "set_b"], "left")
    out = out.withColumn("rep", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(),
                                       F.coalesce("rep", "doc_id"))
                         .otherwise(F.col("doc_id")))
    out = out.join(small_side(labels.withColumnRenamed("id", "rep"), 16), "rep", "left")
    component = F.coalesce("comp", "rep")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
