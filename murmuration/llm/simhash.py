"""SimHash near-dedup by Golay-code fuzzy hashing (operator 12).

A fingerprint bit is 1 if it is set in over half of the text's shingle hashes.
Fingerprints link at ``DISTANCE`` or fewer differing bits.

The perfect Golay code of 23 bits puts every word within 3 bits of exactly one
codeword.  The *indices* of a segment are the codewords nearest to it and to
each of its one-bit neighbours (1 or 6 of them): two segments that differ in at
most 2 bits share one.  A fingerprint has three segments (22, 21, 21 bits).  Of
4 differing bits either no segment has over 2, and the pair shares an index in
all three; or one segment has 3 or 4, and of the other two one is equal and one
differs in at most 1.  So a fingerprint is filed under every triple of its
indices, and under every exact segment with every index of another: each link
meets under a key of 34 to 36 bits.

Equal fingerprints are one class.  The rows of a key are sorted together, and a
row is compared with the next ``LIMIT`` of its key.  Keys with more rows that
are not yet one component are compared block against block, as many tasks as
there are pairs of blocks.  Only links that join something are returned.

Defined results: fewer words than a shingle: the whole sequence is one; no words
or a null text: fingerprint zero, linked like any other; a null doc_id has a
fingerprint, is linked with nothing and has a null component; rows that share a
doc_id are linked each by its own fingerprint; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.common import discard, slices, small_side, stored
from murmuration.llm.components import components

ship_by_value(__name__)

WORDS = 4
DISTANCE = 4      # what the keys are made for
HASH_SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the Golay code
INDICES = 6       # most codeword indices of a segment
LIMIT = 256       # rows of a key that each row is compared with at once
BLOCK = 2048      # rows of a larger key's block
CHUNK = 1 << 18   # sorted rows handled at once
PER_TASK = 1 << 15  # fingerprints a task files, under some 180 keys each
PIECE = 1 << 16   # shingles of a text handled at once


# --- fingerprints ---------------------------------------------------------------

def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The 64-bit fingerprint of one text."""
    tokens = text.lower().split()  # ASCII letters and white space only, as bytes
    if not tokens:
        return 0
    line = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1).tolist()
    ends = ends[min(words, len(tokens)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(ends), PIECE):
        hashes = np.array([digest(line[a:b], HASH_SEED) for a, b in
                           zip(starts[at:at + PIECE], ends[at:at + PIECE])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    over = np.packbits(2 * votes > len(ends), bitorder="little")
    return int(over.view(np.uint64)[0])


def fingerprints(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a long) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            own = [fingerprint(t or b"", words)
                   for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(own, np.uint64).view(np.int64))],
                names=["doc_id", "bits"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, bits long")


# --- Golay keys -------------------------------------------------------------------

def golay() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of (m << 11) modulo the generator for 12-bit m, and the error
    of weight 0 to 3 that each 11-bit remainder (syndrome) stands for."""
    rest = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    one = 1 << np.arange(23, dtype=np.int64)
    errors = np.unique((one[:, None, None] | one[None, :, None] | one[None, None, :]).ravel())
    errors = np.concatenate([[0], errors])
    error = np.zeros(1 << 11, np.int64)
    error[(errors & 2047) ^ rest[errors >> 11]] = errors
    return rest, error


def indices(segment: np.ndarray, width: int, rest: np.ndarray,
            error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codeword indices of each segment, in INDICES slots, and which are used."""
    near = segment[:, None] ^ np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])
    found = (near ^ error[(near & 2047) ^ rest[near >> 11]]) >> 11
    found.sort(axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    row, _ = np.nonzero(new)
    slot = (np.cumsum(new, axis=1) - 1)[new]
    out = np.zeros((len(segment), INDICES), np.int64)
    used = np.zeros(out.shape, bool)
    out[row, slot], used[row, slot] = found[new], True
    return out, used


def keys_of(bits: np.ndarray, rest: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of fingerprints (uint64): the row of each, and the key."""
    segments = [(bits >> np.uint64(first)).astype(np.int64) & ((1 << width) - 1)
                for first, width in SEGMENTS]
    parts = [indices(s, width, rest, error) for s, (_, width) in zip(segments, SEGMENTS)]
    (a, ua), (b, ub), (c, uc) = parts
    whole = a[:, :, None, None] << 24 | b[:, None, :, None] << 12 | c[:, None, None, :]
    used = ua[:, :, None, None] & ub[:, None, :, None] & uc[:, None, None, :]
    keys, held = [whole.reshape(len(bits), -1)], [used.reshape(len(bits), -1)]
    tag = 1
    for i, exact in enumerate(segments):
        for j, (own, u) in enumerate(parts):
            if i != j:
                keys.append(tag << 36 | exact[:, None] << 12 | own)
                held.append(u)
                tag += 1
    keys, held = np.concatenate(keys, axis=1), np.concatenate(held, axis=1)
    return np.nonzero(held)[0], keys[held]


def filed(classes: DataFrame) -> DataFrame:
    """(key, bits): every distinct fingerprint under all its keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, error = golay()
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(bits), 2048):
                own = bits[at:at + 2048]
                row, key = keys_of(own, rest, error)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(own[row].view(np.int64))], names=["key", "bits"])

    return classes.select("bits").mapInArrow(run, "key long, bits long")


def spread(classes: DataFrame) -> DataFrame:
    """The classes (a stored table) in tasks of PER_TASK rows: each row becomes many."""
    return classes.repartition(max(1, -(-classes.count() // PER_TASK)), "bits")


# --- links ---------------------------------------------------------------------------

def forest(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> list[int]:
    """Join the labels of rows a[i] and b[i]; places i that joined something.
    ``label`` maps rows to their root and is flat again on return."""
    kept = []
    for i, (p, q) in enumerate(zip(a.tolist(), b.tolist())):
        p, q = label[p], label[q]
        while label[p] != p:
            p = label[p]
        while label[q] != q:
            q = label[q]
        if p != q:
            label[max(p, q)] = min(p, q)
            kept.append(i)
    while True:
        flat = label[label]
        if np.array_equal(flat, label):
            return kept
        label[:] = flat


def chunk_links(key: np.ndarray, bits: np.ndarray,
                distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links among sorted rows, each compared with the next LIMIT of its key."""
    label = np.unique(bits, return_index=True, return_inverse=True)
    label = label[1][label[2]]  # rows of one fingerprint are one
    left, right = [], []
    active = np.arange(len(key))
    for lag in range(1, LIMIT + 1):
        active = active[active + lag < len(key)]
        active = active[key[active] == key[active + lag]]
        if len(active) == 0:
            break
        open_ = active[label[active] != label[active + lag]]
        open_ = open_[np.bitwise_count(bits[open_] ^ bits[open_ + lag]) <= distance]
        if len(open_):
            own = open_[forest(open_, open_ + lag, label)]
            left.append(bits[own])
            right.append(bits[own + lag])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


LINK_SCHEMA = "a long, b long, key long"


def near_rows(keyed: DataFrame) -> DataFrame:
    """Links (a, b, null) of rows that share a key, and the rows (a, null, key)
    of keys with more than LIMIT + 1 of them, whose comparison is not whole."""
    def batch_of(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), none if b is None else pa.array(b.view(np.int64)),
             none if key is None else pa.array(key)], names=["a", "b", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = None  # a key whose first rows were given out

        def handled(key: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield batch_of(*chunk_links(key, bits), None)
            first = np.flatnonzero(np.diff(key, prepend=-1))
            size = np.diff(np.append(first, len(key)))
            many = np.repeat((size > LIMIT + 1) | (key[first] == large), size)
            if many.any():
                yield batch_of(bits[many], None, key[many])

        keys, bits, rows = [], [], 0
        for batch in batches:
            keys.append(batch.column(0).to_numpy())
            bits.append(batch.column(1).to_numpy().view(np.uint64))
            rows += batch.num_rows
            if rows < CHUNK:
                continue
            key, own = np.concatenate(keys), np.concatenate(bits)
            at = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if len(key) - at > CHUNK // 2:
                at = len(key)
            yield from handled(key[:at], own[:at])
            if at == len(key):
                large = key[-1]
            keys, bits, rows = [key[at:]], [own[at:]], len(key) - at
        if rows:
            yield from handled(np.concatenate(keys), np.concatenate(bits))

    return keyed.repartition("key").sortWithinPartitions("key", "bits").mapInArrow(run, LINK_SCHEMA)


def block_links(members: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links between the components of a large key.

    ``members``: key, block, blocks, bits, comp.  A block meets each block of
    its key once, so a task holds two blocks, whatever the key.
    """
    def run(rows: pa.Table) -> pa.Table:
        block, bits, comp = (rows[c].to_numpy() for c in ("block", "bits", "comp"))
        bits = bits.view(np.uint64)
        label = np.unique(comp, return_index=True, return_inverse=True)
        label = label[1][label[2]]
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        ours, theirs = np.flatnonzero(block == low), np.flatnonzero(block == high)
        left, right = [], []
        for i in ours.tolist():
            j = theirs[label[theirs] != label[i]]
            j = j[np.bitwise_count(bits[j] ^ bits[i]) <= distance]
            if len(j):
                j = j[forest(np.full(len(j), i), j, label)]
                left.append(np.full(len(j), bits[i]))
                right.append(bits[j])
        none = np.zeros(0, np.uint64)
        return pa.table({"a": np.concatenate([none, *left]).view(np.int64),
                         "b": np.concatenate([none, *right]).view(np.int64)})

    other = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = other.select("key", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high"), "block", "bits", "comp")
    return met.groupBy("key", "low", "high").applyInArrow(run, "a long, b long")


def linked(spark: SparkSession, classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(id, comp) of the fingerprints that are linked, as longs."""
    found = stored(spark, near_rows(filed(spread(classes))), "near-rows")
    links = found.filter("b IS NOT NULL").select("a", "b").distinct()
    labels = stored(spark, components(spark, links), "labels")
    members = found.filter("b IS NULL").select("key", F.col("a").alias("id")).distinct().join(
        small_side(labels, 16), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    members = stored(spark, members, "members")
    keys = stored(spark, members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter(
        "lo <> hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "open-keys")
    if not keys.isEmpty():
        open_ = members.join(small_side(keys, 12), "key").select(
            "key", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "blocks",
            F.col("id").alias("bits"), "comp")
        more = stored(spark, block_links(open_, distance), "block-links")
        known = labels.select(F.col("id").alias("a"), F.col("comp").alias("b"))
        labels = stored(spark, components(spark, known.unionByName(more)), "labels")
    discard(found, members, keys)
    return labels


def near_duplicates(spark: SparkSession, documents: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = stored(spark, fingerprints(documents, words), "fingerprints")
    # the least id of a fingerprint, pre-aggregated per task
    classes = stored(spark, prints.filter("doc_id IS NOT NULL").groupBy("bits").agg(
        F.min("doc_id").alias("rep")), "classes")
    labels = linked(spark, classes)
    ids = stored(spark, classes.join(small_side(labels.withColumnRenamed("id", "bits"), 16), "bits",
                                     "left").select("bits", "rep", F.coalesce("comp", "bits").alias("comp")),
                 "class-components")
    least = stored(spark, ids.groupBy("comp").agg(F.min("rep").alias("component")), "least")
    known = stored(spark, ids.join(small_side(least, 16), "comp").select("bits", "component"), "known")
    out = prints.join(small_side(known, 16), "bits", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
                      component.alias("component_id"))
