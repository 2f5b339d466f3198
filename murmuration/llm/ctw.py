"""Language-model scores by context-tree weighting (operator 9).

A text is its words (A-Z lowered) joined by single spaces and closed by a line
feed; each byte is eight binary decisions.  For every decision the contexts are
the 0 to ``DEPTH`` bytes before it; a Krichevsky-Trofimov estimate stands at
each context, and the weights mix them over all depths:
``Pw = (Pe + product of the children's Pw) / 2``.

Every context of the training texts is in the tree.  Texts are dealt into slices
of bounded size; the distinct (DEPTH+1)-grams of each slice, with their training
counts, are grouped by the ``BASE`` bytes before the symbol, one packed row per
slice and group.  The rows of a group are merged to one, which holds the tree
from depth BASE down (at most 256 ** (DEPTH - BASE + 1) grams, whatever the
corpus); its (context, bit node) rows are summed to depths BASE-1 ... 0 by
aggregates, and the mixtures come back down by joins.  That gives a log
probability for each distinct gram; the packed rows meet those of their group
and carry them to the slice, where they are summed over each text.

The base score is add-one over words.  Words with 1 / ``FREQUENT`` of all
tokens (at most FREQUENT of them) are broadcast; the rest meet their counts in
a join on a 64-bit word hash.

Defined results: a null or empty text is the closing token alone; rows with the
same id and text share their sums, each row counted once; a null doc_id counts
as the text '' for the fold; an empty table gives an empty result, and without
training texts every estimate is 1/2; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.common import (discard, lowered, slices, stored, text_bytes, word_bounds,
                                    word_hashes)

ship_by_value(__name__)

DEPTH = 5
BASE = 3
SLICE = 24 << 20  # bytes of text that share the scores of their distinct grams
PART = 1 << 20    # bytes of text handled at once
GRAMS = 1 << 18   # grams weighted at once (a group is never cut)
FREQUENT = 1 << 20
CLOSE = 10  # the closing symbol; also what precedes a text


# --- symbols and tokens of many texts ---------------------------------------------

def streams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts and the n+1 offsets of each text's symbols."""
    data = lowered(data)
    starts, ends = word_bounds(data, offsets)
    words = np.diff(np.searchsorted(starts, offsets))
    size = ends - starts + 1  # with the separator
    doc = np.repeat(np.arange(len(words)), words)
    length = np.bincount(doc, weights=size, minlength=len(words)).astype(np.int64)
    length[words == 0] = 1
    bounds = np.concatenate([[0], np.cumsum(length)])
    out = np.full(bounds[-1], 32, np.uint8)
    inside = np.ones(len(out), bool)
    empty_before = np.cumsum(words == 0)[doc] if len(doc) else doc
    inside[np.cumsum(size) - 1 + empty_before] = False
    inside[bounds[1:] - 1] = False
    edge = np.zeros(len(data) + 1, np.int64)
    edge[starts] += 1
    edge[ends] -= 1
    out[inside] = data[np.cumsum(edge[:-1]) > 0]
    out[bounds[1:] - 1] = CLOSE
    return out, bounds


def before(symbols: np.ndarray, bounds: np.ndarray, depth: int) -> list[np.ndarray]:
    """The 1st, 2nd, ... symbol before each one; CLOSE before a text's start."""
    out = []
    for d in range(1, depth + 1):
        c = np.full(len(symbols), CLOSE, np.uint8)
        c[d:] = symbols[:-d]
        for k in range(d):  # the first d symbols of each text
            at = bounds[:-1] + k
            c[at[at < bounds[1:]]] = CLOSE
        out.append(c)
    return out


def gram_keys(symbols: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """The same with the newest symbol of the context highest: sorted keys hold
    the contexts of every depth together."""
    key = symbols.astype(np.int64)
    for d, c in enumerate(before(symbols, bounds, depth), 1):
        key |= c.astype(np.int64) << (8 * (depth - d + 1))
    return key


def held_out(doc_id: Column, mod: int = 7, rest: int = 2) -> Column:
    key = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % mod == rest


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            held_out(F.col("doc_id")).alias("held_out"),
                            F.xxhash64("text").alias("row_key"), "text")


SLICED = "slice long, doc_id long, held_out boolean, row_key long, text string"


def sliced(documents: DataFrame) -> DataFrame:
    """The texts with the number of their slice; to be stored before use."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(slices(batches, "text", SLICE)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, first + k)), *batch.columns],
                names=[f.split()[0] for f in SLICED.split(", ")])

    return _texts(documents).mapInArrow(run, SLICED)


# --- packed rows -------------------------------------------------------------------

def pack(values: np.ndarray, sizes: np.ndarray, width: int) -> pa.Array:
    """Runs of ``sizes`` whole numbers as one binary value each: the highest of
    their ``width`` bytes first, each byte of a whole run together, so that
    sorted numbers compress."""
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = np.repeat(sizes, sizes)
    at = (width - 1) * first + np.arange(len(values))
    out = np.empty(len(values) * width, np.uint8)
    for k in range(width):
        out[at] = (values >> (8 * (width - 1 - k))).astype(np.uint8)
        at += own
    ends = np.concatenate([[0], np.cumsum(sizes) * width]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(out)])


def unpack(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, and how many each row has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    sizes = np.diff(ends).astype(np.int64) // width
    total = int(sizes.sum())
    values = np.zeros(total, np.int64)
    if total:
        data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        at = (width - 1) * np.repeat(np.cumsum(sizes) - sizes, sizes) + np.arange(total)
        own = np.repeat(sizes, sizes)
        for _ in range(width):
            values = values << 8 | data[at]
            at += own
    return values, sizes


def runs(codes: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups of sorted codes and their sizes."""
    group = codes >> shift
    first = np.flatnonzero(np.diff(group, prepend=-1))
    return group[first], np.diff(np.append(first, len(group)))


def codes_of(table: pa.Table | pa.RecordBatch, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole gram codes of packed rows (key, grams), and the rows' sizes."""
    rest, sizes = unpack(table["grams"], shift // 8)
    return np.repeat(table["key"].to_numpy(), sizes) << shift | rest, sizes


def rest_shift(depth: int) -> int:
    """Bits of a gram below its group."""
    return 8 * (depth - min(BASE, depth) + 1)


def add_up(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sums of their numbers."""
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def as_batches(batches: Iterator[pa.RecordBatch], column: str, least: int) -> Iterator[pa.Table]:
    """Rows in tables of about ``least`` packed bytes."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            held.append(part)
            size += part[part.schema.get_field_index(column)].nbytes
            if size >= least:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


PACKED = "kind int, slice long, key long, n long, grams binary, seen binary"


def counts(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Packed rows of each slice: its distinct grams by group (kind 0: key is the
    group, with each gram's number in training texts) and its training words
    (kind 1: key is the hash, n the number)."""
    shift = rest_shift(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            own = whole.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                keys, n, words = [], [], []
                for batch in slices(iter([whole.slice(a, b - a)]), "text", PART):
                    held = batch.column(1).to_numpy(zero_copy_only=False)
                    data, offsets = text_bytes(batch.column(2))
                    symbols, bounds = streams(data, offsets)
                    part = gram_keys(symbols, bounds, depth) * 2 + np.repeat(held, np.diff(bounds))
                    part, count = np.unique(part, return_counts=True)
                    keys.append(part >> 1)
                    n.append(np.where(part & 1, 0, count))
                    starts, ends = word_bounds(data, offsets)
                    train = ~np.repeat(held, np.diff(np.searchsorted(starts, offsets)))
                    words.append(word_hashes(lowered(data), starts, ends)[train])
                keys, n = add_up(np.concatenate(keys), np.concatenate(n))
                group, sizes = runs(keys, shift)
                words, m = np.unique(np.concatenate(words), return_counts=True)
                none = pa.nulls(len(words), pa.binary())
                for kind, key, size, grams, seen in (
                        (0, group, sizes, pack(keys & ((1 << shift) - 1), sizes, shift // 8),
                         pack(n, sizes, 4)),
                        (1, words.view(np.int64), m.astype(np.int64), none, none)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), kind, np.int32)),
                         pa.array(np.full(len(key), own[a])), pa.array(key), pa.array(size),
                         grams, seen], names=[f.split()[0] for f in PACKED.split(", ")])

    return texts.select("slice", "held_out", "text").mapInArrow(run, PACKED)


def merged(packed: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per group: its distinct grams and their numbers (8 bytes each).

    Rows arrive sorted; what is held is a stretch of them and the merged grams
    of the group that goes on, so memory does not grow with the slices.
    """
    shift = rest_shift(depth)

    def rows(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        group, sizes = runs(codes, shift)
        return pa.RecordBatch.from_arrays(
            [pa.array(group), pack(codes & ((1 << shift) - 1), sizes, shift // 8), pack(n, sizes, 8)],
            names=["key", "grams", "seen"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for table in as_batches(batches, "grams", 1 << 22):
            more, _ = codes_of(table, shift)
            codes, n = add_up(np.concatenate([codes, more]),
                              np.concatenate([n, unpack(table["seen"], 4)[0]]))
            at = int(np.searchsorted(codes, codes[-1] >> shift << shift))  # the last group may go on
            if at:
                yield rows(codes[:at], n[:at])
                codes, n = codes[at:], n[at:]
        if len(codes):
            yield rows(codes, n)

    own = packed.filter("kind = 0").select("key", "grams", "seen").repartition("key")
    return own.sortWithinPartitions("key").mapInArrow(run, "key long, grams binary, seen binary")


# --- the tree ----------------------------------------------------------------------

_SMALL = 1 << 14


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, for x of 8 and more."""
    inv = 1.0 / x
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) \
        + inv / 12 - inv ** 3 / 360 + inv ** 5 / 1260


def _at_counts(counts: np.ndarray, shift: float) -> np.ndarray:
    """log Gamma(count + shift), from a table for small counts."""
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_SMALL) + shift))])[:_SMALL]
    small += 0.5 * np.log(np.pi) if shift == 0.5 else 0.0
    low = counts < _SMALL
    out = small[np.where(low, counts, 0).astype(np.int64)]
    if not low.all():
        out[~low] = _log_gamma(counts[~low] + shift)
    return out


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the KT block probability of a zeros and b ones."""
    return _at_counts(a, 0.5) + _at_counts(b, 0.5) - _at_counts(a + b, 1.0) - np.log(np.pi)


class Group:
    """Grams (sorted keys and counts) below whole contexts of depth ``base``.

    A bit node of a context is the bits of the symbol decided so far; only nodes
    that a gram passes are held.
    """

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int, base: int) -> None:
        self.depth, self.base = depth, base
        self.keys, self.n, self.up = {depth: keys}, {depth: n}, {}
        for d in range(depth - 1, base - 1, -1):  # without the oldest symbol
            own = self.keys[d + 1]
            self.keys[d], self.up[d + 1] = np.unique(own >> 16 << 8 | own & 255, return_inverse=True)
            self.n[d] = np.bincount(self.up[d + 1], weights=self.n[d + 1])

    def weigh(self, bit: int) -> None:
        """For each depth the nodes at a bit: value, zeros, ones, log Pw, the weight of
        the own estimate, the row of the parent's node, and each gram's node."""
        self.value, self.zeros, self.ones, self.log_pw = {}, {}, {}, {}
        self.weight, self.parent, self.node = {}, {}, {}
        below = None
        for d in range(self.depth, self.base - 1, -1):
            value = self.keys[d] >> (8 - bit)
            new = np.diff(value, prepend=-1) != 0
            first = np.flatnonzero(new)
            self.value[d], self.node[d] = value[first], np.cumsum(new) - 1
            one = (self.keys[d] >> (7 - bit) & 1).astype(bool)
            self.ones[d] = np.add.reduceat(np.where(one, self.n[d], 0), first)
            self.zeros[d] = np.add.reduceat(np.where(one, 0, self.n[d]), first)
            own = log_kt(self.zeros[d], self.ones[d])
            if d == self.depth:
                self.log_pw[d], self.weight[d] = own, np.ones(len(own))
            else:
                self.parent[d + 1] = self.node[d][self.up[d + 1][below]]
                inner = np.bincount(self.parent[d + 1], weights=self.log_pw[d + 1])
                self.log_pw[d], self.weight[d] = _mix(own, inner)
            below = first

    def mixed(self, mixed: np.ndarray, free: np.ndarray) -> np.ndarray:
        """Log10 of each gram's decision, from what the depths above ``base`` give its node."""
        for d in range(self.base, self.depth + 1):
            if d > self.base:
                mixed, free = mixed[self.parent[d]], free[self.parent[d]]
            one = (self.ones[d] + 0.5) / (self.zeros[d] + self.ones[d] + 1)
            mixed = mixed + free * self.weight[d] * one
            free = free * (1 - self.weight[d])
        return np.clip(mixed, 1e-12, 1 - 1e-12)[self.node[self.depth]]


def _mix(own: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log Pw of a node with children, and the weight of its own estimate."""
    total = np.logaddexp(own, inner) - np.log(2)
    return total, np.exp(own - np.log(2) - total)


NODE_ROWS = "context long, node int, zeros double, ones double, below double"
WEIGHED = "context long, node int, zeros double, ones double, log_pw double, weight double"


def base_nodes(groups: DataFrame, depth: int, base: int) -> DataFrame:
    """Zeros, ones and log Pw of every (context of depth ``base``, bit node)."""
    shift = rest_shift(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in as_batches(batches, "grams", GRAMS * shift // 8):
            table = table.sort_by("key")
            group = Group(codes_of(table, shift)[0], unpack(table["seen"], 8)[0], depth, base)
            for bit in range(8):
                group.weigh(bit)
                value = group.value[base]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value >> bit),
                     pa.array(((value & ((1 << bit) - 1)) + (1 << bit)).astype(np.int32)),
                     pa.array(group.zeros[base].astype(float)),
                     pa.array(group.ones[base].astype(float)), pa.array(group.log_pw[base])],
                    names=[f.split()[0] for f in NODE_ROWS.split(", ")])

    return groups.mapInArrow(run, NODE_ROWS)


def shorter(nodes: DataFrame, value: str) -> DataFrame:
    """The nodes' parents, one symbol shorter, with their log Pw and weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zeros, ones, below = (batch.column(k).to_numpy() for k in (2, 3, 4))
            total, weight = _mix(log_kt(zeros, ones), below)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(total), pa.array(weight)],
                names=[f.split()[0] for f in WEIGHED.split(", ")])

    return nodes.groupBy(F.shiftright("context", 8).alias("context"), "node").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"),
        F.sum(value).alias("below")).mapInArrow(run, WEIGHED)


def gram_scores(heads: DataFrame, groups: DataFrame, depth: int, base: int) -> DataFrame:
    """(key, grams, logs) of every group: the log10 probability of each gram's
    symbol, as 4-byte floats.  ``heads``: what the depths above give to a
    group's nodes, at most 255 of them."""
    shift = rest_shift(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in as_batches(batches, "grams", GRAMS * shift // 8):
            table = table.sort_by("key")
            code, sizes = codes_of(table, shift)
            group = Group(code, unpack(table["seen"], 8)[0], depth, base)
            held = table["heads"].combine_chunks()
            flat = held.flatten()
            node, mixed, free = (flat.field(k).to_numpy() for k in range(3))
            at = np.repeat(table["key"].to_numpy(), held.value_lengths().to_numpy())
            logs = np.zeros(len(code))
            for bit in range(8):
                group.weigh(bit)
                own = np.flatnonzero(node >> bit == 1)
                value = (at[own] << bit) + node[own] - (1 << bit)
                order = np.argsort(value)
                if not np.array_equal(value[order], group.value[base]):
                    raise ValueError("a node without its parent's mixture")
                one = group.mixed(mixed[own][order], free[own][order])
                logs += np.log10(np.where(code >> (7 - bit) & 1, one, 1 - one))
            yield pa.RecordBatch.from_arrays(
                [table["key"].combine_chunks(), table["grams"].combine_chunks(),
                 floats(logs.astype(np.float32), sizes)], names=["key", "grams", "logs"])

    first = heads.groupBy("context").agg(F.collect_list(F.struct("node", "mixed", "free")).alias("heads"))
    rows = groups.join(first, F.col("key") == F.col("context")).select("key", "grams", "seen", "heads")
    return rows.mapInArrow(run, "key long, grams binary, logs binary")


def floats(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Runs of 4-byte floats as one binary value each."""
    ends = np.concatenate([[0], np.cumsum(sizes) * 4]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values, np.float32))])


def floats_of(column: pa.Array) -> np.ndarray:
    """The floats of all rows; a null row has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.buffers()[2] is None:
        return np.zeros(0, np.float32)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])), np.float32)


def log_table(spark: SparkSession, groups: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, grams, logs) of every group, as a stored table.

    ``groups``: the stored merged rows of the training and other texts.
    """
    base = min(BASE, depth)
    nodes = stored(spark, base_nodes(groups, depth, base), "nodes")
    levels, value = [nodes], "below"
    for d in range(base):
        levels.append(stored(spark, shorter(levels[-1], value), f"nodes-{base - 1 - d}"))
        value = "log_pw"
    heads = levels[0].select("context", "node", F.lit(0.0).alias("mixed"), F.lit(1.0).alias("free"))
    above = None
    for level in reversed(levels[1:]):  # depth 0 first
        share = F.col("free") * F.col("weight")
        if above is None:
            own = level.withColumn("mixed", F.lit(0.0)).withColumn("free", F.lit(1.0))
        else:
            own = _below(level, above)
        above = own.select(
            "context", "node",
            (F.col("mixed") + share * (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1))
            .alias("mixed"), (F.col("free") - share).alias("free"))
    if above is not None:
        heads = _below(levels[0], above).select("context", "node", "mixed", "free")
    logs = stored(spark, gram_scores(heads, groups, depth, base), "logs")
    discard(*levels)
    return logs


def _below(level: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes of a depth with the mixture of their parents."""
    up = above.withColumnsRenamed({"context": "_up", "node": "_node"})
    return level.join(up, (F.shiftright("context", 8) == F.col("_up"))
                      & (F.col("node") == F.col("_node")))


def to_slices(packed: DataFrame, logs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(slice, key, grams, logs): each packed row with the logs of its grams.

    Sorted by group, a group's logs come first and its slices' rows after, so a
    task holds a stretch of rows and one group's logs.
    """
    shift = rest_shift(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, log = np.zeros(0, np.int64), np.zeros(0, np.float32)
        for table in as_batches(batches, "grams", 1 << 22):
            of = table["slice"].to_numpy() < 0
            first, rows = table.filter(pa.array(of)), table.filter(pa.array(~of))
            known = np.concatenate([known, codes_of(first, shift)[0]])
            log = np.concatenate([log, floats_of(first["logs"])])
            code, sizes = codes_of(rows, shift)
            own = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
            if len(code) and not np.array_equal(known[own], code):
                raise ValueError("a gram without its score")
            if rows.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [rows[c].combine_chunks() for c in ("slice", "key", "grams")]
                    + [floats(log[own], sizes)], names=["slice", "key", "grams", "logs"])
            at = int(np.searchsorted(known, known[-1] >> shift << shift)) if len(known) else 0
            known, log = known[at:], log[at:]

    rows = packed.filter("kind = 0").select("key", "slice", "grams", F.lit(None).cast("binary").alias("logs"))
    first = logs.select("key", F.lit(-1).cast("long").alias("slice"), "grams", "logs")
    both = rows.unionByName(first).repartition("key").sortWithinPartitions("key", "slice")
    return both.mapInArrow(run, "slice long, key long, grams binary, logs binary")


# --- words -------------------------------------------------------------------------

def frequent_words(table: DataFrame, closings: int,
                   frequent: int = FREQUENT) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Training tokens, distinct ones, and the frequent words' hashes (sorted)
    and counts, at most ``frequent`` of them; from a stored table of key and n."""
    n, v = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = n + closings, v + (closings > 0)
    words = table.filter(F.col("n") >= -(-tokens // frequent)).toArrow()
    hashes = words["key"].to_numpy()
    order = np.argsort(hashes)
    return tokens, distinct, hashes[order], words["n"].to_numpy()[order].astype(np.int64)


def _find(known: np.ndarray, seen: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the words among the frequent ones, and whether they are there."""
    if len(known) == 0:
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    there = known[at] == hashes
    return np.where(there, seen[at], 0), there


# --- scores --------------------------------------------------------------------------

SCORE_SCHEMA = ("doc_id long, held_out boolean, row_key long, n_tokens long, known long, "
                "base double, n_rare long, score double")


def score(spark: SparkSession, documents: DataFrame, depth: int = DEPTH,
          frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = stored(spark, sliced(documents), "slices")
    packed = stored(spark, counts(texts, depth), "packed")
    words = stored(spark, packed.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")), "words")
    groups = stored(spark, merged(packed, depth), "groups")
    closings = texts.filter("NOT held_out").count()
    tokens, distinct, hashes, seen = frequent_words(words, closings, frequent)
    logs = log_table(spark, groups, depth)
    shared = spark.sparkContext.broadcast((hashes, seen))  # plain arrays
    norm = float(tokens + distinct + 1)
    shift = rest_shift(depth)

    def per_text(texts: pa.Table, rows: pa.Table) -> pa.Table:
        code, log = codes_of(rows, shift)[0], floats_of(rows["logs"])
        order = np.argsort(code)
        code, log = code[order], log[order]
        out = []
        for batch in slices(iter(texts.combine_chunks().to_batches()), "text", PART):
            data, offsets = text_bytes(batch["text"])
            starts, ends = word_bounds(data, offsets)
            count, there = _find(*shared.value, word_hashes(lowered(data), starts, ends).view(np.int64))
            first = np.searchsorted(starts, offsets)

            def per_doc(x: np.ndarray) -> np.ndarray:
                run = np.concatenate([[0], np.cumsum(x)])
                return run[first[1:]] - run[first[:-1]]

            base = np.where(there, np.log10((count + 1) / norm), 0.0)
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            base = np.bincount(doc, weights=base, minlength=len(first) - 1)
            symbols, bounds = streams(data, offsets)
            keys, back = np.unique(gram_keys(symbols, bounds, depth), return_inverse=True)
            own = np.minimum(np.searchsorted(code, keys), len(code) - 1)
            if not np.array_equal(code[own], keys):
                raise ValueError("a gram without its score")
            columns = [pa.array(np.diff(first) + 1),
                       pa.array(per_doc(there.astype(np.int64)) + (closings > 0)),
                       pa.array(base + np.log10((closings + 1) / norm)),
                       pa.array(per_doc((~there).astype(np.int64))),
                       pa.array(np.add.reduceat(log[own].astype(np.float64)[back], bounds[:-1]))]
            out.append(pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], batch["row_key"], *columns],
                names=[f.split()[0] for f in SCORE_SCHEMA.split(", ")]))
        return pa.Table.from_batches(out)

    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            data, offsets = text_bytes(batch.column(2))
            starts, ends = word_bounds(data, offsets)
            hashes = word_hashes(lowered(data), starts, ends).view(np.int64)
            _, there = _find(*shared.value, hashes)
            doc = np.repeat(np.arange(batch.num_rows),
                            np.diff(np.searchsorted(starts, offsets)))[~there]
            doc = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(doc), batch.column(1).take(doc), pa.array(hashes[~there])],
                names=["doc_id", "row_key", "key"])

    met = to_slices(packed, logs, depth)
    scored = stored(spark, texts.groupBy("slice").cogroup(met.groupBy("slice")).applyInArrow(
        per_text, SCORE_SCHEMA), "scored")
    # no frequent word is here, so no key is a hot one
    met = texts.select("doc_id", "row_key", "text").mapInArrow(
        rare_words, "doc_id long, row_key long, key long").join(words, "key", "left")
    n = F.coalesce("n", F.lit(0))
    rare = stored(spark, met.groupBy("doc_id", "row_key").agg(
        F.count(F.lit(1)).alias("words"), F.count("n").alias("found"),
        F.sum(F.log10((n + 1) / F.lit(norm))).alias("logs")), "rare")
    discard(texts, packed, words, groups, logs)
    s, r = scored.alias("s"), rare.alias("r")
    out = s.join(r, F.col("s.doc_id").eqNullSafe(F.col("r.doc_id"))
                 & (F.col("s.row_key").eqNullSafe(F.col("r.row_key"))), "left")
    # rows that share id and text were summed together: each takes its share
    share = F.coalesce(F.col("n_rare") / F.col("words"), F.lit(0.0))
    return out.select(
        "s.doc_id", "held_out", "n_tokens",
        (F.col("known") + F.round(F.coalesce("found", F.lit(0)) * share).cast("long")).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0)) * share).alias("base_score"), "score")
