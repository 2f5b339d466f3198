"""SentencePiece encoding by forward-filtering backward-sampling (operator 4).

A text is ``▁`` plus its characters with each space as ``▁``.  Its lattice has
an edge for every vocabulary piece; a piece of score s weighs
``exp(ALPHA * s)``.  Characters without a piece pass through their byte pieces.
Forward filtering sums the weights of all ways to each position; backward
sampling draws the last piece, then the one before it, and so on, in proportion.
Draws are hashes of (seed, doc_id, unit, step), so a row's segmentation does not
depend on partitions or on other rows.

No piece holds a line feed, or a ``▁`` after another character, so the lattice
falls apart into units at line feeds and before runs of spaces; distinct units
are filtered once per slice of texts and every occurrence is sampled by itself.

Decoding joins the pieces; a ``▁`` of the text itself is written as bytes, so
the text comes back exactly.  Defined results: a null text counts as empty (one
``▁``); a null doc_id draws as id 0; rows with the same doc_id and text are
encoded alike; texts of any length are read whole; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.common import mix, slices, text_bytes

ship_by_value(__name__)

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHA = 5e-4   # scores of the file are negative merge ranks
BYTE_PENALTY = 10.0
SEED = 20
SPACE = "▁".encode()
LONG = 4096  # bytes of a unit that is filtered and sampled by itself

SCHEMA = ("doc_id long, n_pieces long, ids array<int>, ids_crc32 long, text_crc32 long, "
          "lossless boolean")


def _mixed(x: int) -> int:
    """``common.mix`` of one number."""
    whole = (1 << 64) - 1
    x = (x + 0x9E3779B97F4A7C15) & whole
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & whole
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & whole
    return x ^ (x >> 31)


class Lattice:
    """Piece weights of a model file as a byte trie, and the sampler over them.

    Pieces are held with spaces for their marks, so texts are matched as they
    are; a mark that a text contains has no piece and passes as bytes.
    """

    def __init__(self, path: str, alpha: float) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes_ = np.zeros(256, np.int32)
        shown: list[bytes] = []
        pieces: list[tuple[bytes, int, float]] = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes_[value] = i
                shown.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                shown.append(b"")
            else:
                raw = piece.encode()
                if b"\n" in raw or SPACE in raw.lstrip(SPACE):
                    raise ValueError("a piece crosses a unit bound")
                shown.append(raw.replace(SPACE, b" "))
                pieces.append((shown[-1], i, alpha * model.get_score(i)))
        self.byte_weight = min(w for _, _, w in pieces) - BYTE_PENALTY
        self.shown = pa.array(shown, pa.binary())
        self.longest = max(len(p) for p, _, _ in pieces)
        steps: list[dict[int, int]] = [{}]
        ends: dict[int, tuple[int, float]] = {}
        for raw, i, w in pieces:
            at = 0
            for c in raw:
                to = steps[at].get(c)
                if to is None:
                    to = steps[at][c] = len(steps)
                    steps.append({})
                at = to
            ends[at] = (i, w)
        self.next = np.zeros((len(steps), 256), np.int32)  # 0: no such step
        for at, own in enumerate(steps):
            for c, to in own.items():
                self.next[at, c] = to
        self.piece = np.full(len(steps), -1, np.int32)
        self.weight = np.zeros(len(steps))
        for at, (i, w) in ends.items():
            self.piece[at], self.weight[at] = i, w

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the units, and the offsets of each text's units."""
        starts = np.zeros(len(data), bool)
        space, feed = data == 32, data == 10
        starts[1:] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
        starts[offsets[:-1]] = True
        begin = np.flatnonzero(starts)
        return begin, np.searchsorted(begin, offsets)

    def edges(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """The lattices of units data[ends[u]:ends[u+1]], end to end.

        A unit of n bytes has n+1 nodes; byte p of unit u is node p + u.
        Returns low (edges into node v are low[v]:low[v+1]), and the origin,
        piece and weight of every edge.
        """
        unit = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        stop = ends[1:][unit]
        head = (data & 0xC0) != 0x80
        head[ends[:-1]] = True
        heads = np.flatnonzero(head)
        width = np.diff(np.append(heads, len(data)))  # of each character
        width = np.minimum(width, stop[heads] - heads)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        whole = np.zeros(len(heads), bool)  # characters that are a piece
        live, state = np.arange(len(heads)), np.zeros(len(heads), np.int32)
        for k in range(self.longest):
            at = heads[live]
            inside = at + k < stop[at]
            live, state = live[inside], state[inside]
            state = self.next[state, data[heads[live] + k]]
            live, state = live[state > 0], state[state > 0]
            hit = self.piece[state] >= 0
            own, node = live[hit], state[hit]
            whole[own[width[own] == k + 1]] = True
            start = heads[own]
            found.append((start + unit[start], start + unit[start] + k + 1,
                          self.piece[node], self.weight[node]))
        lost = ~whole
        for k in range(int(width[lost].max()) if lost.any() else 0):
            start = heads[lost & (width > k)] + k  # byte by byte; the first carries the weight
            node = start + unit[start]
            found.append((node, node + 1, self.bytes_[data[start]],
                          np.full(len(start), self.byte_weight if k == 0 else 0.0)))
        nodes = len(data) + len(ends) - 1
        count = np.zeros(nodes + 1, np.int64)
        for _, to, _, _ in found:
            count[to + 1] += 1  # an origin and length meet a node once
        low = np.cumsum(count)
        fill = low[:-1].copy()
        origin = np.empty(low[-1], np.int64)
        token = np.empty(low[-1], np.int32)
        weight = np.empty(low[-1])
        for start, to, piece, w in found:
            place = fill[to]
            origin[place], token[place], weight[place] = start, piece, w
            fill[to] += 1
        return low, origin, token, weight

    def filter(self, ends: np.ndarray, low: np.ndarray, origin: np.ndarray,
               weight: np.ndarray) -> np.ndarray:
        """Cumulated probability of every edge among those into its node.

        All units advance together, one byte position at a time; sums are kept
        as logarithms, so a long unit cannot underflow.
        """
        size = np.diff(ends)
        nodes = len(low) - 1
        root = np.repeat(ends[:-1] + np.arange(len(size)), size + 1)
        place = np.arange(nodes) - root
        into = np.diff(low)
        some = np.flatnonzero(into > 0)
        long = np.repeat(size > LONG, size + 1)
        some = some[~long[some]]
        small = len(size) and int(size.max()) < 1 << 16
        some = some[np.argsort(place[some].astype(np.uint16 if small else np.int64), kind="stable")]
        cuts = np.flatnonzero(np.diff(place[some])) + 1
        sums = np.zeros(nodes)
        cum = np.ones(len(origin))
        for own in np.split(some, cuts):
            n = into[own]
            first = np.cumsum(n) - n
            edge = np.arange(int(n.sum())) + np.repeat(low[own] - first, n)
            value = sums[origin[edge]] + weight[edge]
            top = np.maximum.reduceat(value, first)
            share = np.exp(value - np.repeat(top, n))
            total = np.add.reduceat(share, first)
            sums[own] = top + np.log(total)
            share /= np.repeat(total, n)
            run = np.cumsum(share)
            run -= np.repeat(run[first] - share[first], n)
            run[first + n - 1] = 1.0
            cum[edge] = run
        for u in np.flatnonzero(size > LONG).tolist():
            a = int(ends[u]) + u
            self._filter_long(a, a + int(size[u]), low, origin, weight, cum)
        return cum

    def _filter_long(self, root: int, end: int, low: np.ndarray, origin: np.ndarray,
                     weight: np.ndarray, cum: np.ndarray) -> None:
        """The same for one long unit, node by node: its positions are too many
        for a step over arrays each."""
        first = int(low[root + 1])
        begin = (low[root + 1:end + 2] - first).tolist()
        start = (origin[first:first + begin[-1]] - root).tolist()
        own = weight[first:first + begin[-1]].tolist()
        out = [1.0] * begin[-1]
        sums = [0.0] * (end - root + 1)
        for v in range(1, end - root + 1):
            a, b = begin[v - 1], begin[v]
            if a == b:
                continue
            value = [sums[start[e]] + own[e] for e in range(a, b)]
            top = max(value)
            share = [math.exp(x - top) for x in value]
            total = sum(share)
            sums[v] = top + math.log(total)
            run = 0.0
            for e, x in zip(range(a, b - 1), share):
                run += x / total
                out[e] = run
        cum[first:first + begin[-1]] = out

    @staticmethod
    def _walk_long(row: int, node: int, root: int, low: np.ndarray, origin: np.ndarray,
                   token: np.ndarray, cum: np.ndarray) -> list[int]:
        """Pieces of one long unit from its end, with the draws of ``sample``."""
        first = int(low[root + 1])
        begin = (low[root + 1:node + 2] - first).tolist()
        stop = begin[-1]
        start, piece, chance = (x[first:first + stop].tolist() for x in (origin - root, token, cum))
        at, out = node - root, []
        while at:
            a, b = begin[at - 1], begin[at]
            if b - a > 1:
                draw = (_mixed(row + len(out)) >> 11) * 2.0 ** -53
                while chance[a] <= draw:
                    a += 1
            out.append(piece[a])
            at = start[a]
        return out

    def sample(self, texts: pa.Array, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every text, and their n+1 offsets."""
        raw, ends = text_bytes(texts)
        n = len(ends) - 1
        # a space before each text, the mark that the vocabulary expects
        offsets = ends + np.arange(n + 1)
        data = np.full(offsets[-1], 32, np.uint8)
        inside = np.ones(len(data), bool)
        inside[offsets[:-1]] = False
        data[inside] = raw
        begin, first = self.units(data, offsets)
        bounds = np.append(begin, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(begin), [
            None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        _, stops, held = coded.dictionary.buffers()
        stops = np.frombuffer(stops, np.int32)[:len(coded.dictionary) + 1].astype(np.int64)
        own = np.frombuffer(held, np.uint8)[:stops[-1]] if len(begin) else data[:0]
        low, origin, token, weight = self.edges(own, stops)
        cum = self.filter(stops, low, origin, weight)

        # walk every occurrence back from its end; all of them step together
        doc = np.repeat(np.arange(n), np.diff(first))
        with np.errstate(over="ignore"):
            row = mix(mix(keys.view(np.uint64) + np.uint64(seed))[doc]
                      + (np.arange(len(index)) - first[:-1][doc]).astype(np.uint64))
            long = np.diff(stops)[index] > LONG
            live = np.flatnonzero(~long)
            root = stops[index] + index
            node = stops[index + 1] + index
            steps = np.zeros(len(index), np.int64)
            walked = {i: self._walk_long(int(row[i]), int(node[i]), int(root[i]), low, origin, token, cum)
                      for i in np.flatnonzero(long).tolist()}
            for i, own in walked.items():
                steps[i] = len(own)
            node = node[live]
            taken: list[tuple[np.ndarray, np.ndarray]] = []
            while len(live):
                edge = low[node]
                many = np.flatnonzero(low[node + 1] - edge > 1)
                draw = (mix(row[live[many]] + np.uint64(len(taken))) >> np.uint64(11)) * 2.0 ** -53
                while len(many):
                    on = cum[edge[many]] <= draw
                    many, draw = many[on], draw[on]
                    edge[many] += 1
                taken.append((live, token[edge]))
                steps[live] += 1
                node = origin[edge]
                on = node != root[live]
                live, node = live[on], node[on]
        stop = np.cumsum(steps)
        out = np.empty(int(stop[-1]) if len(stop) else 0, np.int32)
        for s, (who, piece) in enumerate(taken):
            out[stop[who] - 1 - s] = piece
        for i, own in walked.items():
            out[stop[i] - len(own):stop[i]] = own[::-1]
        return out, np.concatenate([[0], stop])[first]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The texts of ids[bounds[i]:bounds[i+1]]."""
        joined = self.shown.take(pa.array(ids))
        _, ends, raw = joined.buffers()
        ends = np.frombuffer(ends, np.int32)[:len(ids) + 1]
        raw = raw.to_pybytes() if raw is not None else b""
        at = ends[bounds].tolist() if len(ids) else [0] * len(bounds)
        return [raw[a + 1:b] for a, b in zip(at, at[1:])]


def encode(documents: DataFrame, model: str = MODEL, alpha: float = ALPHA,
           seed: int = SEED) -> DataFrame:
    """Sampled piece ids of every text, and whether decoding gives it back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model, alpha)
        for batch in slices(batches, "text", 8 << 20):
            keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids, bounds = lattice.sample(batch.column(1), keys, seed)
            raw, offsets = text_bytes(batch.column(1))
            raw = raw.tobytes()
            at = offsets.tolist()
            texts = lattice.decode(ids, bounds)
            crc = [zlib.crc32(t) for t in texts]
            same = [t == raw[a:b] for t, a, b in zip(texts, at, at[1:])]
            flat = ids.astype("<i4")
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                 pa.array(sums, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, model: str = MODEL, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model, alpha)
        for batch in batches:
            lists = batch.column(1)
            bounds = np.asarray(lists.offsets)
            texts = lattice.decode(lists.values.to_numpy()[bounds[0]:bounds[-1]], bounds - bounds[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())],
                names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
