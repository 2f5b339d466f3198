"""Byte-level BPE ids of many texts at once.

The pre-tokenizer never joins a word to what precedes a single space or line
feed between two visible characters, so texts may be cut there.  The cut units
are dictionary-encoded by Arrow and only distinct ones are merged; ids are then
spread back by index.  The ids equal those of encoding every text whole.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import tiktoken

from murmuration.functions.shipping import ship_by_value

ship_by_value(__name__)


def blanks(data: np.ndarray) -> np.ndarray:
    """Bytes of characters that the pre-tokenizer may take for white space."""
    out = (data == 32) | ((data >= 9) & (data <= 13)) | ((data >= 0x1C) & (data <= 0x1F))
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    if len(lead) == 0:
        return out
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = padded[lead], padded[lead + 1], padded[lead + 2]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) \
        | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) \
        | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
    for found, width in ((lead[two], 2), (lead[three], 3)):
        for k in range(width):
            out[found + k] = True
    return out


class Encoder:
    """Encoder over a rank file; special tokens are ordinary text."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.newline = self.own.encode_ordinary("\n")[0]

    def decode(self, ids: np.ndarray) -> str:
        return self.own.decode(ids.tolist())

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the units, and whether each is ``space? visible+``."""
        blank = blanks(data)
        shown = ~blank
        inner = np.zeros(len(data), bool)
        if len(data) > 2:
            inner[1:-1] = blank[1:-1] & shown[:-2] & shown[2:]
        starts = inner & ((data == 32) | (data == 10))
        after = inner & (data == 10)
        starts[1:] |= after[:-1]
        starts[offsets[:-1][np.diff(offsets) > 0]] = True
        begin = np.flatnonzero(starts)
        if len(begin) == 0:
            return begin, np.zeros(0, bool)
        n_blank = np.add.reduceat(blank.astype(np.int64), begin)
        led = data[begin] == 32
        wide = np.diff(np.append(begin, len(data))) > 1
        return begin, (n_blank == 0) | ((n_blank == 1) & led & wide)

    def merge(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and id counts of adjoining units data[bounds[i]:bounds[i+1]] that
        hold no inner white space: one call for many, parted by line feeds,
        which are always a token of their own."""
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(bounds) - 1, 50_000):
            own = bounds[at:at + 50_001]
            parted = np.full(own[-1] - own[0] + len(own) - 2, 10, np.uint8)
            inside = np.ones(len(parted), bool)
            inside[own[1:-1] - own[0] + np.arange(len(own) - 2)] = False
            parted[inside] = data[own[0]:own[-1]]
            got = np.array(self.own.encode_ordinary(parted.tobytes().decode("utf-8", "replace")),
                           np.int32)
            between = got == self.newline
            cut = np.concatenate([[-1], np.flatnonzero(between), [len(got)]])
            if len(cut) != len(own):
                raise ValueError("a separator was merged")
            counts.append(np.diff(cut) - 1)
            ids.append(got[~between])
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts data[offsets[i]:offsets[i+1]] and the n+1 offsets of their ids."""
        if len(data) == 0:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        begin, plain = self.units(data, offsets)
        bounds = np.append(begin, len(data)).astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(begin), [
            None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = units.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        simple = np.zeros(len(coded.dictionary), bool)
        simple[index] = plain
        many = coded.dictionary.filter(pa.array(simple))
        _, ends, raw = many.buffers()
        ends = np.frombuffer(ends, np.int32)[many.offset:many.offset + len(many) + 1]
        counts = np.zeros(len(simple), np.int64)
        ids, counts[simple] = self.merge(
            np.frombuffer(raw, np.uint8) if raw is not None else data[:0], ends)
        rest = [self.own.encode_ordinary(u.decode("utf-8", "replace"))
                for u in coded.dictionary.filter(pa.array(~simple)).to_pylist()]
        counts[~simple] = [len(x) for x in rest]
        pool = np.concatenate([ids, np.asarray([i for x in rest for i in x], np.int32)])
        at = np.empty(len(simple), np.int64)
        at[simple] = np.cumsum(counts[simple]) - counts[simple]
        at[~simple] = len(ids) + np.cumsum(counts[~simple]) - counts[~simple]
        lengths = counts[index]
        before = np.concatenate([[0], np.cumsum(lengths)])
        # one pass: the place in the pool of each id is its own place plus its unit's shift
        shift = np.repeat((at[index] - before[:-1]).astype(np.int32), lengths)
        shift += np.arange(len(shift), dtype=np.int32)
        return pool[shift], before[np.searchsorted(begin, offsets)]
