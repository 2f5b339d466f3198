"""A context tree held in memory: what the grouped tree of ``ctw`` is compared with."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from murmuration.llm.ctw import before, log_kt


def gram_codes(symbols: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """Context (oldest symbol highest) and symbol as one number."""
    code = symbols.astype(np.int64)
    for d, c in enumerate(before(symbols, bounds, depth), 1):
        code |= c.astype(np.int64) << (8 * d)
    return code


@dataclass
class Level:
    """Contexts of one depth: codes (sorted), symbol counts and the parent's row."""

    codes: np.ndarray
    counts: np.ndarray
    parent: np.ndarray


def build_levels(rows: list[tuple[np.ndarray, np.ndarray]]) -> list[Level]:
    """Levels from (gram codes, counts) of depth 0, 1, ...; a deeper context's
    parent is always present.  ``rows`` is emptied on the way."""
    levels: list[Level] = []
    for depth in range(len(rows)):
        grams, n = rows[depth]
        rows[depth] = None
        codes, row = np.unique(grams >> 8, return_inverse=True)
        counts = np.zeros((len(codes), 256))
        counts[row, grams & 255] = n
        parent = np.zeros(len(codes), np.int64)
        if depth:
            parent = np.searchsorted(levels[-1].codes, codes & ((1 << (8 * (depth - 1))) - 1))
        levels.append(Level(codes, counts, parent))
    return levels


def _split(levels: list[Level], d: int, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of every decision at one bit, for all contexts of a depth."""
    counts = levels[d].counts
    both = counts.reshape(len(counts), 1 << bit, 2, 128 >> bit).sum(axis=3)
    return both[:, :, 0], both[:, :, 1]


def _rest(levels: list[Level], d: int, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for the symbols below no child in the tree."""
    out = _split(levels, d, bit)
    if d + 1 < len(levels):
        for own, child in zip(out, _split(levels, d + 1, bit)):
            np.subtract.at(own, levels[d + 1].parent, child)
    return out


def log_probabilities(levels: list[Level]) -> list[np.ndarray]:
    """log10 of each symbol's probability at every context.

    ``own[d][r, s]`` belongs to positions whose longest context in the tree is
    row r of depth d.
    """
    depth = len(levels) - 1
    own = [np.zeros((len(v.codes), 256), np.float32) for v in levels]
    for bit in range(8):
        weight: list[np.ndarray] = [np.zeros(0)] * (depth + 1)
        below = None  # sum of the children's log Pw
        for d in range(depth, -1, -1):
            total = log_kt(*_split(levels, d, bit))
            if d == depth:
                weight[d] = np.ones_like(total)
            else:
                inner = below + log_kt(*_rest(levels, d, bit))
                estimate = total - np.log(2)
                total = np.logaddexp(estimate, inner - np.log(2))
                weight[d] = np.exp(estimate - total)
            if d:
                below = np.zeros((len(levels[d - 1].codes), 1 << bit))
                np.add.at(below, levels[d].parent, total)
        mixed = free = None
        for d in range(depth + 1):
            zeros, ones = _split(levels, d, bit)
            up, left = (0.0, 1.0) if d == 0 else (mixed[levels[d].parent], free[levels[d].parent])
            mixed = up + left * weight[d] * (ones + 0.5) / (zeros + ones + 1)
            free = left * (1 - weight[d])
            zeros, ones = _rest(levels, d, bit)
            one = mixed if d == depth else mixed + free * (ones + 0.5) / (zeros + ones + 1)
            one = np.clip(one, 1e-12, 1 - 1e-12)
            steps = np.stack([np.log10(1 - one), np.log10(one)], axis=2).astype(np.float32)
            own[d] += np.repeat(steps.reshape(len(one), 2 << bit), 128 >> bit, axis=1)
    return own


@dataclass
class Model:
    """A small tree in memory: a step table per depth and one row of symbol scores per context."""

    steps: list[np.ndarray]  # steps[d][row * 256 + older symbol] -> row of depth d+1, or -1
    first: list[int]         # first table row of each depth
    table: np.ndarray        # (contexts, 256) log10 probabilities

    def rows(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Table row of the longest context in the tree for every symbol."""
        at = np.zeros(len(symbols), np.int32)
        row = np.zeros(len(symbols), np.int32)
        live = np.ones(len(symbols), bool)
        for d, c in enumerate(before(symbols, bounds, len(self.steps))):
            nxt = self.steps[d][at * 256 + c]
            live &= nxt >= 0
            at = np.where(live, nxt, 0).astype(np.int32)
            row = np.where(live, at + self.first[d + 1], row).astype(np.int32)
        return row

    def scores(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """log10 probability of each text."""
        logs = self.table[self.rows(symbols, bounds), symbols].astype(np.float64)
        return np.add.reduceat(logs, bounds[:-1]) if len(bounds) > 1 else np.zeros(0)


def make_model(rows: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    levels = build_levels(rows)
    own = log_probabilities(levels)
    for level in levels:
        level.counts = None
    steps = []
    for d in range(len(levels) - 1):
        step = np.full(max(len(levels[d].codes), 1) * 256, -1, np.int32)
        child = levels[d + 1]
        step[child.parent * 256 + (child.codes >> (8 * d))] = np.arange(len(child.codes))
        steps.append(step)
    first = np.concatenate([[0], np.cumsum([len(v.codes) for v in levels])]).astype(int)
    return Model(steps=steps, first=first.tolist(), table=np.concatenate(own))
