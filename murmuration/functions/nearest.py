"""Nearest center of many points at once, in NumPy, for any dimension.

Distances are sums of squared differences taken coordinate by coordinate, so a
point's distance to a center is the same bits in whatever batch it arrives.
Beyond ``DENSE`` centers they are dealt to about sqrt(K) pivots; by the triangle
inequality a group is looked at only for points whose distance to the pivot,
less the group's radius, can still win.  Bounds carry a margin for rounding, and
the lowest id wins ties, so the ids equal those of comparing every pair.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from murmuration.functions.shipping import ship_by_value

ship_by_value(__name__)

DENSE = 64           # centers up to which every pair is compared
CELLS = 1 << 20      # distances held at once


def squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, N x K."""
    out = np.zeros((len(points), len(centers)))
    for j in range(points.shape[1]):
        step = points[:, j, None] - centers[None, :, j]
        out += step * step
    return out


class Nearest:
    """``ids`` and ``centers`` (K x D), searched for the nearest of each point."""

    def __init__(self, ids: Sequence[int], centers: np.ndarray) -> None:
        order = np.argsort(np.asarray(ids, np.int64))
        self.ids = np.asarray(ids, np.int64)[order]
        self.centers = np.asarray(centers, np.float64)[order]
        self.margin = 4 * (self.centers.shape[1] + 4) * 2.0 ** -53
        self.groups = None
        if len(self.ids) > DENSE:
            self._deal()

    def _deal(self) -> None:
        """Pivots far from one another, each center to the nearest of them."""
        own = [0]
        gap = squared(self.centers, self.centers[:1])[:, 0]
        for _ in range(int(np.sqrt(len(self.ids)))):
            own.append(int(np.argmax(gap)))
            gap = np.minimum(gap, squared(self.centers, self.centers[own[-1:]])[:, 0])
        self.pivots = self.centers[own]
        away = squared(self.centers, self.pivots)
        home = np.argmin(away, axis=1)
        self.groups = [np.flatnonzero(home == g) for g in range(len(own))]
        self.radius = np.array([np.sqrt(away[m, g].max()) if len(m) else -np.inf
                                for g, m in enumerate(self.groups)])

    def find(self, points: np.ndarray) -> tuple[np.ndarray, int]:
        """The nearest center's id of every point (N x D), and how many
        distances were taken."""
        out = np.zeros(len(points), np.int64)
        taken, wide = 0, len(self.ids) if self.groups is None else len(self.pivots)
        step = max(1, CELLS // wide)
        for at in range(0, len(points), step):
            part = points[at:at + step]
            if self.groups is None:
                out[at:at + step] = self.ids[np.argmin(squared(part, self.centers), axis=1)]
                taken += len(part) * wide
            else:
                found, n = self._pruned(part)
                out[at:at + step] = self.ids[found]
                taken += n
        return out, taken

    def _pruned(self, points: np.ndarray) -> tuple[np.ndarray, int]:
        away = np.sqrt(squared(points, self.pivots))
        home = np.argmin(away, axis=1)
        least = (away - self.radius) - self.margin * (away + np.abs(self.radius))
        best = np.full(len(points), np.inf)
        place = np.full(len(points), len(self.ids))
        taken = away.size
        for near in (True, False):
            for g, members in enumerate(self.groups):
                if len(members) == 0:
                    continue
                wanted = home == g
                if not near:
                    wanted = ~wanted & (least[:, g] <= np.sqrt(best) * (1 + self.margin))
                rows = np.flatnonzero(wanted)
                for a in range(0, len(rows), max(1, CELLS // len(members))):
                    own = rows[a:a + max(1, CELLS // len(members))]
                    d = squared(points[own], self.centers[members])
                    taken += d.size
                    first = np.argmin(d, axis=1)
                    d, first = d[np.arange(len(own)), first], members[first]
                    won = (d < best[own]) | ((d == best[own]) & (first < place[own]))
                    best[own[won]], place[own[won]] = d[won], first[won]
        return place, taken
