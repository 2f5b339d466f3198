"""The Arrow-batched argmin's expanded form equals the direct distance form."""

from __future__ import annotations

import numpy as np
import pytest

from murmuration.functions.vectorized import EXACT_BOUND, _argmin


@pytest.mark.parametrize("hi", [10, 5000, EXACT_BOUND - 1, 2**31 - 1])
def test_expanded_argmin_is_exact(hi):
    rng = np.random.default_rng(hi % 1000)
    for trial in range(40):
        n, k = int(rng.integers(1, 2000)), int(rng.integers(1, 60))
        xv, yv = rng.integers(-hi, hi, n), rng.integers(-hi, hi, n)
        cx, cy = rng.integers(-hi, hi, k), rng.integers(-hi, hi, k)
        if trial % 3 == 0:  # duplicate centers force ties
            cx[-1], cy[-1] = cx[0], cy[0]
        ids = np.arange(k, dtype=np.int64) * 7
        dx = (xv[:, None] - cx[None, :]).astype(np.float64)
        dy = (yv[:, None] - cy[None, :]).astype(np.float64)
        direct = ids[np.argmin(dx * dx + dy * dy, axis=1)]
        assert (_argmin(xv, yv, ids, cx, cy, 500) == direct).all()


def test_empty_batch():
    e = np.array([], dtype=np.int64)
    assert len(_argmin(e, e, np.array([1]), np.array([0]), np.array([0]), 10)) == 0
