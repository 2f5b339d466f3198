"""Scalar expressions shared by the operators.

Everything here returns a ``Column`` built from Spark's own functions, so it
stays inside whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: What a trim removes: every character up to and including the space.
BLANKS = "".join(map(chr, range(33)))


def trimmed(c: Column | str) -> Column:
    """Text without characters up to U+0020 at either end."""
    return F.btrim(_col(c), F.lit(BLANKS))


def norm_text(c: Column | str) -> Column:
    """Trimmed, lower-cased text: the case-insensitive match key."""
    return F.lower(trimmed(c))


def squared_distance(x: Column, y: Column, cx, cy) -> Column:
    """Squared Euclidean distance as DOUBLE.

    Differences are taken on LONG (exact) and squared as DOUBLE, so no LONG
    overflow is possible and the result is exact while it stays below 2^53.
    """
    dx = (x - F.lit(cx) if not isinstance(cx, Column) else x - cx).cast(T.DoubleType())
    dy = (y - F.lit(cy) if not isinstance(cy, Column) else y - cy).cast(T.DoubleType())
    return dx * dx + dy * dy


def nearest_center(x: Column | str, y: Column | str,
                   centers: Sequence[tuple[int, int, int]]) -> Column:
    """Id of the nearest center; the lowest id wins ties (built-in form).

    ``centers`` is a short list of ``(center_id, cx, cy)`` held by the driver
    (K rows), unrolled as literals: the minimum squared distance (``least``)
    and the position of its first occurrence among the distances
    (``array_position``), ordered by center id.  One codegen'd expression per
    row (Spark eliminates the repeated distance subexpressions), no join, no
    lambda, no shuffle.  ``functions.vectorized`` has the Arrow-batched form,
    faster once K grows.
    """
    if not centers:
        raise ValueError("nearest_center needs at least one center")
    x, y = _col(x), _col(y)
    ordered = sorted((int(i), int(cx), int(cy)) for i, cx, cy in centers)
    if len(ordered) == 1:
        return F.when(x.isNotNull() & y.isNotNull(), F.lit(ordered[0][0]).cast(T.LongType()))
    ds = [squared_distance(x, y, cx, cy) for _, cx, cy in ordered]
    ids = F.array(*[F.lit(cid).cast(T.LongType()) for cid, _, _ in ordered])
    pos = F.array_position(F.array(*ds), F.least(*ds)).cast(T.IntegerType())
    return F.element_at(ids, pos)


def hash_to_range(lo: Column | int, hi: Column | int, *parts) -> Column:
    """Deterministic integer in ``[lo, hi]`` from the md5 of ``parts`` joined by ':'.

    The first 8 hex digits of the digest (32 bits) reduced modulo the range
    width; the same value in any engine that has md5.
    """
    lo_c = lo if isinstance(lo, Column) else F.lit(int(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(int(hi))
    text = F.concat_ws(":", *[p.cast(T.StringType()) if isinstance(p, Column) else F.lit(str(p))
                              for p in parts])
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast(T.LongType())
    return lo_c.cast(T.LongType()) + F.pmod(h, hi_c.cast(T.LongType()) - lo_c.cast(T.LongType()) + 1)


def whole_days_between(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour days from ``start`` to ``end`` (not calendar boundaries)."""
    return F.timestamp_diff("DAY", _col(start), _col(end))


def typed_like(value, dtype: T.DataType) -> Column:
    """A literal (or Column) cast to the type of the column it is compared with."""
    c = value if isinstance(value, Column) else F.lit(value)
    return c.cast(dtype)
