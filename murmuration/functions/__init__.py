"""Column-expression helpers.

``exprs`` holds built-in Spark functions only; ``vectorized`` holds the
Arrow-batched nearest-center argmin, the one Python UDF of the library's core.
"""

from murmuration.functions.exprs import (
    hash_to_range,
    nearest_center,
    norm_text,
    squared_distance,
    trimmed,
    typed_like,
    whole_days_between,
)

__all__ = [
    "hash_to_range", "nearest_center", "norm_text", "squared_distance", "trimmed",
    "typed_like", "whole_days_between",
]
