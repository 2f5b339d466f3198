"""murmuration: social-network and integer k-means analytics as Spark jobs.

Every operator is a plain function from DataFrames to a DataFrame, built from
Spark's own DataFrame / SQL operators, so Catalyst prunes, pushes down and
plans the shuffles; the one Python UDF of the core is the Arrow-batched
nearest-center argmin of ``functions.vectorized``.
"""

from murmuration.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
