"""Counters read beside a job: counts of a table taken while the job that uses it runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation

from murmuration.session import scratch_path


def written_with_counts(df: DataFrame, counts: dict[str, Column],
                        job: Callable[[DataFrame], DataFrame],
                        name: str = "counted") -> tuple[DataFrame, dict[str, object]]:
    """Run ``job`` over ``df`` into a table of the shared folder, counting rows of
    ``df`` on the way; the table read back, and the counts.

    The counts are metrics of the running query, so ``df`` is scanned once.  They
    are those of the tasks whose output was kept; a map stage that is run again
    after a lost executor counts its rows again, which a caller that needs exact
    counts on an unstable cluster must know.
    """
    seen = Observation(name)
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = job(df.observe(seen, *[c.alias(k) for k, c in counts.items()]))
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path), seen.get
