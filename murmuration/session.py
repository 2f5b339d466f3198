"""Session construction and the shared scratch folder.

Library functions never build a session themselves; they take the DataFrames
they are given.  ``build_session`` is for tests, the bench and scripts.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library is written for.  Shuffle partitions are a
# starting point only: AQE coalesces small partitions and splits skewed ones at
# run time, so the same code serves local[8] and a 1000-executor cluster.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_SCRATCH: set[str] = set()  # folders handed out and not deleted yet


def build_session(master: str | None = None, app_name: str = "murmuration",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is set.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system that outlives executors).  Only when the session names none, as in
    local tests, a fresh folder under the system temp directory is used.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a shared folder (HDFS, "
                "object store) that every executor can reach")
        # local mode only (tests, laptops): a temp folder on this machine
        configured = tempfile.mkdtemp(prefix="murmuration-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Used for the outputs that operators write and read back (CSV sink, named
    k-means outputs); never a machine-local folder on a cluster.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/murmuration-{name}-{uuid.uuid4().hex}"
    _SCRATCH.add(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder this process handed out: results that read
    them are lazy, so their owner says when they are done with."""
    for path in sorted(_SCRATCH):
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever Spark's file systems hold it."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(jsc.hadoopConfiguration()).delete(target, True)
    _SCRATCH.discard(path)
