"""Registered k-means queries (Q14–Q22) and the CSV round trip (Q21), bound to
the driver's tables: points from ``lineitem``, the ten fixed start centers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration import schemas
from murmuration.operators import clustering as km
from murmuration.operators import vectors
from murmuration.session import drop_path, scratch_path
from murmuration.sources import bindings as b
from murmuration.sources.csv import csv_table, write_csv
from murmuration.sources.lenient import casualties, lenient_table

POINT_KEYS = ("l_orderkey", "l_linenumber")


def q14(spark: SparkSession, sf: str) -> DataFrame:
    return km.kmeans_step(b.points(spark, sf), b.start_centers(), rounding="half_up")


def _q15_result(spark: SparkSession, sf: str) -> km.KMeansResult:
    return km.kmeans_fixed(b.points(spark, sf), b.start_centers(), r=6, rounding="trunc")


def q15(spark: SparkSession, sf: str) -> DataFrame:
    res = _q15_result(spark, sf)
    res.release()
    return km.with_run_flags(res)


def _q16_result(spark: SparkSession, sf: str) -> km.KMeansResult:
    return km.kmeans_converged(b.points(spark, sf), b.start_centers(), r_max=20,
                               tolerance=50.0, check=True, rounding="half_up")


def q15_check(spark: SparkSession, sf: str) -> DataFrame:
    """The truncating loop with its early stop."""
    res = km.kmeans_fixed(b.points(spark, sf), b.start_centers(), r=20, rounding="trunc",
                          check=True, tolerance=50.0)
    res.release()
    return km.with_run_flags(res)


def q16(spark: SparkSession, sf: str) -> DataFrame:
    res = _q16_result(spark, sf)
    res.release()
    return km.with_run_flags(res)


def q17(spark: SparkSession, sf: str) -> DataFrame:
    res = _q16_result(spark, sf)
    res.release()
    return km.kmeans_assign(b.points(spark, sf), res, keep=POINT_KEYS)


def q18(spark: SparkSession, sf: str) -> DataFrame:
    return km.kmeans_seeds_sample(b.points(spark, sf), k=10, seed=42)


def q19(spark: SparkSession, sf: str) -> DataFrame:
    return km.kmeans_seeds_uniform(b.points(spark, sf), k=10, seed=42)


def q20(spark: SparkSession, sf: str) -> DataFrame:
    return km.kmeans_sweep(b.points(spark, sf))


def q21(spark: SparkSession, sf: str) -> DataFrame:
    """people written as headed CSV to the shared scratch folder, read back."""
    path = scratch_path(spark, "people-csv")
    write_csv(b.people(spark, sf), path, mode="errorifexists")
    return csv_table(spark, path, schemas.PEOPLE_SCHEMA)


def q21_access(spark: SparkSession, sf: str) -> DataFrame:
    """The access log, tab-separated, written over an existing output; the
    microseconds of its times come back."""
    path = scratch_path(spark, "access-tsv")
    log = b.access(spark, sf)
    for _ in range(2):
        write_csv(log, path, mode="overwrite", sep="\t", header=False)
    return csv_table(spark, path, log.schema, sep="\t", header=False)


LENIENT_SCHEMA = T.StructType([
    T.StructField("person_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("nation", T.IntegerType()), T.StructField("balance", T.DoubleType()),
    T.StructField("since", T.TimestampNTZType()), T.StructField("segment", T.StringType())])


def _damaged_lines(spark: SparkSession, sf: str) -> str:
    """Customers as text lines, some with a bad number or date, a field too few
    or one too many; the folder they are written to."""
    c, k = b.table(spark, sf, "customer"), F.col("c_custkey")
    key = F.when(k % 7 == 0, F.concat(F.lit("n"), k.cast("string"))).otherwise(k.cast("string"))
    nation = F.when(k % 11 == 0, "").otherwise(F.col("c_nationkey").cast("string"))
    day = F.when(k % 9 == 0, "soon").otherwise(F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"),
                                                       F.lit(" 08:00:00")))
    line = F.concat_ws(",", key, F.concat(F.lit(" "), "c_name"), nation, F.col("c_acctbal").cast("string"), day)
    line = F.when(k % 5 == 0, line).otherwise(F.concat(line, F.lit(","), "c_mktsegment"))
    line = F.when(k % 13 == 0, F.concat(line, F.lit(",over,more"))).otherwise(line)
    path = scratch_path(spark, "damaged")
    c.select(line.alias("value")).write.text(path)
    return path


def q21_lenient(spark: SparkSession, sf: str) -> DataFrame:
    return lenient_table(spark, _damaged_lines(spark, sf), LENIENT_SCHEMA)


def q21_casualties(spark: SparkSession, sf: str) -> DataFrame:
    return casualties(spark, _damaged_lines(spark, sf), LENIENT_SCHEMA)


def q21_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Names with padding, quotes, delimiters, line breaks, empty and null, as
    written."""
    k = F.col("person_id")
    name = (F.when(k % 7 == 0, None).when(k % 7 == 1, "").when(k % 7 == 2, F.concat(F.lit("  "), "name", F.lit("\t ")))
            .when(k % 7 == 3, F.concat(F.lit('"a", "'), "name")).when(k % 7 == 4, F.concat("name", F.lit("\nnext,line\n")))
            .when(k % 7 == 5, F.concat("name", F.lit("\\"))).otherwise(F.col("name")))
    rows = b.people(spark, sf).select("person_id", name.alias("name"), "hobby")
    path = scratch_path(spark, "texts")
    write_csv(rows, path, rows_per_file=1_000_000)
    return csv_table(spark, path, rows.schema, trim=False, line_breaks=True)


def q14_many(spark: SparkSession, sf: str) -> DataFrame:
    """One pass of 5,000 centers, found through the index over centers."""
    pts = b.points(spark, sf)
    seeds = km.collect_centers(km.kmeans_seeds_sample(pts, k=5000, seed=42))
    return km.kmeans_step(pts, seeds, rounding="half_up", argmin="indexed")


def q16_fractional(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity and price as they are, exact sums of doubles."""
    res = vectors.vector_kmeans(b.real_points(spark, sf), b.real_start_centers(), r_max=20,
                                tolerance=50.0)
    rows = [(c, *v, res.sizes[c], res.moved[c], res.converged, res.passes) for c, v in res.centers]
    out = spark.createDataFrame(rows, "center_id long, x double, y double, n long, moved double, "
                                      "converged boolean, passes long")
    return out.withColumns({c: F.round(c, 6) for c in ("x", "y", "moved")})


def q17_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding with its center after four passes from eight seeds."""
    pts = b.embedding_points(spark, sf)
    res = vectors.vector_kmeans(pts, vectors.vector_seeds(pts, 8, "vec_id"), r_max=4,
                                tolerance=0.0, check=False)
    return vectors.vector_assign(pts, res.centers_in, keep=["vec_id"])


def q16_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """Q16's run in two parts: the second goes on from the first one's passes."""
    pts, log = b.points(spark, sf), scratch_path(spark, "passes")
    for r_max in (6, 20):
        res = km.kmeans_converged(pts, b.start_centers(), r_max=r_max, tolerance=50.0, log_path=log)
        res.release()
    drop_path(spark, log)
    return km.with_run_flags(res)


CENTERS_OUT_SCHEMA = T.StructType([
    T.StructField("center_id", T.LongType()), T.StructField("x", T.LongType()),
    T.StructField("y", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("moved", T.DoubleType()), T.StructField("converged", T.BooleanType()),
    T.StructField("passes", T.LongType())])

CLUSTERED_OUT_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("x", T.LongType()), T.StructField("y", T.LongType()),
    T.StructField("center_id", T.LongType()), T.StructField("center_x", T.LongType()),
    T.StructField("center_y", T.LongType())])


def q22(spark: SparkSession, sf: str) -> DataFrame:
    """The two named outputs of the Q16 run, read back and tagged."""
    pts = b.points(spark, sf)
    res = _q16_result(spark, sf)
    try:
        cdir, pdir = km.kmeans_outputs(res, pts, scratch_path(spark, "kmeans-out"),
                                       keep=POINT_KEYS, mode="errorifexists")
    finally:
        res.release()
    # One schema for both outputs, without nulls: a center row is its own
    # point (weight n, the cluster size); a clustered row weighs 1.  Both
    # carry the run's converged flag.
    centers = csv_table(spark, cdir, CENTERS_OUT_SCHEMA).select(
        F.lit("centers").alias("output"), "center_id", "x", "y",
        F.col("x").alias("center_x"), F.col("y").alias("center_y"), "n", "converged")
    clustered = csv_table(spark, pdir, CLUSTERED_OUT_SCHEMA).select(
        F.lit("clustered").alias("output"), "center_id", "x", "y", "center_x", "center_y",
        F.lit(1).cast(T.LongType()).alias("n"), F.lit(res.converged).alias("converged"))
    return centers.unionByName(clustered)


def q22_one_job(spark: SparkSession, sf: str) -> DataFrame:
    """The same outputs from one scan of the points, read back."""
    res, path = _q16_result(spark, sf), scratch_path(spark, "kmeans-tagged")
    res.release()
    km.write_tagged_outputs(res, b.points(spark, sf), path)
    return spark.read.parquet(path)


KMEANS_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q14_kmeans_step": q14,
    "q14_kmeans_step_5000": q14_many,
    "q15_kmeans_fixed": q15,
    "q15_kmeans_fixed_check": q15_check,
    "q16_kmeans_converged": q16,
    "q16_kmeans_fractional": q16_fractional,
    "q16_kmeans_resumed": q16_resumed,
    "q17_kmeans_assign": q17,
    "q17_kmeans_embeddings": q17_embeddings,
    "q18_kmeans_seeds_sample": q18,
    "q19_kmeans_seeds_uniform": q19,
    "q20_kmeans_sweep": q20,
    "q21_csv_roundtrip": q21,
    "q21_access_tsv": q21_access,
    "q21_lenient_load": q21_lenient,
    "q21_lenient_casualties": q21_casualties,
    "q21_texts_roundtrip": q21_texts,
    "q22_kmeans_outputs": q22,
    "q22_kmeans_outputs_one_job": q22_one_job,
}
