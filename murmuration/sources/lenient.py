"""Schema-on-read load of delimited text: a row is never refused.

A line is split at the delimiter and each field cast to its declared type; a
field that does not cast is null, missing trailing fields are null, further ones
are dropped.  ``casualties`` counts what was lost, field by field, in the same
way.  No quoting: a delimiter always ends a field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.functions import trimmed
from murmuration.sources.csv import DATE_FORMAT, TIMESTAMP_FORMAT


def _cast(field: Column, kind: T.DataType, trim: bool) -> Column:
    if isinstance(kind, T.StringType):
        return trimmed(field) if trim else field
    field = trimmed(field)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.try_to_timestamp(field, F.lit(TIMESTAMP_FORMAT)).cast(kind)
    if isinstance(kind, T.DateType):
        return F.try_to_timestamp(field, F.lit(DATE_FORMAT)).cast(kind)
    return field.try_cast(kind)


def _lines(spark: SparkSession, path: str | Sequence[str], sep: str,
           header: str | None) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths).select(F.regexp_replace("value", "\r$", "").alias("line"))
    if header is not None:
        lines = lines.filter(F.col("line") != header)
    return lines.select(F.split("line", "\\Q" + sep + "\\E", -1).alias("f"))


def lenient_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                  sep: str = ",", header: bool = False, trim: bool = False) -> DataFrame:
    """Every line as a row of ``schema``; text fields as they are unless ``trim``.

    ``header``: lines equal to the schema's names joined by ``sep`` are no rows.
    """
    names = sep.join(schema.fieldNames()) if header else None
    lines = _lines(spark, path, sep, names)
    return lines.select(*[_cast(F.get("f", F.lit(i)), f.dataType, trim).alias(f.name)
                          for i, f in enumerate(schema.fields)])


def casualties(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
               sep: str = ",", header: bool = False) -> DataFrame:
    """(field, n_missing, n_uncast) for each field in order, and a last row
    ``<extra>`` whose n_missing counts lines with more fields than declared.

    One pass with a partial aggregate; an empty field is not a failed cast.
    """
    names = sep.join(schema.fieldNames()) if header else None
    lines = _lines(spark, path, sep, names)
    width = len(schema.fields)
    counts = []
    for i, f in enumerate(schema.fields):
        field = F.get("f", F.lit(i))
        lost = field.isNotNull() & (trimmed(field) != "") & _cast(field, f.dataType, False).isNull()
        counts.append(F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("field"),
            F.count_if(field.isNull()).alias("n_missing"), F.count_if(lost).alias("n_uncast")))
    counts.append(F.struct(
        F.lit(width).alias("position"), F.lit("<extra>").alias("field"),
        F.count_if(F.size("f") > width).alias("n_missing"), F.lit(0).cast("long").alias("n_uncast")))
    return lines.agg(F.array(*counts).alias("c")).select(F.inline("c")).orderBy("position").select(
        "field", "n_missing", "n_uncast")
