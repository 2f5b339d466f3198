"""Headed, comma-separated text tables (source and sink, SURVEY Q21).

Files are read under their own header names (``enforceSchema=False`` makes a
header that does not match an error instead of a silent misread), then renamed
to the library's column names.  Nothing is inferred.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration import schemas

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"  # the fraction may be missing on reading
DATE_FORMAT = "yyyy-MM-dd"
#: Quotes inside quotes are doubled; null has a mark of its own, so an empty text is not null.
#: (A text that is the mark itself comes back as null.)
NULL_MARK = "\\N"
_QUOTING = {"quote": '"', "escape": '"', "nullValue": NULL_MARK, "lineSep": "\n"}
_MODES = {"FAILFAST", "PERMISSIVE", "DROPMALFORMED"}


def csv_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
              file_columns: Sequence[str] | None = None, mode: str = "FAILFAST",
              sep: str = ",", header: bool = True,
              corrupt_column: str | None = None, trim: bool = True,
              line_breaks: bool = False) -> DataFrame:
    """Read a delimited text table with a fixed schema.

    ``trim`` takes white space around fields away (quoted or not); without it
    every text comes back as ``write_csv`` was given it.  ``line_breaks`` reads
    quoted fields over several lines, which makes a file one task's work.  An
    empty field is null, a quoted empty one an empty text.

    ``file_columns`` are the names in the files' header row (defaults to the
    schema's own names).  ``mode`` is Spark's parse mode: ``FAILFAST`` stops on
    a malformed row, ``DROPMALFORMED`` skips it (the reference's short-row
    guard), ``PERMISSIVE`` keeps it with nulls — and, with
    ``corrupt_column``, the raw text of the bad line in that extra column.
    (As everywhere in Spark, a bare ``count()`` parses no column and so sees
    no malformed row.)
    """
    mode = mode.upper()
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {sorted(_MODES)}")
    names = list(file_columns) if file_columns else schema.fieldNames()
    if len(names) != len(schema.fields):
        raise ValueError("file_columns and schema differ in width")
    read_schema = T.StructType([T.StructField(n, f.dataType, True)
                                for n, f in zip(names, schema.fields)])
    out_names = schema.fieldNames()
    reader = spark.read
    if corrupt_column:
        if mode != "PERMISSIVE":
            raise ValueError("corrupt_column needs mode='PERMISSIVE'")
        read_schema = read_schema.add(T.StructField(corrupt_column, T.StringType(), True))
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        out_names = out_names + [corrupt_column]
    df = (reader.schema(read_schema)
          .option("header", header)
          .option("enforceSchema", not header)
          .option("sep", sep)
          .option("mode", mode)
          .option("timestampFormat", TIMESTAMP_FORMAT)
          .option("timestampNTZFormat", TIMESTAMP_FORMAT)
          .option("dateFormat", DATE_FORMAT)
          .option("ignoreLeadingWhiteSpace", trim)
          .option("ignoreTrailingWhiteSpace", trim)
          .option("multiLine", line_breaks)
          .options(**_QUOTING)
          .csv(list(path) if not isinstance(path, str) else path))
    return df.toDF(*out_names)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", sep: str = ",",
              header: bool = True, rows_per_file: int = 0) -> None:
    """Write ``df`` as delimited text part files.

    Texts keep their padding; those with the delimiter, a quote or a line break
    are quoted (files with line breaks are read with ``line_breaks``; then
    ``rows_per_file`` bounds what one task reads).

    ``mode="overwrite"`` replaces an existing output (delete-if-exists);
    the default refuses to touch one.  Timestamps are written with their
    microseconds.
    """
    (df.write.mode(mode)
     .option("header", header)
     .option("sep", sep)
     .option("timestampFormat", TIMESTAMP_FORMAT)
     .option("timestampNTZFormat", TIMESTAMP_FORMAT)
     .option("dateFormat", DATE_FORMAT)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .option("emptyValue", '""')
     .option("maxRecordsPerFile", rows_per_file)
     .options(**_QUOTING)
     .csv(path))


def read_people(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return csv_table(spark, path, schemas.PEOPLE_SCHEMA, schemas.PEOPLE_FILE_COLUMNS, mode)


def read_friends(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return csv_table(spark, path, schemas.FRIENDS_SCHEMA, schemas.FRIENDS_FILE_COLUMNS, mode)


def read_access(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return csv_table(spark, path, schemas.ACCESS_SCHEMA, schemas.ACCESS_FILE_COLUMNS, mode)


def read_points(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return csv_table(spark, path, schemas.POINTS_SCHEMA, schemas.POINTS_FILE_COLUMNS, mode)


def read_centers(spark: SparkSession, path: str, k: int | None = None) -> list[tuple[int, int, int]]:
    """Centers file, one ``x,y`` per line (optionally followed by `` Old:x0,y0``
    as written after a pass).  Returns ``[(center_id, x, y)]`` with ids in line
    order; fractions are rounded half up.

    A first line without a number is a header; any other line that is not two
    numbers is an error.  The list is brought to the driver because centers are
    its working set; ``k``, the caller's own number of centers, is checked.
    """
    lines = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("pos"),
        F.trim(F.split(F.col("value"), "Old:").getItem(0)).alias("head")).filter("head <> ''")
    coords = lines.select(
        "pos", "head", F.size(F.split("head", ",")).alias("parts"),
        F.trim(F.split("head", ",").getItem(0)).try_cast("double").alias("x"),
        F.trim(F.get(F.split("head", ","), F.lit(1))).try_cast("double").alias("y"))
    rows = coords.orderBy("pos")
    if k is not None:  # one line more than asked for, and a header, show the excess
        rows = rows.limit(k + 2)
    rows = rows.collect()
    if rows and rows[0]["x"] is None and rows[0]["y"] is None:
        rows = rows[1:]
    for r in rows:
        if r["x"] is None or r["y"] is None or r["parts"] != 2:
            raise ValueError(f"not a center: {r['head']!r} in {path}")
    if k is not None and len(rows) != k:
        raise ValueError(f"{path} does not hold {k} centers")
    return [(i, math.floor(r["x"] + 0.5), math.floor(r["y"] + 0.5)) for i, r in enumerate(rows)]
