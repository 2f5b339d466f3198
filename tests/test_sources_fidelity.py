"""Texts through CSV as they were, lenient loading, ids and times as text."""

from __future__ import annotations

import os

import pytest

from murmuration.operators import social
from murmuration.sources import csv_table, write_csv
from murmuration.sources.lenient import casualties, lenient_table
from pyspark.sql import types as T

TEXTS = ["plain", "", None, "  padded\t", 'q"uo"te', "a,b", "line\nbreak", "cr\r\nlf", "\r", "back\\", '\\"', '"',
         '""', "\\N?", "\n", "ünï 漢", "'", "a,\"b\nc"]


@pytest.mark.parametrize("sep", [",", "\t"])
def test_texts_come_back_as_written(spark, tmp_dir, sep):
    rows = [(i, t, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id long, t string, u string")
    path = os.path.join(tmp_dir, "t")
    write_csv(df, path, sep=sep)
    got = csv_table(spark, path, df.schema, sep=sep, trim=False, line_breaks=True).collect()
    assert sorted(map(tuple, got)) == rows


def test_trimming_is_a_parameter(spark, tmp_dir):
    df = spark.createDataFrame([(1, "  x ")], "id long, t string")
    path = os.path.join(tmp_dir, "t")
    write_csv(df, path)
    assert [csv_table(spark, path, df.schema, trim=t).first()["t"] for t in (True, False)] == ["x", "  x "]


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("day", T.DateType()), T.StructField("x", T.DoubleType())])


def write(folder, lines):
    path = os.path.join(folder, "in.txt")
    with open(path, "w", newline="") as f:
        f.write("".join(line + "\n" for line in lines))
    return path


def test_lenient_load_keeps_every_row(spark, tmp_dir):
    path = write(tmp_dir, ["id|name|day|x", "1| a |2024-01-02|1.5", "x|b|soon|", "3", "4|d|2024-02-30|9|more|yet",
                           "", "99999999999999999999|e| 2024-01-02 |nan\r"])
    got = lenient_table(spark, path, SCHEMA, sep="|", header=True).collect()
    text = [tuple("nan" if v != v else str(v) if v is not None else None for v in r) for r in got]
    assert text == [("1", " a ", "2024-01-02", "1.5"), (None, "b", None, None), ("3", None, None, None),
                    ("4", "d", None, "9.0"), (None, "", None, None)[:1] + (None, None, None),
                    (None, "e", "2024-01-02", "nan")]
    lost = [tuple(r) for r in casualties(spark, path, SCHEMA, sep="|", header=True).collect()]
    assert lost == [("id", 0, 2), ("name", 2, 0), ("day", 2, 2), ("x", 2, 0), ("<extra>", 1, 0)]


def test_lenient_load_of_nothing(spark, tmp_dir):
    path = write(tmp_dir, [])
    assert lenient_table(spark, path, SCHEMA).collect() == []
    assert [r["n_missing"] for r in casualties(spark, path, SCHEMA).collect()] == [0] * 5


def test_failfast_is_kept(spark, tmp_dir):
    path = write(tmp_dir, ["id,name,day,x", "x,b,soon,"])
    with pytest.raises(Exception):
        csv_table(spark, path, SCHEMA).collect()


def test_text_ids_join_on_their_trimmed_form(spark):
    people = spark.createDataFrame([(" 1", "a"), ("2\t", "b"), ("  ", "none")], "person_id string, name string")
    friends = spark.createDataFrame([("1 ", "2"), ("1", "2"), (" ", "1")], "person_id string, friend_id string")
    out = social.friend_counts_outdegree(social.trimmed_ids(people, "person_id"),
                                         social.trimmed_ids(friends, "person_id", "friend_id"))
    got = {r["person_id"]: r["friend_count"] for r in out.collect() if r["person_id"] is not None}
    assert got == {"1": 2, "2": 0}


def test_one_bad_time_is_skipped_or_fails(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "never"), (3, None)], "by_who long, access_time string")
    assert [r["by_who"] for r in social.readable_times(df).collect()] == [1]
    with pytest.raises(Exception, match="not a time: never"):
        social.readable_times(df, strict=True).collect()
    good = df.filter("by_who <> 2")
    assert [r["by_who"] for r in social.readable_times(good, strict=True).collect()] == [1]
