"""Every registered query against its DuckDB oracle on sf0.001 (whole tables)."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as entry
from murmuration.oracle import all_sql
from murmuration.queries import all_queries

from conftest import sf_dir

duckdb = pytest.importorskip("duckdb")

QUERIES, SQL = all_queries(), all_sql()
NAMES = sorted(SQL)


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NA:
            return None
    except ImportError:  # pragma: no cover
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(v) for v in rec)
                         for rec in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    sf = sf_dir("0.001")
    c = duckdb.connect()
    for f in os.listdir(sf):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


def test_entry_holds_the_core_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sf = sf_dir("0.001")
    got = QUERIES[name](spark, sf).toPandas()
    exp = con.execute(SQL[name]).df()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "page_id" in df.columns


_DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string",
                  "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
                  "DATE": "date"}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, con, name):
    sf = sf_dir("0.001")
    sdf = QUERIES[name](spark, sf)
    got = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    rel = con.sql(SQL[name])
    exp = {c: _DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert got == exp
