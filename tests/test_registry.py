"""Every registered query against its reference SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


def test_every_reference_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["category", "term", "chi2", "rank"] and rows.count() > 0


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    sql = entry_points.oracle_sql().get(name)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, rows) == _rows(columns, expected)
