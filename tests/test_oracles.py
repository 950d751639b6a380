"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in os.listdir(small):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{small}/{file}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(float(value))
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    ours = rows(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    theirs = rows([d[0] for d in result.description], result.fetchall())
    assert ours == theirs


# The slowest one has a test of its own.
UNCHECKED = sorted(set(QUERIES) - set(ORACLES) - {"cross_validate"})


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_without_sql_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_flagship(spark):
    assert 0 < entry_points.entry(spark).count() <= 10


def test_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
