"""Every registered query against plain SQL in another engine."""

import math

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as driver
from kerbside.plans.expected_sql import all_expected_sql
from kerbside.plans.registry import all_queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
QUERIES = all_queries()
EXPECTED = all_expected_sql()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    return con


def normal(row):
    return tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row)


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(driver.queries()) and set(EXPECTED) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, engine, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = engine.execute(EXPECTED[name])
    given = [d[0] for d in result.description]
    assert sorted(given) == columns
    positions = [given.index(c) for c in columns]
    expected = sorted((normal(tuple(r[i] for i in positions)) for r in result.fetchall()), key=str)
    assert sorted((normal(tuple(r)) for r in df.select(columns).collect()), key=str) == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
