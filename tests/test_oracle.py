"""Every registered query runs; those with SQL agree with DuckDB on rows, names, types and values."""

import pytest

import __spark_entry__ as spark_entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, db, name):
    assert compare(spark_entry.queries()[name](spark, FOLDER), db, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(spark_entry.queries()) - set(SQL)))
def test_runs(spark, name):
    assert spark_entry.queries()[name](spark, FOLDER).collect()


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
