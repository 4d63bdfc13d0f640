from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tests.oracle import connect, differences

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, database, name):
    assert differences(QUERIES[name](spark, sf_dir), database, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
