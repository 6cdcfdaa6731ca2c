"""Every registered query against its SQL counterpart, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect, spark_rows, sql_rows

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


def test_every_query_has_sql():
    from vendorium.plans.registry import all_queries

    assert set(all_queries()) <= set(SQL) <= set(QUERIES)


def test_entry_returns_rows(spark, sf_dir):
    assert entry_points.entry(spark).count() == 5


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, database, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = sql_rows(database, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected
