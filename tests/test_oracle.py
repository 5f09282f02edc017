"""Every query that has SQL against it, on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from registry import queries as registry
from tests.check_oracle import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_of_the_registry_has_sql():
    assert set(registry.queries()) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, folder, name):
    problem, _, _ = compare(spark, con, folder, name, QUERIES[name], SQL[name])
    assert problem is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
