"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from acceptance import registry
from oracle import compare, connect

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


def test_each_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


def test_the_entry_registers_all_of_them():
    assert QUERIES.items() <= entry.queries().items()
    assert SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
