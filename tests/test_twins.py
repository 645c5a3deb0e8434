"""Every keyed query against its SQL twin on the smallest test data."""

import pytest
from twin import connect, differences

import __spark_entry__ as contract
from strata.queries import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, SQL[name]) == []


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 1696
