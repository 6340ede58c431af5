"""Every query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from tests.oracle import duck, problem

DATA = "/root/testdata/sf0.001"
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def connection():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    assert problem(QUERIES[name](spark, DATA), connection, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
