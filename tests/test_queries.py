"""Every query with SQL against it, on the given tables. Text queries have their own tests."""

import pytest

import __spark_entry__ as entry
from catalog.queries import QUERIES
from compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, oracle, name):
    assert difference(entry.queries()[name](spark, SF), oracle, entry.oracle_sql()[name]) is None
