"""Every registered query against its SQL twin."""

import pytest
from conftest import SF

import __spark_entry__ as driver
import compare
from tidemark.plans import catalogue

QUERIES = {n: q for n, q in driver.queries().items() if n in catalogue.QUERIES}
SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(catalogue.QUERIES) and set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), con, SQL[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
