"""Every registered query beside its SQL, on the smallest data."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference, duck_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()
# Training all models takes a minute; the parts are tested on their own.
SLOW = {"model_comparison", "feature_set_gain"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert difference(spark_rows(QUERIES[name](spark, SF_DIR)), duck_rows(duck, SQL[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 143
