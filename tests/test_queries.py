"""Every registered query against its SQL on the smallest data set; queries without SQL must return rows."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, connection, name):
    problem, _, _ = compare(spark, connection, SMALL, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None, problem


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["label", "metric", "value"] and frame.count() > 0
