"""Every named query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from check_oracle import compare, connect
from stockpond.catalog import ORACLES, QUERIES

# 54 fits; tools/check_oracle.py runs it.
SLOW = {"grid_search"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_sql(spark, sf_dir, duck, name):
    ok, message = compare(spark, duck, sf_dir, name)
    assert ok, message


def test_entry(spark):
    assert entry_points.entry(spark).count() == 6


def test_sql_belongs_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) == set(ORACLES)
