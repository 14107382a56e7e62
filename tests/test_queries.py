"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from tagtide.plans.catalog import QUERIES
from tagtide.plans.oracle import ORACLES

NO_SQL = {"cluster_users", "communities"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, con, name):
    assert compare(con, ORACLES[name], QUERIES[name](spark, sf)) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["time", "sentiment_category", "count"]
    assert df.count() > 0
