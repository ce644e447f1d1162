"""Every registered query against its SQL, on the smallest tables."""

import pytest
from checking import connect, difference

import __spark_entry__ as entry_points
from chronicle.plans import oracles, registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert registry.queries().keys() == oracles.oracle_sql().keys()


def test_entry_points_list_every_query():
    """Queries of an optional folder may come on top; no SQL is without its query."""
    assert registry.queries().items() <= entry_points.queries().items()
    assert oracles.oracle_sql().items() <= entry_points.oracle_sql().items()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, con, name):
    df = registry.queries()[name](spark, SF_DIR)
    assert difference(df, con, oracles.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
