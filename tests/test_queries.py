"""Every registered query against its SQL text."""

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as entry_points
from walkgrid.plans.oracle import ORACLE
from walkgrid.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_a_text():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, con):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
