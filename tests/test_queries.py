"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare, oracle
from tests.conftest import SF
from tidemark.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


#: These pick a few rows, of which the smallest tables have none.
PICKED = {"filter_in_list", "filter_between", "point_lookup", "catalog_scan", "delete_candidates"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PICKED))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) is None


@pytest.mark.parametrize("name", sorted(PICKED))
def test_query_that_picks_rows(spark, name):
    larger = SF.replace("sf0.001", "sf0.01")
    assert compare(spark, oracle(larger), larger, name) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "n"] and df.count() > 0
