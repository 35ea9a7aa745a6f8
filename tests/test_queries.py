import os

import pytest

import __spark_entry__ as driver
from compare import difference, duck
from courtside.workload.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are absent")
# A month or day with repeats need not occur in the smallest tables.
MAY_BE_EMPTY = {"cardinality_report", "duplicate_days", "duplicate_examples"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    found = difference(spark, con, SF_DIR, QUERIES[name], ORACLES[name])
    assert not found or (found == "no rows" and name in MAY_BE_EMPTY), found


@needs_tables
def test_entry(spark):
    assert driver.entry(spark).count() > 0
