"""Every query with SQL against DuckDB on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["feature", "mi", "binned"]
