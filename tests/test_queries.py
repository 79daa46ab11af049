"""Every registered query against its SQL twin on DuckDB, on the smallest given tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registered
from oracle import compare, duck

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


def test_every_query_has_its_sql():
    assert set(registered.lake_queries()) == set(registered.lake_sql())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("key", registered.lake_queries())
def test_query_equals_its_sql(spark, con, key):
    assert compare(spark, con, key, str(DATA)) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0
