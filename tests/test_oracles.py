"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    same, (sc, sk), (oc, ok) = compare(spark, con, name, SF)
    assert sc == oc
    assert len(sk) == len(ok)
    assert sk == ok


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 16 * 8
    assert "scope" in df.columns
