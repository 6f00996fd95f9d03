"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import compare

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, name):
    assert compare(spark, SF_DIR, name, contract.queries()[name], SQL.get(name)) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["page_id", "url", "text", "error"] and df.count() == 50
