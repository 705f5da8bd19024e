"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from compare import oracle_rows, spark_rows
from stratum.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not here")


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["order_day", "region", "total_revenue", "total_units"]
    assert rows.count() > 0


@pytest.mark.parametrize("query", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, query):
    got = spark_rows(QUERIES[query](spark, SF_DIR))
    want = oracle_rows(SF_DIR, ORACLES[query])
    assert got == want
    assert sum(got[1].values()) > 0
