"""Every query of the catalogue against DuckDB, whole tables."""

import pytest

import __spark_entry__ as contract
import compare
from plumbline.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, SF), duck, SQL[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
