"""Every registered query against its SQL on the smallest tables, and the driver contract."""

import pytest

import __spark_entry__ as contract
from compare import differences, duck, duck_side, spark_side
from conftest import DATA
from tidemark.catalog import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    got = spark_side(contract.queries()[name](spark, DATA))
    assert not differences(got, duck_side(con, contract.oracle_sql()[name]))


def test_entry_runs(spark):
    assert contract.entry(spark).columns[:3] == ["region", "month_bucket", "category"]


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())
