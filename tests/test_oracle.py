"""Every registered query against its DuckDB oracle on the smallest tables,
and the driver contract of __spark_entry__."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_harness import compare, duck

from starloom.plans.queries import QUERIES
from starloom.plans.upkeep import QUERIES as UPKEEP

# the library's own queries: the training-data operators have tests of their own
NAMES = sorted([*QUERIES, *UPKEEP])


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert {*QUERIES, *UPKEEP} <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, E.queries()[name], E.oracle_sql()[name], SF_SMALL, con)
    assert r["cols_equal"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_equal"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "PurchaseOrderHashKey" in df.columns
