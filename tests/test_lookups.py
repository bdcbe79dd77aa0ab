"""Lookups in small dimensions drawn from large tables leave the lines where they are read."""

import datetime as dt

import pytest

from starloom.plans import queries

DAY = dt.datetime(1996, 3, 1)


@pytest.fixture(scope="module")
def sf_dir(spark, scratch):
    path = f"{scratch}/lookups"
    n = 20_000
    (spark.range(n).selectExpr("id as o_orderkey", "xxhash64(id) % 1000000 as o_custkey", f"timestamp_ntz'{DAY}' as o_orderdate", "concat(id % 5 + 1, '-P') as o_orderpriority")
     .coalesce(1).write.parquet(f"{path}/orders.parquet"))
    (spark.range(40).selectExpr("id as s_suppkey", "cast(id % 25 as int) as s_nationkey").coalesce(1).write.parquet(f"{path}/supplier.parquet"))
    (spark.range(2 * n).selectExpr("id div 2 as l_orderkey", "id % 7 as l_partkey", "id % 40 as l_suppkey", "cast(id % 2 + 1 as int) as l_linenumber",
                                   "cast(id % 9 + 1 as double) as l_quantity", "cast(id as double) as l_extendedprice", "0.1D as l_tax", "'N' as l_returnflag",
                                   "'O' as l_linestatus", f"timestamp_ntz'{DAY}' as l_shipdate").coalesce(1).write.parquet(f"{path}/lineitem.parquet"))
    return path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "joins"), [("q_purchase_fact", 0), ("q_sales_fact", 1)])
def test_only_a_join_with_a_large_table_shuffles_the_lines(spark, sf_dir, name, joins):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16000")  # far less than the orders take, far more than a dimension
        out = getattr(queries, name)(spark, sf_dir)
        assert _plan(out).count("SortMergeJoin") == joins  # the sales lines are joined with their orders
        key = "CurrencyKey" if name == "q_purchase_fact" else "CurrencyId"
        assert out.count() == 40_000 and out.where(f"{key} is not null").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
