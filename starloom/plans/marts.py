"""KPI marts on the star schema (revenue, vendor performance, top customers).

Money is summed as DECIMAL so totals do not depend on the order in which
partial sums meet; results are cast to DOUBLE at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _money(c: str) -> F.Column:
    return F.col(c).cast("decimal(15,2)")


def net_revenue() -> F.Column:
    """extendedprice * (1 - discount) in exact decimal arithmetic."""
    return _money("l_extendedprice") * (F.lit(1) - _money("l_discount"))


def order_revenue(lineitem: DataFrame) -> DataFrame:
    """Lines pre-aggregated to one row per order (exact decimal sums). The
    aggregate's shuffle is on the order key, the key of the following join,
    so the join reuses that partitioning instead of shuffling lines."""
    return (lineitem.groupBy("l_orderkey")
                    .agg(F.sum(net_revenue()).alias("rev"), F.count(F.lit(1)).alias("lines")))


def revenue_rollup(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Net revenue and line counts by order year and quarter, with year
    subtotals and the grand total (ROLLUP)."""
    o = orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"),
                      F.quarter("o_orderdate").alias("order_quarter"))
    j = order_revenue(lineitem).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return (j.rollup("order_year", "order_quarter")
             .agg(F.sum("rev").cast("double").alias("net_revenue"),
                  F.sum("lines").alias("line_count"),
                  F.grouping_id().alias("grouping_level")))


def vendor_performance(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Per supplier and ship year: lines, quantity, net revenue, average
    discount and the share of returned lines."""
    # measures first, at (supplier, year) grain: the join then sees one row
    # per supplier-year instead of one per line
    per = (lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("ship_year"))
                   .agg(F.count(F.lit(1)).alias("line_count"),
                        F.sum(F.col("l_quantity").cast("decimal(15,2)")).alias("qty"),
                        F.sum(net_revenue()).alias("rev"),
                        F.sum(_money("l_discount")).alias("disc"),
                        F.count_if(F.col("l_returnflag") == "R").alias("returned")))
    s = supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = nation.select("n_nationkey", "n_name")
    s = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).drop("n_nationkey", "s_nationkey")
    j = per.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.select("s_suppkey", "s_name", "n_name", "ship_year", "line_count",
                    F.col("qty").cast("double").alias("total_qty"),
                    F.col("rev").cast("double").alias("net_revenue"),
                    (F.col("disc").cast("double") / F.col("line_count")).alias("avg_discount"),
                    (F.col("returned").cast("double") / F.col("line_count")).alias("return_rate"))


def top_customers(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                  k: int = 20) -> DataFrame:
    """The k customers with the highest net revenue (a top-k report: the
    limit is the feature). Ties broken by customer key. Spark plans this as
    per-task top-k followed by one merge of k rows per task."""
    o = orders.select("o_orderkey", "o_custkey")
    per_cust = (order_revenue(lineitem).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                  .groupBy("o_custkey").agg(F.sum("rev").alias("rev"),
                                            F.count(F.lit(1)).alias("order_count")))
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    top = per_cust.orderBy(F.col("rev").desc(), F.col("o_custkey").asc()).limit(k)
    return (top.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
               .select(F.col("o_custkey").alias("customer_key"), "c_name", "c_mktsegment",
                       F.col("rev").cast("double").alias("net_revenue"), "order_count"))
