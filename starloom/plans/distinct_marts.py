"""Marts with distinct counts that add up: bitmaps of ids, built once and merged upwards.

count(distinct) cannot be added: a rollup has to go back to the rows for every
level. A bitmap of the ids can: the finest grain holds one bitmap for each
group and range of 32,768 ids, and each coarser level is the OR of the
bitmaps below, whose bits are counted at the end. The rows are read and
shuffled once; the levels work on bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def bitmaps(df: DataFrame, dims: list[str], ident: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """dims, _bucket, _bits and the sums: one row for each group and range of ids.

    ``ident`` holds integers from 0 on. Rows without an id are in the sums, in a
    bucket of their own without bits.
    """
    spread = df.groupBy(*dims, F.bitmap_bucket_number(ident).alias(BUCKET))
    return spread.agg(F.bitmap_construct_agg(F.bitmap_bit_position(ident)).alias(BITS), *[F.sum(c).alias(n) for n, c in (sums or {}).items()])


def merge_bitmaps(maps: DataFrame, dims: list[str], sums: list[str] = ()) -> DataFrame:
    """The bitmaps of coarser groups."""
    return maps.groupBy(*dims, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS), *[F.sum(n).alias(n) for n in sums])


def distinct_counts(maps: DataFrame, dims: list[str], name: str, sums: list[str] = ()) -> DataFrame:
    """dims, ``name`` (distinct ids) and the sums."""
    return maps.groupBy(*dims).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("long").alias(name), *[F.sum(n).alias(n) for n in sums])


def rollup_distinct(maps: DataFrame, levels: list[list[str]], dims: list[str], name: str, sums: list[str] = ()) -> DataFrame:
    """One frame of all levels, coarser dimensions NULL; each level is merged from the one before it.

    levels: lists of dimensions, each a part of the one before.
    """
    out, at = None, maps
    for level in levels:
        at = merge_bitmaps(at, level, sums)
        flag = F.lit(sum(1 << i for i, d in enumerate(reversed(dims)) if d not in level)).alias("grouping_level")
        counted = distinct_counts(at, level, name, sums).select(
            *[F.col(d) if d in level else F.lit(None).cast(maps.schema[d].dataType).alias(d) for d in dims], name, *sums, flag)
        out = counted if out is None else out.unionByName(counted)
    return out


def lines_by_product_and_customer(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Lines with their order's customer and quarter and their part's brand and type."""
    o = orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"), F.quarter("o_orderdate").alias("order_quarter"))
    p = part.select("p_partkey", F.col("p_brand").alias("brand"))
    return (lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
            .select("brand", "order_year", "order_quarter", "o_custkey", "l_quantity", "l_extendedprice", "l_discount"))


def _measures() -> dict[str, Column]:
    money = lambda c: F.col(c).cast("decimal(15,2)")
    return {"line_count": F.lit(1).cast("long"), "qty": money("l_quantity"), "rev": money("l_extendedprice") * (F.lit(1) - money("l_discount"))}


def product_mart(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Buyers, lines, quantity and net revenue by brand, year and quarter, by brand and year, by brand, and in total."""
    dims = ["brand", "order_year", "order_quarter"]
    sums = ["line_count", "qty", "rev"]
    maps = bitmaps(lines_by_product_and_customer(lineitem, orders, part), dims, "o_custkey", _measures())
    out = rollup_distinct(maps, [dims, dims[:2], dims[:1], []], dims, "buyers", sums)
    return out.select(*dims, "buyers", F.col("line_count"), F.col("qty").cast("double").alias("total_qty"),
                      F.col("rev").cast("double").alias("net_revenue"), "grouping_level")


def segment_mart(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Active customers, orders and net revenue by market segment, year and quarter, upwards to the total.

    Orders are summed first, so that the join to the customers sees one row an order.
    """
    money = lambda c: F.col(c).cast("decimal(15,2)")
    rev = lineitem.groupBy("l_orderkey").agg(F.sum(money("l_extendedprice") * (F.lit(1) - money("l_discount"))).alias("rev"))
    o = (orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"), F.quarter("o_orderdate").alias("order_quarter"))
         .join(rev, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    c = customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    dims = ["segment", "order_year", "order_quarter"]
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select(*dims, "o_custkey", "rev")
    maps = bitmaps(j, dims, "o_custkey", {"order_count": F.lit(1).cast("long"), "rev": F.col("rev")})
    out = rollup_distinct(maps, [dims, dims[:2], dims[:1], []], dims, "customers", ["order_count", "rev"])
    return out.select(*dims, "customers", "order_count", F.col("rev").cast("double").alias("net_revenue"), "grouping_level")
