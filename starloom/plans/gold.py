"""Gold marts over the silver star schema (facts joined to dimensions by key).

Facts are first aggregated to the grain of the dimension key they join on,
so the join and the final grouping see one row per key instead of one per
fact line; money is summed as DECIMAL(38,10) for order-independent totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.deltas import DeltaMart
from starloom.sources.catalog import Catalog


def _dec(c: str) -> F.Column:
    return F.col(c).cast("decimal(38,10)")


def sales_by_fiscal_period(fact_sales: DataFrame, dimdate: DataFrame) -> DataFrame:
    """Sales by fiscal year and quarter, with year subtotals and the total
    (ROLLUP). Lines whose book date has no fiscal period fall in NULL."""
    per_day = (fact_sales.groupBy("BookDateKey")
               .agg(F.count(F.lit(1)).alias("lines"), F.sum("Qty").alias("qty"),
                    F.sum(_dec("TotalOrderAmount")).alias("amount"),
                    F.count("PromotionId").alias("promoted")))
    d = dimdate.select(F.col("DateId"), "FiscalYear", "FiscalQuarter")
    j = per_day.join(d, F.col("BookDateKey") == F.col("DateId"), "left")
    return (j.rollup("FiscalYear", "FiscalQuarter")
             .agg(F.sum("lines").alias("line_count"), F.sum("qty").alias("total_qty"),
                  F.sum("amount").cast("double").alias("net_sales"),
                  F.sum("promoted").alias("promoted_lines"),
                  F.grouping_id().alias("grouping_level")))


def purchases_by_vendor_country(fact_purchase: DataFrame, dimvendor: DataFrame) -> DataFrame:
    """Purchase lines, spend and discount-eligible spend by vendor country."""
    per_vendor = (fact_purchase.groupBy("VendorKey")
                  .agg(F.count(F.lit(1)).alias("lines"), F.sum(_dec("TotalOrder")).alias("spend"),
                       F.sum(_dec("TotalAmount")).alias("spend_with_vat")))
    v = dimvendor.select("VendorId", "Country", "VendorDiscount")
    j = per_vendor.join(v, F.col("VendorKey") == F.col("VendorId"), "left")
    return (j.groupBy("Country", "VendorDiscount")
             .agg(F.countDistinct("VendorKey").alias("vendors"), F.sum("lines").alias("line_count"),
                  F.sum("spend").cast("double").alias("spend"),
                  F.sum("spend_with_vat").cast("double").alias("spend_with_vat"),
                  (F.sum("spend").cast("double") * F.col("VendorDiscount")).alias("discount_value")))


def refresh_mart(cat: Catalog, mart: DeltaMart, name: str, base: DataFrame, changes: DataFrame, gold: str = "gold") -> str:
    """Folds change rows (see ``deltas.between``) into ``gold.name``, which is built from ``base`` if it is not there.

    ``base`` holds the rows after the changes; of it, only the groups that lost
    their minimum or maximum are read. Returns what was done.
    """
    cat.ensure_schema(gold)
    if not cat.exists(gold, name):
        cat.overwrite(mart.build(base), gold, name)
        return "built"
    cat.overwrite(mart.apply(cat.read(gold, name), changes, base), gold, name, allow_schema_change=True)
    return "refreshed"


def build_gold(cat: Catalog, silver: str = "silver", gold: str = "gold") -> dict[str, str]:
    """Materialise the marts from silver tables; returns mart -> status.

    A mart that fails, or whose tables are missing, is named in the result
    and does not stop the others.
    """
    have = set(cat.list_tables(silver)) if cat.schema_exists(silver) else set()
    out: dict[str, str] = {}
    for mart, fact, dim, build in (
            ("sales_by_fiscal_period", "factsalesorderline", "dimdate", sales_by_fiscal_period),
            ("purchases_by_vendor_country", "factpurchaseorder", "dimvendor", purchases_by_vendor_country)):
        if missing := {fact, dim} - have:
            out[mart] = f"skipped: {silver} lacks {', '.join(sorted(missing))}"
            continue
        try:
            cat.overwrite(build(cat.read(silver, fact), cat.read(silver, dim)), gold, mart)
            out[mart] = "overwritten"
        except Exception as e:  # noqa: BLE001 - reported per mart
            out[mart] = f"failed: {type(e).__name__}: {e}"
    return out
