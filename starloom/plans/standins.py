"""ERP-shaped bronze frames derived from the driver's TPC-H-like tables.

The reference reads ERP exports that are not shipped. To exercise every
operator on the given tables (whose work grows with them), each bronze
entity is expressed as a projection of a driver table:

  purchase line  = lineitem joined to its supplier (for the cost centre)
  sales line     = lineitem joined to its order (book date, payment type)
  cost centre    = supplier nations    currency = customer codes in orders
  promotion      = (year, priority) pairs in orders
  fiscal period  = months present in orders
  vendor         = supplier        customer      = customer
  worker         = customer (market segment as the vertical)

Every builder has a SQL twin in ``SQL`` that DuckDB runs for the oracle.
Derivations are attribute rules only; no rows are dropped or sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.conditional_join import VOLUME_BANDS
from starloom.plans.tables import Tables


def _ntz(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _days(n: int | str):
    return F.expr(f"make_dt_interval({n}, 0, 0, 0)")


def _code(c) -> F.Column:
    """'C' + two-digit number: the currency code rule."""
    return F.concat(F.lit("C"), F.lpad(c.cast("string"), 2, "0"))


def costcenter(t: Tables) -> DataFrame:
    """One cost centre per supplier nation (a distinct over suppliers)."""
    k = F.col("s_nationkey")
    return t.supplier.select(k).distinct().select(
        F.concat(F.lit("NATION_"), k.cast("string")).alias("CostCenterNumber"),
        F.when(F.pmod(k, F.lit(5)) == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_ntz("2024-03-10 06:30:00") + F.expr("make_dt_interval(0, s_nationkey, 0, 0)"))
         .alias("LastProcessedChange_DateTime"),
        (_ntz("2024-01-01 02:00:00") + F.expr("make_dt_interval(s_nationkey * 15, 0, 0, 0)"))
        .alias("DataLakeModified_DateTime"),
        (F.pmod(k, F.lit(5)).cast("double") / 20).alias("Vat"),
        k.cast("long").alias("RecordId"),
    )


def currency(t: Tables) -> DataFrame:
    """One currency per customer currency code used by orders (a distinct
    over orders); codes 20 and above arrive space-padded."""
    c = t.orders.select(F.pmod(F.col("o_custkey"), F.lit(25)).cast("int").alias("cc")).distinct()
    k = F.col("cc")
    code = _code(k)
    return c.select(
        k.alias("CurrencyId"),
        F.when(k >= 20, F.concat(F.lit(" "), code, F.lit(" "))).otherwise(code).alias("Code"),
        F.when(F.pmod(k, F.lit(5)) == 1, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_ntz("2024-07-01 12:00:00")).alias("LastProcessedChange_DateTime"),
        (_ntz("2024-11-03 05:00:00") + F.expr("make_dt_interval(0, cc, 0, 0)"))
        .alias("DataLakeModified_DateTime"),
        F.concat(F.lit(" NATION_"), k.cast("string")).alias("Country"),
        F.concat(F.lit("Currency of NATION_"), k.cast("string"), F.lit(" ")).alias("CurrencyName"),
        (k + 1000).cast("long").alias("RecordId"),
    )


def purchcategory(t: Tables) -> DataFrame:
    """A category for each part brand, grouped by the brand's first digit."""
    c = t.part.select("p_brand").where("p_brand is not null").distinct()
    n = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    return c.select(
        n.alias("CategoryId"),
        F.concat(F.lit("  "), F.col("p_brand"), F.lit(" ")).alias("CategoryName"),
        F.when(F.pmod(n, F.lit(3)) == 0, F.lit(None).cast("timestamp_ntz")).otherwise(_ntz("2024-07-01 12:00:00"))
         .alias("LastProcessedChange_DateTime"),
        _ntz("2024-11-03 05:00:00").alias("DataLakeModified_DateTime"),
        F.floor(n / 10).cast("int").alias("CategoryGroupId"),
        # the last category of each group has no record id and is left out
        F.when(F.pmod(n, F.lit(10)) != 5, (n + 500).cast("long")).alias("RecordId"),
    )


def purchitem(t: Tables) -> DataFrame:
    """An item for each part."""
    k = F.col("p_partkey")
    return t.part.select(
        k.alias("ItemId"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")).alias("Txt"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.lit(None).cast("timestamp_ntz")).otherwise(_ntz("2024-01-15 00:30:00"))
         .alias("LastProcessedChange_DateTime"),
        _ntz("2024-03-10 09:00:00").alias("DataLakeModified_DateTime"),
        _ntz("2020-01-01 00:00:00").alias("ValidFrom"),
        F.when(F.pmod(k, F.lit(7)) != 0, _ntz("2030-07-01 00:00:00")).alias("ValidTo"),
        F.col("p_retailprice").alias("Price"),
        F.when(F.pmod(k, F.lit(11)) != 0, k * 10).alias("RecordId"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("CategoryID"),
    )


def purchaseorder(t: Tables) -> DataFrame:
    sup = t.supplier.select("s_suppkey", "s_nationkey")
    li = t.lineitem.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
    ship = F.col("l_shipdate")
    return li.select(
        F.col("l_orderkey").alias("PoNumber"),
        F.col("l_linenumber").alias("LineItem"),
        F.col("l_suppkey").alias("VendId"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("timestamp_ntz")).otherwise(ship)
         .alias("LastProcessedChange_DateTime"),
        (ship + F.expr("make_dt_interval(0, 2, 0, 0)")).alias("DataLakeModified_DateTime"),
        F.col("l_quantity").alias("Qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("PurchasePrice"),
        F.col("l_extendedprice").alias("TotalOrder"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("CostCenter"),
        _code(F.col("s_nationkey")).alias("CurrencyCode"),
        (F.lit(1.0) + F.col("s_nationkey").cast("double") / 100).alias("ExchangeRate"),
        F.col("l_partkey").alias("Itemkey"),
        (ship - _days(10)).alias("OrderDate"),
        ship.alias("ShipDate"),
        (ship + _days(3)).alias("DeliveredDate"),
        F.concat(F.lit("TRK"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("TrackingNumber"),
        F.col("l_returnflag").alias("Batchid"),
        F.col("l_linestatus").alias("CreatedBy"),
        F.col("s_nationkey").alias("CategoryId"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("RecordId"),
    )


def salesorderline(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    li = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    ship = F.col("l_shipdate")
    return li.select(
        F.col("l_orderkey").alias("SalesOrderNumber"),
        F.col("l_linenumber").alias("SalesOrderLine"),
        F.when(F.col("l_linenumber") == 2, F.lit(None).cast("timestamp_ntz")).otherwise(ship)
         .alias("LastProcessedChange_DateTime"),
        (F.col("o_orderdate") + _days(1)).alias("DataLakeModified_DateTime"),
        F.col("l_partkey").alias("ItemId"),
        F.col("l_quantity").alias("Qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("Price"),
        F.col("l_tax").alias("VatPercentage"),
        _code(F.pmod(F.col("o_custkey"), F.lit(25))).alias("CurrencyCode"),
        F.col("o_orderdate").alias("BookDate"),
        ship.alias("ShippedDate"),
        (ship + _days(3)).alias("DeliveredDate"),
        F.concat(F.lit("TRK"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("TrackingNumber"),
        F.col("o_custkey").alias("CustId"),
        F.col("o_orderpriority").alias("PaymentTypeDesc"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("RecordId"),
    )


def payment_sources(t: Tables) -> DataFrame:
    """Payment type of every sales header (the member source of dimpaymenttypes)."""
    return t.orders.select(F.col("o_orderpriority").alias("PaymentTypeDesc"))


FIRST_PROMO_YEAR = 1995  # volume-band promotions run in the first order year


def promotable(t: Tables) -> DataFrame:
    """One promotion per (order year, priority digit) found in orders. In the
    first year priorities 1-4 carry the four volume bands; the others are
    seasonal. Windows are 8 days in January starting on day 5 x priority,
    so neighbouring priorities overlap; (1996, 5) has no end and (1997, 5)
    ends before it starts."""
    o = t.orders.select(F.year("o_orderdate").alias("y"),
                        F.substring("o_orderpriority", 1, 1).cast("int").alias("p")).distinct()
    y, p = F.col("y"), F.col("p")
    name = None
    for i, band in enumerate(VOLUME_BANDS, start=1):
        c = (y == FIRST_PROMO_YEAR) & (p == i)
        name = F.when(c, F.lit(band[0])) if name is None else name.when(c, F.lit(band[0]))
    name = name.otherwise(F.concat(F.lit("Seasonal Promotion "), y.cast("string"), F.lit("-"),
                                   p.cast("string")))
    pid = y * 10 + p
    vf = F.make_date(y, F.lit(1), p * 5).cast("timestamp_ntz")
    vt = (F.when((y == 1996) & (p == 5), F.lit(None).cast("timestamp_ntz"))
           .when((y == 1997) & (p == 5), vf - _days(3))
           .otherwise(vf + _days(8)))
    return o.select(
        pid.alias("PromotionId"),
        F.lit(None).cast("timestamp_ntz").alias("LastProcessedChange_DateTime"),
        (_ntz("2024-01-31 20:00:00") + F.expr("make_dt_interval(0, p, 0, 0)"))
        .alias("DataLakeModified_DateTime"),
        name.alias("PromotionName"),
        F.concat(F.lit(" P"), pid.cast("string"), F.lit(" ")).alias("PromoCode"),
        F.when(name.startswith("Volume"), F.lit("Volume")).otherwise(F.lit("Seasonal")).alias("PromoType"),
        ((p + (y - FIRST_PROMO_YEAR) * 5).cast("double") / 100).alias("PromoPercentage"),
        vf.alias("ValidFrom"),
        vt.alias("ValidTo"),
        (p != 5).alias("IsActive"),
        (pid + 500).cast("long").alias("RecordId"),
    )


def fiscalperiod(t: Tables) -> DataFrame:
    """One fiscal month per calendar month present in orders; the fiscal year
    starts on 1 July and is named after the calendar year it ends in."""
    m = t.orders.select(F.trunc(F.to_date("o_orderdate"), "MM").alias("m")).distinct()
    mon = F.month("m")
    fy = (F.year("m") + F.when(mon >= 7, 1).otherwise(0)).cast("int")
    fm = F.when(mon >= 7, mon - 6).otherwise(mon + 6).cast("int")
    fq = (F.floor((fm - 1) / 3) + 1).cast("int")
    fys = F.make_date(fy - 1, F.lit(7), F.lit(1))
    fqs = F.add_months(fys, (fq - 1) * 3)
    return m.select(
        (F.year("m") * 100 + mon).cast("long").alias("RecordId"),
        F.concat(F.lit("FP"), F.date_format("m", "yyyyMM")).alias("FiscalPeriodName"),
        F.col("m").alias("FiscalStartDate"),
        F.last_day("m").alias("FiscalEndDate"),
        fm.alias("FiscalMonth"),
        fys.alias("FiscalYearStart"),
        F.make_date(fy, F.lit(6), F.lit(30)).alias("FiscalYearEnd"),
        fq.alias("FiscalQuarter"),
        fqs.alias("FiscalQuarterStart"),
        F.last_day(F.add_months(fqs, 2)).alias("FiscalQuarterEnd"),
        fy.alias("FiscalYear"),
    )


def vendtable(t: Tables) -> DataFrame:
    s = t.supplier
    nk = F.col("s_nationkey")
    country = (F.when(nk == 0, F.lit("US")).when(nk == 1, F.lit(" US "))
               .when(nk == 2, F.lit("USA")).when(nk == 3, F.lit(None).cast("string"))
               .otherwise(F.concat(F.lit("NATION_"), nk.cast("string"))))
    return s.select(
        F.col("s_suppkey").alias("VendId"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("VendorName"),
        F.lit(None).cast("timestamp_ntz").alias("LastProcessedChange_DateTime"),
        _ntz("2024-01-01 02:00:00").alias("DataLakeModified_DateTime"),
        F.concat(F.lit("Street "), F.col("s_suppkey").cast("string")).alias("Address"),
        F.lit(" City ").alias("City"), F.lit("ST").alias("State"),
        country.alias("Country"),
        F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("ZipCode"),
        F.lit("Region").alias("Region"),
        _ntz("2020-01-01 00:00:00").alias("ValidFrom"),
        F.lit(None).cast("timestamp_ntz").alias("ValidTo"),
        (F.col("s_acctbal") > 0).alias("Active"),
        F.concat(F.lit(" TAX"), F.col("s_suppkey").cast("string")).alias("TaxId"),
        F.concat(F.lit(" "), _code(nk), F.lit(" ")).alias("CurrencyCode"),
        (F.col("s_suppkey") + 100000).alias("RecordId"),
    )


def workertable(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("WorkerID"),
        F.lit(None).cast("timestamp_ntz").alias("LastProcessedChange_DateTime"),
        _ntz("2024-07-15 05:00:00").alias("DataLakeModified_DateTime"),
        F.col("c_nationkey").cast("long").alias("SupervisorId"),
        F.concat(F.lit(" "), F.col("c_name")).alias("WorkerName"),
        F.concat(F.col("c_name"), F.lit("@corp.example ")).alias("WorkerEmail"),
        F.lit(" 555-0100 ").alias("Phone"),
        _ntz("2021-01-01 02:00:00").alias("DOJ"),
        F.lit(None).cast("timestamp_ntz").alias("DOL"),
        F.when(F.col("c_nationkey") < 5, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
         .otherwise(F.col("c_mktsegment")).alias("Vertical"),
        F.lit("FTE").alias("Type"),
        F.col("c_acctbal").alias("PayPerAnnum"),
        (F.col("c_acctbal") / 2080).alias("Rate"),
        F.col("c_custkey").alias("RecordId"),
    )


def payment_terms(t: Tables) -> DataFrame:
    """Payment terms versioned by order year, with the order date, for the
    incremental-key run (first load: orders before 1998, then all orders)."""
    return t.orders.select(
        F.concat(F.col("o_orderpriority"), F.lit(" "), F.year("o_orderdate").cast("string"))
         .alias("PaymentTypeDesc"),
        F.col("o_orderdate"))


def custtable(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("CustomerId"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_ntz("2024-11-03 06:30:00")).alias("LastProcessedChange_DateTime"),
        _ntz("2024-01-01 02:00:00").alias("DataLakeModified_DateTime"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("CustomerName"),
        F.concat(F.lower(F.col("c_name")), F.lit("@mail.example")).alias("Email"),
        F.lit(" 555-0199").alias("Phone"),
        F.concat(F.lit("Road "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("Address"),
        F.lit("Town").alias("City"), F.lit(" TX ").alias("State"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Country"),
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("ZipCode"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("Region"),
        (_ntz("2020-01-01 00:00:00") + F.expr("make_dt_interval(0, 0, 0, c_custkey * 3600)"))
        .alias("SignupDate"),
        F.col("c_custkey").alias("RecordId"),
    )


def parties(t: Tables) -> DataFrame:
    s = t.supplier
    return s.select(
        (F.col("s_suppkey") * 20).alias("PartyId"),
        F.concat(F.lit(" "), F.col("s_name")).alias("PartyName"),
        F.lit(None).cast("timestamp_ntz").alias("LastProcessedChange_DateTime"),
        _ntz("2024-03-10 08:00:00").alias("DataLakeModified_DateTime"),
        F.col("s_nationkey").alias("PartyAddressCode"),
        _ntz("2010-07-01 02:00:00").alias("EstablishedDate"),
        F.concat(F.lit(" party"), F.col("s_suppkey").cast("string"), F.lit("@mail.example")).alias("PartyEmailId"),
        F.lit("555-0000 ").alias("PartyContactNumber"),
        F.concat(F.lit("TX"), F.col("s_suppkey").cast("string")).alias("TaxId"),
        F.col("s_suppkey").alias("RecordId"),
    )


def partyaddress(t: Tables) -> DataFrame:
    """Each customer key is a party number with a main address; customers
    with a large balance add a billing address (two rows)."""
    c = t.customer
    main = c.select(
        F.col("c_custkey").alias("PartyNumber"),
        F.lit(None).cast("timestamp_ntz").alias("LastProcessedChange_DateTime"),
        _ntz("2024-01-01 02:00:00").alias("DataLakeModified_DateTime"),
        F.concat(F.lit(" Main "), F.col("c_custkey").cast("string")).alias("Address"),
        F.lit(" City").alias("City"), F.lit("ST").alias("State"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Country"),
        F.lit("00000").alias("ZipCode"), F.lit("R").alias("Region"),
        _ntz("2019-01-01 00:00:00").alias("ValidFrom"),
        F.lit(None).cast("timestamp_ntz").alias("ValidTo"),
        (F.col("c_custkey") * 2).alias("RecordId"),
    )
    bill = c.filter(F.col("c_acctbal") > 5000).select(
        F.col("c_custkey").alias("PartyNumber"),
        _ntz("2024-07-04 12:00:00").alias("LastProcessedChange_DateTime"),
        _ntz("2024-07-04 12:00:00").alias("DataLakeModified_DateTime"),
        F.concat(F.lit(" Billing "), F.col("c_custkey").cast("string")).alias("Address"),
        F.lit(" City").alias("City"), F.lit("ST").alias("State"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Country"),
        F.lit("11111").alias("ZipCode"), F.lit("R").alias("Region"),
        _ntz("2022-01-01 00:00:00").alias("ValidFrom"),
        _ntz("2030-01-01 00:00:00").alias("ValidTo"),
        (F.col("c_custkey") * 2 + 1).alias("RecordId"),
    )
    return main.unionByName(bill)
