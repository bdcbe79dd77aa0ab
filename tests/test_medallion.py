"""End to end on the ERP fixture: ingest -> bronze -> silver, plus the
source's manual scenarios (PayPal payment type, Data & AI vertical)."""

import datetime as dt
import os

import pytest

from erp_fixtures import write_tree
from starloom.plans.bronze import BRONZE_SPECS, load_bronze
from starloom.plans.silver import run_payment_types, run_silver, run_verticals
from starloom.sources.catalog import Catalog
from starloom.sources.cdm import ingest

AS_OF = dt.datetime(2025, 1, 1, 0, 0)


@pytest.fixture(scope="module")
def medallion(spark, scratch):
    base = os.path.join(scratch, "erp")
    raw = os.path.join(scratch, "raw")
    write_tree(base)
    report = ingest(spark, base, raw).collect()
    cat = Catalog(spark)
    bronze = load_bronze(spark, cat, raw).collect()
    status = run_silver(cat, as_of=AS_OF)
    return cat, report, bronze, status


def test_ingest_report(medallion):
    _, report, _, _ = medallion
    assert len(report) == 15 and all(r.status == "loaded" for r in report)
    assert {r.entity: r.rows for r in report}["SalesOrderLine"] == 7
    assert all(r.bad_rows == 0 for r in report)


def test_bronze_reconciled(medallion):
    _, _, bronze, _ = medallion
    assert len(bronze) == len(BRONZE_SPECS) and all(r.passed for r in bronze)


def test_silver_tables(medallion):
    cat, _, _, status = medallion
    expected = {"dimcostcenter", "dimcurrency", "dimcusttable", "dimpromotable", "dimpurchasecategory",
                "dimpurchitem", "dimvendor", "dimparty", "dimdate", "dimvertical", "dimworker",
                "dimpaymenttypes", "factpurchaseorder", "factsalesorderline"}
    assert expected <= set(status) and expected <= set(cat.list_tables("silver"))


def test_vendor_discount(medallion):
    cat = medallion[0]
    d = {r.VendorId: r.VendorDiscount for r in cat.read("silver", "dimvendor").collect()}
    assert d == {"V1": 0.01, "V2": 0.01, "V3": 0.0, "V4": 0.0}


def test_party_fan_out(medallion):
    cat = medallion[0]
    rows = cat.read("silver", "dimparty").collect()
    by = {}
    for r in rows:
        by.setdefault(r.PartyId, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"P0": 1, "P1": 1, "P2": 2}
    assert by["P0"][0].Address is None and by["P0"][0].ValidTo == dt.datetime(1900, 1, 1)
    assert by["P0"][0].PartyName == "None"


def test_dim_date_range_join(medallion):
    cat = medallion[0]
    d = cat.read("silver", "dimdate")
    assert d.select("Date").distinct().count() == 3287
    assert d.count() == 3287 + 11  # 2024-04-20..30 fall in two overlapping periods
    mar = d.filter("DateId = 20240315").first()
    assert mar.FiscalYear is None and mar.FiscalPeriodName is None
    jan31 = d.filter("DateId = 20240131").first()
    assert jan31.FiscalPeriodName == "P1" and jan31.FiscalYear == "FY2024"
    assert jan31.MonthName == "Jan" and jan31.DayName == "Wed" and jan31.Quarter == 1


def test_worker_vertical_trimmed_join(medallion):
    cat = medallion[0]
    v = {r.Vertical: r.VerticalId for r in cat.read("silver", "dimvertical").collect()}
    assert v == {"Data & AI": 1, "Sales": 2}
    w = {r.WorkerID: r.VerticalId for r in cat.read("silver", "dimworker").collect()}
    assert w == {"W1": 2, "W2": 2, "W3": 1, "W4": None}


def test_purchase_fact(medallion):
    cat = medallion[0]
    f = {r.LineItem: r for r in cat.read("silver", "factpurchaseorder").collect()}
    assert sorted(f) == [1, 2, 3]
    assert f[1].TotalAmount == 120.0 and f[1].VatRate == 0.2 and f[1].CurrencyKey == 1
    assert f[2].TotalAmount == 110.0 and f[2].CurrencyKey == 2
    assert f[3].TotalAmount is None and f[3].CurrencyKey is None
    # local date is the previous evening, the key stays on the UTC date
    assert f[1].OrderDate == dt.datetime(2024, 1, 31, 20, 0) and f[1].OrderDateKey == 20240201
    assert f[1].UpdatedDateTime == AS_OF


def test_sales_fact(medallion):
    cat = medallion[0]
    rows = cat.read("silver", "factsalesorderline").collect()
    promos = {}
    for r in rows:
        promos.setdefault(r.SalesOrderLine, set()).add(r.PromotionId)
    assert promos == {1: {1, 2, 5}, 2: {2, 5}, 3: {1}, 4: {4}, 5: {3}, 6: {None}, 7: {None}}
    l3 = [r for r in rows if r.SalesOrderLine == 3][0]
    assert (l3.TotalAmount, l3.TotalAmountWithDiscount, l3.VatAmount, l3.TotalOrderAmount) == (
        150.0, 135.0, 27.0, 162.0)
    cur = {r.SalesOrderLine: r.CurrencyId for r in rows}
    assert cur[4] == 2 and cur[3] == 1  # bronze code ' USD ' matches once trimmed
    from starloom.plans.facts import sales_fact
    parity = sales_fact(cat.read("bronze", "salesorderline"), cat.read("bronze", "currency"),
                        cat.read("silver", "dimpaymenttypes"), cat.read("bronze", "promotable"),
                        trim_currency=False, local_keys=True)
    pc = {r.SalesOrderLine: (r.CurrencyId, r.BookDateKey) for r in parity.collect()}
    assert pc[3][0] is None and pc[4][0] == 2  # untrimmed: the padded code never matches
    assert pc[1][1] == 20240108  # local key: 2024-01-09 00:00 UTC is the 8th in Chicago
    pay = {r.SalesOrderLine: r.PaymentTypeId for r in rows}
    assert pay[1] == 1 and pay[2] == 2 and pay[5] == 3 and pay[6] is None


def test_paypal_incremental_scenario(medallion):
    cat = medallion[0]
    before = {r.PaymentTypeDesc: r.PaymentTypeId for r in cat.read("silver", "dimpaymenttypes").collect()}
    assert before == {"Card": 1, "Cash": 2, "Wire": 3}
    assert run_payment_types(cat) == 0
    cat.insert_values("bronze", "salesorderline", ["PaymentTypeDesc"], [("PayPal",)])
    assert run_payment_types(cat) == 1
    after = {r.PaymentTypeDesc: r.PaymentTypeId for r in cat.read("silver", "dimpaymenttypes").collect()}
    assert after == {**before, "PayPal": 4}
    assert run_payment_types(cat) == 0


def test_vertical_survives_source_delete(medallion):
    cat = medallion[0]
    cat.insert_values("bronze", "workertable", ["Vertical"], [("Ops",)])
    assert run_verticals(cat) == 1
    cat.delete_where("bronze", "workertable", "Vertical = 'Ops'")
    assert run_verticals(cat) == 0
    v = {r.Vertical: r.VerticalId for r in cat.read("silver", "dimvertical").collect()}
    assert v["Ops"] == 3 and cat.read("bronze", "workertable").filter("Vertical = 'Ops'").count() == 0


def test_gold_marts(medallion):
    from starloom.plans.gold import build_gold
    cat = medallion[0]
    assert build_gold(cat) == {"sales_by_fiscal_period": "overwritten", "purchases_by_vendor_country": "overwritten"}
    g = cat.read("gold", "sales_by_fiscal_period").collect()
    total = [r for r in g if r.grouping_level == 3][0]
    fact = cat.read("silver", "factsalesorderline")
    assert total.line_count == fact.count()
    by_year = {r.FiscalYear: r.line_count for r in g if r.grouping_level == 1}
    # January and NULL-date lines: P1 covers January 2024; March has no period
    assert by_year["FY2024"] == 5 and by_year[None] == 5
    v = {(r.Country, r.VendorDiscount): r for r in cat.read("gold", "purchases_by_vendor_country").collect()}
    assert v[("US", 0.01)].line_count == 3 and v[("US", 0.01)].spend == 300.0


def test_dimension_details(medallion, spark):
    from starloom.plans.dims import SPECS, build_dim
    cat = medallion[0]
    cc = {r.CostCenterNumber: r for r in cat.read("silver", "dimcostcenter").collect()}
    assert set(cc) == {"CC1", "CC2"}  # trimmed; the NULL-record row is dropped
    assert cc["CC2"].LastProcessedChange_DateTime == dt.datetime(1900, 1, 1)
    assert cc["CC1"].DataLakeModified_DateTime == dt.datetime(2024, 1, 15, 6, 0)  # January: UTC-6
    cur = {r.CurrencyId: r for r in cat.read("silver", "dimcurrency").collect()}
    assert set(cur) == {1, 2} and cur[1].CurrencyCode == "USD" and cur[2].CurrencyName == "Euro"
    cust = cat.read("silver", "dimcusttable")
    assert "CustHashKey" in cust.columns and "PartyHashKey" not in cust.columns
    c1 = cust.filter("CustomerId = 'C1'").first()
    assert c1.ZipCode is None and c1.CustomerName == "Ann" and c1.SignupDate == dt.datetime(2024, 1, 31, 20, 0)
    assert cust.filter("CustomerId = 'C2'").count() == 0  # NULL record id
    legacy = build_dim(SPECS["dimcusttable"], cat.read("bronze", "custtable"), legacy_names=True)
    assert "PartyHashKey" in legacy.columns
    item = cat.read("silver", "dimpurchitem").first()
    assert item.ProductName == "Hammer" and item.ProductPerUnitCost == 9.5
    promo = {r.PromotionId: r for r in cat.read("silver", "dimpromotable").collect()}
    assert promo[1].ValidFrom == dt.datetime(2023, 12, 31, 18, 0) and promo[5].IsActive is False
    hk = spark.createDataFrame([(201,)], "r bigint").selectExpr("xxhash64(r) as h").first().h
    assert promo[1].PromoHashKey == hk
