"""Silver dimensions, declared as data-only specs rather than one script each.

Standard rules applied by ``build_dim``: drop rows with a NULL key, trim
text columns, default a NULL LastProcessedChange_DateTime to 1900-01-01,
convert UTC instants to local time, add the load timestamp and the xxhash64
key of the record id.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.conform import (NULL_TS_DEFAULT, OPEN_END_DEFAULT, audit_ts,
                                        date_key, hash_key, to_local, trimmed, ts_default)
from starloom.operators.range_join import interval_join
from starloom.operators.surrogate import incremental_keys

_OPS = {
    "id": lambda c: F.col(c),
    "trim": trimmed,
    "local": to_local,
    "default": ts_default,
}


@dataclass(frozen=True)
class DimSpec:
    """name: silver table; source: bronze table; key: NULL filter column;
    columns: (output, op, source column) with op in id/trim/local/default;
    record_id: output column holding the record id; hash_col: its hash;
    optional: source columns an entity may lack, with the type of the NULLs
    that stand in for them."""
    name: str
    source: str
    key: str
    columns: tuple[tuple[str, str, str], ...]
    record_id: str
    hash_col: str
    extra: tuple = field(default=())
    optional: dict = field(default_factory=dict)


def _std() -> tuple:
    return (("LastProcessedChange_DateTime", "default", "LastProcessedChange_DateTime"),
            ("DataLakeModified_DateTime", "local", "DataLakeModified_DateTime"))


SPECS: dict[str, DimSpec] = {s.name: s for s in (
    DimSpec("dimcostcenter", "costcenter", "RecordId", (
        ("CostCenterNumber", "trim", "CostCenterNumber"), *_std(),
        ("Vat", "id", "Vat"), ("CostCenterRecordId", "id", "RecordId")),
        "CostCenterRecordId", "CostCenterHashKey"),
    DimSpec("dimcurrency", "currency", "CurrencyId", (
        ("CurrencyId", "id", "CurrencyId"), ("CurrencyCode", "trim", "Code"), *_std(),
        ("Country", "trim", "Country"), ("CurrencyName", "trim", "CurrencyName"),
        ("CurrencyRecordId", "id", "RecordId")),
        "CurrencyRecordId", "CurrencyHashKey"),
    DimSpec("dimcusttable", "custtable", "RecordId", (
        ("CustomerId", "id", "CustomerId"), *_std(),
        ("CustomerName", "trim", "CustomerName"), ("Email", "trim", "Email"),
        ("Phone", "trim", "Phone"), ("Address", "trim", "Address"), ("City", "trim", "City"),
        ("State", "trim", "State"), ("Country", "trim", "Country"),
        ("ZipCode", "trim", "ZipCode"), ("Region", "trim", "Region"),
        ("SignupDate", "local", "SignupDate"), ("CustRecordId", "id", "RecordId")),
        "CustRecordId", "CustHashKey", optional={"ZipCode": "string"}),
    DimSpec("dimpromotable", "promotable", "RecordId", (
        ("PromotionId", "id", "PromotionId"), *_std(),
        ("PromotionName", "trim", "PromotionName"), ("PromoCode", "trim", "PromoCode"),
        ("PromoType", "trim", "PromoType"), ("PromoPercentage", "id", "PromoPercentage"),
        ("ValidFrom", "local", "ValidFrom"), ("ValidTo", "local", "ValidTo"),
        ("IsActive", "id", "IsActive"), ("PromoRecordId", "id", "RecordId")),
        "PromoRecordId", "PromoHashKey"),
    DimSpec("dimpurchasecategory", "purchcategory", "RecordId", (
        ("CategoryId", "id", "CategoryId"), ("CategoryName", "trim", "CategoryName"), *_std(),
        ("CategoryGroupId", "id", "CategoryGroupId"),
        ("PurchCategoryRecordId", "id", "RecordId")),
        "PurchCategoryRecordId", "PurchCategoryHashKey"),
    DimSpec("dimpurchitem", "purchitem", "RecordId", (
        ("ItemId", "id", "ItemId"), ("ProductName", "trim", "Txt"), *_std(),
        ("ValidFrom", "local", "ValidFrom"), ("ValidTo", "local", "ValidTo"),
        ("ProductPerUnitCost", "id", "Price"), ("PurchItemRecordId", "id", "RecordId"),
        ("CategoryID", "id", "CategoryID")),
        "PurchItemRecordId", "PurchItemHashKey"),
    DimSpec("dimvendor", "vendtable", "VendId", (
        ("VendorId", "id", "VendId"), ("VendorName", "trim", "VendorName"),
        ("vendTableLastProcessedChange_DateTime", "default", "LastProcessedChange_DateTime"),
        ("DataLakeModified_DateTime", "local", "DataLakeModified_DateTime"),
        ("Address", "trim", "Address"), ("City", "trim", "City"), ("State", "trim", "State"),
        ("Country", "trim", "Country"), ("ZipCode", "trim", "ZipCode"),
        ("Region", "trim", "Region"), ("ValidFrom", "local", "ValidFrom"),
        ("ValidTo", "local", "ValidTo"), ("Active", "id", "Active"),
        ("VendorRecordId", "id", "RecordId"), ("TaxId", "trim", "TaxId"),
        ("CurrencyCode", "trim", "CurrencyCode")),
        "VendorRecordId", "VendorHashKey", extra=("vendor_discount",)),
)}

# Column renames of the source's own outputs, for callers that need them.
LEGACY_NAMES = {"dimcusttable": {"CustHashKey": "PartyHashKey"},
                "dimpromotable": {"PromoHashKey": "PartyHashKey"}}

# Fixed value: vendors whose trimmed country is exactly 'US' get 1% discount.
VENDOR_DISCOUNT_COUNTRY = "US"
VENDOR_DISCOUNT = 0.01


def vendor_discount(country: Column) -> Column:
    return F.when(country == VENDOR_DISCOUNT_COUNTRY, F.lit(VENDOR_DISCOUNT)).otherwise(F.lit(0.0))


def _expr(op: str, src: str, df: DataFrame, optional: dict) -> Column:
    """The rule over ``src``, whose name is matched without regard to case;
    a missing column must be declared optional."""
    found = [c for c in df.columns if c.lower() == src.lower()]
    if len(found) == 1:
        return _OPS[op](found[0])
    if found:
        raise ValueError(f"columns {found} differ only in case")
    if src not in optional:
        raise ValueError(f"the source lacks the column {src}; it has {df.columns}")
    return F.lit(None).cast(optional[src])


def build_dim(spec: DimSpec, src: DataFrame, as_of: _dt.datetime | None = None,
              legacy_names: bool = False, audit: bool = True) -> DataFrame:
    """``spec`` over its source; column names are matched without regard to case."""
    df = src.filter(_expr("id", spec.key, src, {}).isNotNull())
    out = df.select(*[_expr(op, s, df, spec.optional).alias(o) for o, op, s in spec.columns])
    if audit:
        out = out.withColumn("UpdatedDateTime", audit_ts(as_of))
    out = out.withColumn(spec.hash_col, hash_key(spec.record_id))
    if "vendor_discount" in spec.extra:
        out = out.withColumn("VendorDiscount", vendor_discount(F.col("Country")))
    if legacy_names:
        for a, b in LEGACY_NAMES.get(spec.name, {}).items():
            out = out.withColumnRenamed(a, b)
    return out


def dim_party(parties: DataFrame, partyaddress: DataFrame, as_of: _dt.datetime | None = None,
              open_end: bool = False, audit: bool = True) -> DataFrame:
    """Party with its addresses (left join; a party with two addresses gives
    two rows, one with none keeps NULL address columns)."""
    p = parties.filter(F.col("RecordId").isNotNull()).alias("p")
    a = partyaddress.alias("a")
    j = p.join(a, F.col("p.PartyId") == F.col("a.PartyNumber"), "left")
    end_default = OPEN_END_DEFAULT if open_end else NULL_TS_DEFAULT
    out = j.select(
        F.col("p.PartyId").alias("PartyId"),
        trimmed("p.PartyName").alias("PartyName"),
        ts_default("p.LastProcessedChange_DateTime").alias("PartiesLastProcessedChange_DateTime"),
        to_local("p.DataLakeModified_DateTime").alias("PartiesDataLakeModified_DateTime"),
        F.col("p.PartyAddressCode").alias("PartyAddressCode"),
        to_local("p.EstablishedDate").alias("EstablishedDate"),
        trimmed("p.PartyEmailId").alias("PartyEmailId"),
        trimmed("p.PartyContactNumber").alias("PartyContactNumber"),
        F.col("p.RecordId").alias("PartyRecordId"),
        trimmed("p.TaxId").alias("TaxId"),
        F.col("a.PartyNumber").alias("PartyNumber"),
        ts_default("a.LastProcessedChange_DateTime").alias("PartyAddressLastProcessedChange_DateTime"),
        to_local("a.DataLakeModified_DateTime").alias("PartyAddressDataLakeModified_DateTime"),
        trimmed("a.Address").alias("Address"), trimmed("a.City").alias("City"),
        trimmed("a.State").alias("State"), trimmed("a.Country").alias("Country"),
        trimmed("a.ZipCode").alias("ZipCode"), trimmed("a.Region").alias("Region"),
        to_local("a.ValidFrom").alias("ValidFrom"),
        ts_default("a.ValidTo", end_default).alias("ValidTo"),
        F.col("a.RecordId").alias("PartyAddressRecordId"),
    )
    if audit:
        out = out.withColumn("UpdatedDateTime", audit_ts(as_of))
    return out.withColumn("PartyHashKey", hash_key("PartyRecordId"))


def dim_worker(workers: DataFrame, dimvertical: DataFrame, as_of: _dt.datetime | None = None,
               audit: bool = True) -> DataFrame:
    """Workers with the surrogate id of their (trimmed) vertical."""
    w = workers.filter(F.col("RecordId").isNotNull())
    v = dimvertical.select(F.col("Vertical").alias("__v"), F.col("VerticalId").alias("__vid"))
    j = w.join(v, F.trim(F.col("Vertical")) == F.col("__v"), "left")
    out = j.select(
        "WorkerID",
        ts_default("LastProcessedChange_DateTime").alias("LastProcessedChange_DateTime"),
        to_local("DataLakeModified_DateTime").alias("DataLakeModified_DateTime"),
        "SupervisorId",
        trimmed("WorkerName").alias("WorkerName"), trimmed("WorkerEmail").alias("WorkerEmail"),
        trimmed("Phone").alias("Phone"),
        to_local("DOJ").alias("DOJ"), to_local("DOL").alias("DOL"),
        F.col("__vid").alias("VerticalId"), "Type", "PayPerAnnum", "Rate",
        F.col("RecordId").alias("WorkerRecordId"),
    )
    if audit:
        out = out.withColumn("UpdatedDateTime", audit_ts(as_of))
    return out.withColumn("WorkerHashKey", hash_key("WorkerRecordId"))


def new_payment_types(salesorderline: DataFrame, existing: DataFrame,
                      keep_null: bool = False) -> DataFrame:
    """Rows to append to dimpaymenttypes (PaymentTypeId INT, PaymentTypeDesc)."""
    return incremental_keys(salesorderline, existing, "PaymentTypeDesc", "PaymentTypeId",
                            keep_null=keep_null, id_type="int")


def new_verticals(workers: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows to insert into dimvertical (VerticalId BIGINT, Vertical): trimmed,
    NULL excluded, ids continue after the largest existing id."""
    return incremental_keys(workers, existing, "Vertical", "VerticalId", trim=True,
                            id_type="long")


FISCAL_COLUMNS = ("FiscalStartDate", "FiscalEndDate", "FiscalMonth", "FiscalYearStart",
                  "FiscalYearEnd", "FiscalQuarter", "FiscalQuarterStart", "FiscalQuarterEnd")


def dim_date(cal: DataFrame, fiscalperiod: DataFrame, as_of: _dt.datetime | None = None,
             audit: bool = True) -> DataFrame:
    """Calendar days with calendar attributes and the fiscal period they fall
    in (left range join; days in no period keep NULL fiscal columns)."""
    fp = fiscalperiod.filter(F.col("RecordId").isNotNull()).select(
        "FiscalPeriodName", *FISCAL_COLUMNS, F.col("FiscalYear").alias("__fy"))
    j = interval_join(cal, fp, "Date", "FiscalStartDate", "FiscalEndDate", how="left")
    d = F.col("Date")
    out = j.select(
        "Date",
        date_key(d).alias("DateId"),
        F.year(d).alias("Year"), F.month(d).alias("Month"),
        F.date_format(d, "MMM").alias("MonthName"),
        F.dayofmonth(d).alias("Day"),
        F.date_format(d, "E").alias("DayName"),
        F.quarter(d).alias("Quarter"),
        "FiscalPeriodName", *FISCAL_COLUMNS,
        F.concat(F.lit("FY"), F.col("__fy")).alias("FiscalYear"),
    )
    if audit:
        out = out.withColumn("UpdatedDateTime", audit_ts(as_of))
    return out.withColumn("DateKey", hash_key("DateId"))
