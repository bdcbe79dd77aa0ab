"""Silver facts: purchase order lines (X1) and sales order lines (X2).

Dimension lookups are left joins without hints: Spark broadcasts a dimension
whose files (when planning) or shuffle output (at run time) are under
``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles on the key
with skewed partitions split. No job runs while a lookup is planned.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.conform import (audit_ts, date_key, hash_key, to_local,
                                        trimmed, ts_default)
from starloom.operators.conditional_join import promotion_join, with_volume_bands


def _key(c: str, local_keys: bool):
    """yyyyMMdd key of the UTC value (source behaviour) or of the local one."""
    return date_key(to_local(c)) if local_keys else date_key(c)


def purchase_fact(po: DataFrame, dimcostcenter: DataFrame, dimcurrency: DataFrame,
                  as_of: _dt.datetime | None = None, trim_keys: bool = True,
                  audit: bool = True, local_keys: bool = False) -> DataFrame:
    """factpurchaseorder.

    ``po`` is bronze purchaseorder; the dimensions are the silver tables.
    TotalAmount = round(TotalOrder + TotalOrder * Vat, 4), NULL when the cost
    centre is unmatched. VatRate is the cost centre's rate; VatAmount is the
    amount it implies. Date keys come from the UTC columns while the stored
    dates are local (source behaviour).
    """
    po = po.filter(F.col("RecordId").isNotNull())
    key = trimmed if trim_keys else (lambda c: F.col(c))
    cc = dimcostcenter.select(key("CostCenterNumber").alias("__cc"), F.col("Vat").alias("__vat"))
    cur = dimcurrency.select(F.col("CurrencyCode").alias("__cur"), F.col("CurrencyId").alias("__curid"))
    j = (po.join(cc, key("CostCenter") == F.col("__cc"), "left")
           .join(cur, key("CurrencyCode") == F.col("__cur"), "left"))
    total = F.col("TotalOrder")
    out = j.select(
        F.col("PoNumber"), F.col("LineItem"), F.col("VendId").alias("VendorKey"),
        ts_default("LastProcessedChange_DateTime").alias("LastProcessedChange_DateTime"),
        to_local("DataLakeModified_DateTime").alias("DataLakeModified_DateTime"),
        F.col("Qty"), F.col("PurchasePrice"), total.alias("TotalOrder"),
        F.col("CostCenter").alias("CostCenterKey"),
        F.col("__vat").alias("VatRate"),
        (total * F.col("__vat")).alias("VatAmount"),
        F.round(total + total * F.col("__vat"), 4).alias("TotalAmount"),
        F.col("ExchangeRate"), F.col("Itemkey"),
        F.col("__curid").alias("CurrencyKey"),
        to_local("OrderDate").alias("OrderDate"),
        to_local("ShipDate").alias("ShipDate"),
        to_local("DeliveredDate").alias("DeliveredDate"),
        _key("OrderDate", local_keys).alias("OrderDateKey"),
        _key("ShipDate", local_keys).alias("ShipDateKey"),
        _key("DeliveredDate", local_keys).alias("DeliveredDateKey"),
        F.col("TrackingNumber"), F.col("Batchid").alias("BatchId"), F.col("CreatedBy"),
        F.col("RecordId").alias("PurchaseOrderRecordId"),
        F.col("CategoryId").alias("CategoryKey"),
        hash_key("RecordId").alias("PurchaseOrderHashKey"),
    )
    if audit:
        out = out.withColumn("UpdatedDateTime", audit_ts(as_of))
    return out


def promotions_view(promotable: DataFrame) -> DataFrame:
    """vwPromotable: id, volume band from the name, validity, percentage."""
    p = with_volume_bands(promotable.select(
        "PromotionId", "PromotionName", "ValidFrom", "ValidTo", "PromoPercentage"))
    return p.select(F.col("PromotionId").alias("PR_PromotionId"), "VolumeStart", "VolumeEnd",
                    F.col("ValidFrom").alias("PR_ValidFrom"), F.col("ValidTo").alias("PR_ValidTo"),
                    F.col("PromoPercentage").alias("PR_PromoPercentage"))


def sales_fact(sol: DataFrame, currency: DataFrame, dimpaymenttypes: DataFrame,
               promotable: DataFrame, as_of: _dt.datetime | None = None,
               drop_null_records: bool = True, trim_currency: bool = True,
               audit: bool = True, local_keys: bool = False) -> DataFrame:
    """factsalesorderline.

    Joins bronze currency (codes trimmed on both sides; ``trim_currency=False``
    keeps the source's untrimmed match), the
    payment-type dimension and the promotions chosen by the CASE rule
    (validity window in January, quantity band otherwise). A line matching
    several promotions yields several rows, as in the source.
    Amounts: Total = Qty*Price; Disc = Total*(1-pct) when a promotion
    matched else Total; Vat = Disc*VatPercentage; Order = Disc+Vat.
    """
    if drop_null_records:
        sol = sol.filter(F.col("RecordId").isNotNull())
    code = F.trim(F.col("Code")) if trim_currency else F.col("Code")
    cur = currency.select(code.alias("__code"), F.col("CurrencyId").alias("__curid"))
    pay = dimpaymenttypes.select(F.col("PaymentTypeDesc").alias("__ptd"),
                                 F.col("PaymentTypeId").alias("__ptid"))
    scode = F.trim(F.col("CurrencyCode")) if trim_currency else F.col("CurrencyCode")
    j = (sol.join(cur, scode == F.col("__code"), "left")
            .join(pay, F.col("PaymentTypeDesc") == F.col("__ptd"), "left"))
    j = promotion_join(j, promotions_view(promotable), date_col="BookDate", qty_col="Qty",
                       valid_from="PR_ValidFrom", valid_to="PR_ValidTo")
    # Each derived amount is its own projection step (no lateral aliases).
    j = j.withColumn("TotalAmount", F.col("Qty") * F.col("Price"))
    j = j.withColumn("TotalAmountWithDiscount",
                     F.when(F.col("PR_PromotionId").isNull(), F.col("TotalAmount"))
                      .otherwise(F.col("TotalAmount") * (1 - F.col("PR_PromoPercentage"))))
    j = j.withColumn("VatAmount", F.col("TotalAmountWithDiscount") * F.col("VatPercentage"))
    j = j.withColumn("TotalOrderAmount", F.col("TotalAmountWithDiscount") + F.col("VatAmount"))
    out = j.select(
        "SalesOrderNumber", "SalesOrderLine",
        ts_default("LastProcessedChange_DateTime").alias("LastProcessedChange_DateTime"),
        to_local("DataLakeModified_DateTime").alias("DataLakeModified_DateTime"),
        "ItemId", "Qty", "Price", "TotalAmount", "TotalAmountWithDiscount",
        "VatPercentage", "VatAmount", "TotalOrderAmount",
        F.col("__curid").alias("CurrencyId"),
        to_local("BookDate").alias("BookDate"),
        _key("BookDate", local_keys).alias("BookDateKey"),
        to_local("ShippedDate").alias("ShippedDate"),
        _key("ShippedDate", local_keys).alias("ShippedDateKey"),
        to_local("DeliveredDate").alias("DeliveredDate"),
        _key("DeliveredDate", local_keys).alias("DeliveredDateKey"),
        "TrackingNumber", "CustId",
        F.col("__ptid").alias("PaymentTypeId"),
        F.col("PR_PromotionId").alias("PromotionId"),
        F.col("RecordId").alias("SalesOrderLineRecordId"),
        hash_key("RecordId").alias("SalesOrderLineHashKey"),
    )
    if audit:
        out = out.withColumn("UpdatedDateTime", audit_ts(as_of))
    return out
