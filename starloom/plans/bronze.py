"""Bronze: source-aligned copies of the raw tables into the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.quality import record_counts
from starloom.sources.catalog import Catalog, read_raw

# Bronze table -> raw folder/entity, the fifteen loads.
BRONZE_SPECS: tuple[tuple[str, str], ...] = (
    ("costcenter", "Others/CostCenter"),
    ("currency", "Others/Currency"),
    ("custtable", "Sales/CustTable"),
    ("fiscalperiod", "Others/FiscalPeriod"),
    ("parties", "Purchase/Parties"),
    ("partyaddress", "Purchase/PartyAddress"),
    ("paymenttypes", "Sales/PaymentTypes"),
    ("promotable", "Sales/PromoTable"),
    ("purchcategory", "Purchase/PurchCategory"),
    ("purchcontracts", "Purchase/PurchContracts"),
    ("purchitem", "Purchase/PurchItem"),
    ("purchaseorder", "Purchase/PurchaseOrder"),
    ("salesorderline", "Sales/SalesOrderLine"),
    ("vendtable", "Purchase/VendTable"),
    ("workertable", "Hr/WorkerTable"),
)
BRONZE = "bronze"


def load_bronze(spark: SparkSession, cat: Catalog, raw_root: str, fmt: str = "parquet",
                specs=BRONZE_SPECS, schema: str = BRONZE, allow_schema_change: bool = False) -> DataFrame:
    """Overwrite each bronze table from its raw path and reconcile counts.

    Returns one row per table: (table, status, source_rows, target_rows,
    passed, error); a missing raw path, or a schema that differs from the
    table's where that is not allowed, is reported, not fatal.
    """
    rows = []
    for table, raw in specs:
        try:
            src = read_raw(spark, f"{raw_root}/{raw}", fmt)
            cat.overwrite(src, schema, table, allow_schema_change=allow_schema_change)
            rc = record_counts(read_raw(spark, f"{raw_root}/{raw}", fmt), cat.read(schema, table)).first()
            rows.append((table, "loaded", rc["source_rows"], rc["target_rows"], rc["passed"], None))
        except Exception as e:  # noqa: BLE001 - reported per table
            rows.append((table, "failed", None, None, False, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(rows, "table string, status string, source_rows long, "
                                       "target_rows long, passed boolean, error string")
