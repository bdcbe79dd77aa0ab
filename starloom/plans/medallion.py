"""The whole medallion run: ingest -> bronze -> silver -> gold.

Each step reads only what the previous one wrote (paths and catalog
tables), so any step can be rerun on its own; all of them are idempotent.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from starloom.plans.bronze import load_bronze
from starloom.plans.gold import build_gold
from starloom.plans.silver import run_silver
from starloom.sources.catalog import Catalog
from starloom.sources.cdm import FOLDERS, ingest


def run_all(spark: SparkSession, export_base: str, raw_root: str, fmt: str = "parquet",
            catalog: str | None = None, folders=FOLDERS, header: bool = True,
            as_of: _dt.datetime | None = None, calendar_start: _dt.date | None = None,
            calendar_end: _dt.date | None = None, allow_schema_change: bool = False) -> dict:
    """Run every layer; returns the ingest and bronze reports (as rows) and
    the status of every silver and gold table."""
    report = ingest(spark, export_base, raw_root, folders=folders, fmt=fmt, header=header)
    ingest_rows = [r.asDict() for r in report.collect()]  # one row per entity
    cat = Catalog(spark, catalog=catalog, fmt=fmt)
    bronze_rows = [r.asDict() for r in load_bronze(
        spark, cat, raw_root, fmt, allow_schema_change=allow_schema_change).collect()]
    silver = run_silver(cat, as_of=as_of, calendar_start=calendar_start, calendar_end=calendar_end,
                        allow_schema_change=allow_schema_change)
    gold = build_gold(cat)
    return {"ingest": ingest_rows, "bronze": bronze_rows, "silver": silver, "gold": gold}
