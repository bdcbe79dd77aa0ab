"""Silver: build every dimension and fact from bronze tables, in dependency
order (payment types before the sales fact, verticals before workers, cost
centre and currency before the purchase fact)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from starloom.plans.dims import (SPECS, build_dim, dim_date, dim_party, dim_worker,
                                 new_payment_types, new_verticals)
from starloom.operators.calendar import calendar
from starloom.plans.facts import promotions_view, purchase_fact, sales_fact
from starloom.sources.catalog import Catalog, temp_view

SILVER = "silver"
BRONZE = "bronze"


def _counted(df, name: str):
    """``df`` plus an Observation counting its rows during the write itself
    (one pass: the new members are not computed twice)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


def run_payment_types(cat: Catalog, keep_null: bool = False) -> int:
    """Insert-only load of dimpaymenttypes; returns rows appended."""
    cat.create_if_absent(SILVER, "dimpaymenttypes", "PaymentTypeId INT, PaymentTypeDesc STRING")
    new = new_payment_types(cat.read(BRONZE, "salesorderline"), cat.read(SILVER, "dimpaymenttypes"),
                            keep_null=keep_null)
    new, obs = _counted(new, "dimpaymenttypes_new")
    cat.append(new, SILVER, "dimpaymenttypes")
    return int(obs.get["n"])


def run_verticals(cat: Catalog) -> int:
    """Insert-only load of dimvertical; returns rows inserted."""
    cat.create_if_absent(SILVER, "dimvertical", "VerticalId BIGINT, Vertical STRING")
    new = new_verticals(cat.read(BRONZE, "workertable"), cat.read(SILVER, "dimvertical"))
    new, obs = _counted(new, "dimvertical_new")
    cat.insert_select(SILVER, "dimvertical", new, ["VerticalId", "Vertical"])
    return int(obs.get["n"])


def _quarantined(cat: Catalog, df, name: str) -> str:
    """Writes the lines without a record id, which the facts leave out, to ``<name>_quarantine``; says how many."""
    bad, obs = _counted(df.filter(F.col("RecordId").isNull()), f"{name}_bad")
    cat.overwrite(bad, SILVER, f"{name}_quarantine", allow_schema_change=True)
    return f"overwritten, {int(obs.get['n'])} lines without a record id in {name}_quarantine"


def run_silver(cat: Catalog, as_of: _dt.datetime | None = None,
               calendar_start: _dt.date | None = None, calendar_end: _dt.date | None = None,
               only: set[str] | None = None, allow_schema_change: bool = False) -> dict[str, str]:
    """Build silver tables from bronze; returns table -> status.

    A table that fails, or whose sources are missing, is named in the result
    ("failed: ..", "skipped: ..") and does not stop the others. A schema that
    differs from the table's is refused unless allowed.
    """
    spark = cat.spark
    have = set(cat.list_tables(BRONZE)) if cat.schema_exists(BRONZE) else set()

    def bronze(name: str):
        return cat.read(BRONZE, name)

    def write(df, name: str, cluster_by: list[str] | None = None) -> str:
        cat.overwrite(df, SILVER, name, allow_schema_change=allow_schema_change, cluster_by=cluster_by)
        return "overwritten"

    def days():
        kw = {k: v for k, v in (("start", calendar_start), ("end", calendar_end)) if v}
        return write(dim_date(calendar(spark, **kw), bronze("fiscalperiod"), as_of), "dimdate")

    def purchases():
        po = bronze("purchaseorder")
        write(purchase_fact(po, cat.read(SILVER, "dimcostcenter"), cat.read(SILVER, "dimcurrency"), as_of),
              "factpurchaseorder", ["OrderDateKey"])
        return _quarantined(cat, po, "factpurchaseorder")

    def sales():
        sol = bronze("salesorderline")
        write(sales_fact(sol, bronze("currency"), cat.read(SILVER, "dimpaymenttypes"), bronze("promotable"), as_of),
              "factsalesorderline", ["BookDateKey"])
        return _quarantined(cat, sol, "factsalesorderline")

    steps = [(s.name, {s.source}, lambda s=s: write(build_dim(s, bronze(s.source), as_of), s.name)) for s in SPECS.values()]
    steps += [
        ("dimparty", {"parties", "partyaddress"},
         lambda: write(dim_party(bronze("parties"), bronze("partyaddress"), as_of), "dimparty")),
        ("dimdate", {"fiscalperiod"}, days),
        ("dimvertical", {"workertable"}, lambda: f"appended {run_verticals(cat)}"),
        ("dimworker", {"workertable"},
         lambda: write(dim_worker(bronze("workertable"), cat.read(SILVER, "dimvertical"), as_of), "dimworker")),
        ("dimpaymenttypes", {"salesorderline"}, lambda: f"appended {run_payment_types(cat)}"),
        ("factpurchaseorder", {"purchaseorder"}, purchases),
        ("factsalesorderline", {"salesorderline", "currency", "promotable"}, sales),
    ]
    status: dict[str, str] = {}
    for name, needs, build in steps:
        if only is not None and name not in only:
            continue
        if needs - have:
            status[name] = f"skipped: bronze lacks {', '.join(sorted(needs - have))}"
            continue
        try:
            status[name] = build()
        except Exception as e:  # noqa: BLE001 - reported per table
            status[name] = f"failed: {type(e).__name__}: {e}"
    if "promotable" in have:
        # the promotion view with its volume bands, for SQL users of the session
        temp_view(promotions_view(bronze("promotable")), "vwPromotable")
    return status
