"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They run the library's builders on ERP-shaped frames derived from the
driver tables (``standins``). Load timestamps are left out (non-deterministic
by design), everything else is the full output over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.conform import date_key, hash_key, local_date, to_local, ts_default
from starloom.operators import history as H
from starloom.operators import quality as Q
from starloom.operators.calendar import calendar_for
from starloom.operators.range_join import interval_join
from starloom.operators.surrogate import dimension_after
from starloom.plans import standins as si
from starloom.plans.dims import SPECS, build_dim, dim_date, dim_party, dim_worker
from starloom.plans import gold as G
from starloom.plans import marts as M
from starloom.plans.exports import scratch
from starloom.plans.facts import purchase_fact, sales_fact
from starloom.plans.tables import Tables


def _stored(df: DataFrame) -> DataFrame:
    """A lookup's side as files, as the silver tables are: Spark then knows its size when it plans, and deals the lines by key
    only if it is too large to broadcast. Unstored, it would count as large as the table it is drawn from."""
    path = scratch(df.sparkSession, "lookup")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_purchase_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cc = _stored(build_dim(SPECS["dimcostcenter"], si.costcenter(t), audit=False))
    cur = _stored(build_dim(SPECS["dimcurrency"], si.currency(t), audit=False))
    return purchase_fact(si.purchaseorder(t), cc, cur, audit=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "purchase_fact": q_purchase_fact,
}


def _empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def _payment_types(spark: SparkSession, t: Tables) -> DataFrame:
    return dimension_after(si.payment_sources(t), _empty(spark, "PaymentTypeId int, PaymentTypeDesc string"),
                           "PaymentTypeDesc", "PaymentTypeId")


def _verticals(spark: SparkSession, t: Tables) -> DataFrame:
    return dimension_after(si.workertable(t), _empty(spark, "VerticalId bigint, Vertical string"),
                           "Vertical", "VerticalId", trim=True, id_type="long")


def q_sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # parity with the source: bronze currency codes matched as given
    return sales_fact(si.salesorderline(t), _stored(si.currency(t)), _stored(_payment_types(spark, t)),
                      _stored(si.promotable(t)), audit=False, trim_currency=False)


def q_dim_costcenter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(SPECS["dimcostcenter"], si.costcenter(Tables(spark, sf_dir)), audit=False)


def q_dim_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(SPECS["dimcurrency"], si.currency(Tables(spark, sf_dir)), audit=False)


def q_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(SPECS["dimcusttable"], si.custtable(Tables(spark, sf_dir)), audit=False)


def q_dim_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(SPECS["dimpromotable"], si.promotable(Tables(spark, sf_dir)), audit=False)


def q_dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(SPECS["dimvendor"], si.vendtable(Tables(spark, sf_dir)), audit=False)


def q_dim_purchase_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(SPECS["dimpurchasecategory"], si.purchcategory(Tables(spark, sf_dir)), audit=False)


def q_dim_purch_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(SPECS["dimpurchitem"], si.purchitem(Tables(spark, sf_dir)), audit=False)


def q_dim_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return dim_party(si.parties(t), si.partyaddress(t), audit=False)


def q_dim_vertical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verticals(spark, Tables(spark, sf_dir))


def q_dim_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return dim_worker(si.workertable(t), _stored(_verticals(spark, t)), audit=False)


def q_dim_payment_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two insert-only runs: the load as of 1998, then all orders."""
    t = Tables(spark, sf_dir)
    src = si.payment_terms(t)
    first = dimension_after(src.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
                            _empty(spark, "PaymentTypeId int, PaymentTypeDesc string"),
                            "PaymentTypeDesc", "PaymentTypeId")
    return dimension_after(src, first, "PaymentTypeDesc", "PaymentTypeId")


def q_dim_payment_types_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parity variant (NULL kept as a member): low-priority orders carry no
    payment type; NULL gets an id (it sorts first) and a rerun adds nothing
    for it, because NULL = NULL in the membership test."""
    t = Tables(spark, sf_dir)
    src = t.orders.select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
                          .alias("PaymentTypeDesc"))
    first = dimension_after(src, _empty(spark, "PaymentTypeId int, PaymentTypeDesc string"),
                            "PaymentTypeDesc", "PaymentTypeId", keep_null=True)
    return dimension_after(src, first, "PaymentTypeDesc", "PaymentTypeId", keep_null=True)


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cal = calendar_for(t.orders, "o_orderdate")
    return dim_date(cal, si.fiscalperiod(t), audit=False)


def q_fiscal_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line's ship date placed in its fiscal period (left range join)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    fp = si.fiscalperiod(t).select("FiscalPeriodName", "FiscalStartDate", "FiscalEndDate",
                                   "FiscalYear", "FiscalQuarter", "FiscalMonth")
    return interval_join(li, fp, "l_shipdate", "FiscalStartDate", "FiscalEndDate", how="left")


QUERIES.update({
    "sales_fact": q_sales_fact,
    "dim_costcenter": q_dim_costcenter,
    "dim_currency": q_dim_currency,
    "dim_customer": q_dim_customer,
    "dim_promotion": q_dim_promotion,
    "dim_vendor": q_dim_vendor,
    "dim_purchase_category": q_dim_purchase_category,
    "dim_purch_item": q_dim_purch_item,
    "dim_party": q_dim_party,
    "dim_vertical": q_dim_vertical,
    "dim_worker": q_dim_worker,
    "dim_payment_types": q_dim_payment_types,
    "dim_payment_types_with_null": q_dim_payment_types_with_null,
    "dim_date": q_dim_date,
    "fiscal_range_join": q_fiscal_range_join,
})


# --- conformance rules on their own ------------------------------------------

def q_conform_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL default, UTC -> local time, local date, yyyyMMdd keys (UTC and local).
    Error events carry no processing time (NULL) and get the 1900 default."""
    e = Tables(spark, sf_dir).events
    lpc = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("ts"))
    return e.select(
        "event_id",
        ts_default(lpc).alias("LastProcessedChange_DateTime"),
        to_local("ts").alias("LocalTime"),
        local_date("ts").alias("LocalDate"),
        date_key("ts").alias("EventDateKey"),
        date_key(to_local("ts")).alias("LocalDateKey"),
    )


def q_hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """xxhash64 keys of an 8-byte id and of a 4-byte yyyyMMdd date id."""
    o = Tables(spark, sf_dir).orders
    d = date_key("o_orderdate")
    return o.select("o_orderkey", hash_key("o_orderkey").alias("OrderHashKey"),
                    d.alias("OrderDateId"), hash_key(d).alias("OrderDateHashKey"))


# --- data quality --------------------------------------------------------------

def q_dq_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the source vs rows in the purchase fact."""
    return Q.record_counts(Tables(spark, sf_dir).lineitem, q_purchase_fact(spark, sf_dir),
                           "lineitem_to_factpurchaseorder")


def q_dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicates(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


def _gaps(t: Tables) -> DataFrame:
    li = t.lineitem
    blank = {"l_discount": F.col("l_linenumber") == 1, "l_shipdate": F.col("l_returnflag") == "R"}
    return li.select(*[F.when(~blank[c], F.col(c)).alias(c) if c in blank else F.col(c) for c in li.columns])


def q_dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null counts of the lines; the first lines of an order carry no discount, returned ones no ship date."""
    return Q.null_counts(_gaps(Tables(spark, sf_dir)))


def q_dq_key_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    a = Q.key_validity(t.orders, ["o_orderkey"]).withColumn("table_name", F.lit("orders"))
    b = Q.key_validity(t.lineitem, ["l_orderkey", "l_linenumber"]).withColumn("table_name", F.lit("lineitem"))
    return a.unionByName(b)


def q_dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return Q.orphan_counts([
        ("lineitem.l_orderkey->orders", t.lineitem, t.orders, "l_orderkey", "o_orderkey"),
        ("lineitem.l_partkey->part", t.lineitem, t.part, "l_partkey", "p_partkey"),
        ("lineitem.l_suppkey->supplier", t.lineitem, t.supplier, "l_suppkey", "s_suppkey"),
        ("orders.o_custkey->customer", t.orders, t.customer, "o_custkey", "c_custkey"),
        # against sides that lack a status and a segment
        ("lineitem.l_orderkey->some orders", t.lineitem, t.orders.filter("o_orderstatus <> 'F'"), "l_orderkey", "o_orderkey"),
        ("orders.o_custkey->some customers", t.orders, t.customer.filter("c_mktsegment <> 'BUILDING'"), "o_custkey", "c_custkey"),
    ])


# Fixed rule of the invalid-record check: a line may carry at most 8% discount.
MAX_DISCOUNT = 0.08


def q_dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    _, bad = Q.split_valid(li, (F.col("l_discount") <= MAX_DISCOUNT) & (F.col("l_quantity") > 0))
    return bad.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


def q_dq_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order per customer (by date, then key)."""
    return Q.keep_latest(Tables(spark, sf_dir).orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def q_dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    tables = {"lineitem": t.lineitem, "orders": t.orders, "customer": t.customer, "gaps": _gaps(t),
              "some_orders": t.orders.filter("o_orderstatus <> 'F'")}
    rules = [
        Q.Rule("orders_key_not_null", "orders", "not_null", ("o_orderkey",)),
        Q.Rule("orders_key_unique", "orders", "unique", ("o_orderkey",)),
        Q.Rule("lineitem_key_unique", "lineitem", "unique", ("l_orderkey", "l_linenumber")),
        Q.Rule("lineitem_discount_range", "lineitem", "valid",
               predicate="l_discount between 0 and 0.1"),
        Q.Rule("lineitem_order_fk", "lineitem", "foreign_key", ("l_orderkey",),
               ref_table="orders", ref_column="o_orderkey"),
        Q.Rule("customer_not_empty", "customer", "row_count", params={"min": 1}),
        # one rule of each kind that fails
        Q.Rule("gaps_discount_not_null", "gaps", "not_null", ("l_discount", "l_shipdate")),
        Q.Rule("lineitem_order_unique", "lineitem", "unique", ("l_orderkey",)),
        Q.Rule("lineitem_small_discount", "lineitem", "valid", predicate="l_discount <= 0.05"),
        Q.Rule("lineitem_some_orders_fk", "lineitem", "foreign_key", ("l_orderkey",),
               ref_table="some_orders", ref_column="o_orderkey"),
        Q.Rule("customer_many", "customer", "row_count", params={"min": 1_000_000_000}),
    ]
    return Q.run_rules(rules, tables)


# --- marts -----------------------------------------------------------------------

def q_mart_revenue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return M.revenue_rollup(t.lineitem, t.orders)


def q_mart_vendor_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return M.vendor_performance(t.lineitem, t.supplier, t.nation)


def q_mart_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return M.top_customers(t.lineitem, t.orders, t.customer, k=20)


# --- history / incremental -------------------------------------------------------

SNAPSHOT_CUT = "2024-01-15 00:00:00"
WATERMARK = "2024-01-20 00:00:00"


def _events(spark, sf_dir):
    return Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")


def q_history_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, runs of the same event type as validity intervals."""
    out = H.scd2(_events(spark, sf_dir), ["user_id"], "ts", ["event_type"], tiebreak=["event_id"])
    return out.drop("VersionHash")


def _cut(df, before: bool):
    c = F.col("ts") < F.lit(SNAPSHOT_CUT).cast("timestamp_ntz")
    return df.filter(c if before else ~c)


def q_history_snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose latest event changed between the mid-month and month-end snapshots.

    The first snapshot lacks the users whose last event was a signup, the
    second those whose last is an error; users whose last event was a view
    keep the first snapshot's row in both.
    """
    ev, order = _events(spark, sf_dir), ["ts", "event_id"]
    latest, now = (Q.keep_latest(x, ["user_id"], order) for x in (_cut(ev, True), ev))
    before = latest.filter("event_type <> 'signup'")
    still = latest.filter("event_type = 'view'")
    after = now.filter("event_type <> 'error'").join(still.select("user_id"), "user_id", "left_anti").select(*now.columns).unionByName(still)
    return H.snapshot_changes(before, after, ["user_id"], ["event_type", "value"])


def q_history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest-per-user table loaded up to mid-month, then upserted twice.

    First come all newer rows, then late ones (every user's first event),
    which must not replace what is there.
    """
    ev = _events(spark, sf_dir)
    order = ["ts", "event_id"]
    target = Q.keep_latest(_cut(ev, True), ["user_id"], order)
    newer = Q.keep_latest(_cut(ev, False), ["user_id"], order)
    late = (ev.groupBy("user_id").agg(F.min(F.struct("ts", "event_id", "event_type", "value")).alias("x"))
            .select("x.event_id", "x.ts", "user_id", "x.event_type", "x.value"))
    return H.upsert(H.upsert(target, newer, ["user_id"], order), late, ["user_id"], order)


def q_incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after the last load's high-water mark, latest per user."""
    return H.incremental_after(_events(spark, sf_dir), "ts", WATERMARK, ["user_id"], ["ts", "event_id"])


def q_mart_sales_by_fiscal_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold: the sales fact joined to the date dimension, rolled up by fiscal period."""
    return G.sales_by_fiscal_period(q_sales_fact(spark, sf_dir), q_dim_date(spark, sf_dir))


def q_mart_purchases_by_vendor_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold: the purchase fact joined to the vendor dimension, by vendor country."""
    return G.purchases_by_vendor_country(q_purchase_fact(spark, sf_dir), q_dim_vendor(spark, sf_dir))


QUERIES.update({
    "mart_sales_by_fiscal_period": q_mart_sales_by_fiscal_period,
    "mart_purchases_by_vendor_country": q_mart_purchases_by_vendor_country,
})


QUERIES.update({
    "conform_timestamps": q_conform_timestamps,
    "hash_keys": q_hash_keys,
    "dq_record_counts": q_dq_record_counts,
    "dq_duplicates": q_dq_duplicates,
    "dq_null_counts": q_dq_null_counts,
    "dq_key_validity": q_dq_key_validity,
    "dq_orphans": q_dq_orphans,
    "dq_quarantine": q_dq_quarantine,
    "dq_keep_latest": q_dq_keep_latest,
    "dq_rules": q_dq_rules,
    "mart_revenue_rollup": q_mart_revenue_rollup,
    "mart_vendor_performance": q_mart_vendor_performance,
    "mart_top_customers": q_mart_top_customers,
    "history_scd2": q_history_scd2,
    "history_snapshot_changes": q_history_snapshot_changes,
    "history_upsert": q_history_upsert,
    "incremental_watermark": q_incremental_watermark,
})
