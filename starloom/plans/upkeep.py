"""Registered queries for what keeps a warehouse going: exports that drift or
change, histories and marts kept up by changes, layouts, checks over time.

Each runs on whole driver tables; parts of a table are told apart by
attributes only, and every row is in one of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import deltas, history, quality, quality_trend, zorder
from starloom.operators.merge import Merge
from starloom.plans import distinct_marts
from starloom.plans.exports import remove_files, scratch, write_definition, write_files
from starloom.plans.tables import Tables
from starloom.session import checkpoint_dir
from starloom.sources import compact, ledger
from starloom.sources.catalog import Catalog
from starloom.sources.cdm import ingest_entity

# Fixed values, shared with the oracle's SQL.
ORDERS_CUT = "1998-06-01 00:00:00"
EVENTS_CUT = "2024-01-15 00:00:00"
BREAK_DAYS = ("2024-01-20", "2024-01-25")
ORDER_ATTRIBUTES = [("OrderKey", "Int32"), ("CustKey", "Int32"), ("Total", "Int32"), ("Status", "String"), ("OrderDate", "DateTime"), ("Clerk", "String")]


def _before(c: str, cut: str):
    return F.col(c) < F.lit(cut).cast("timestamp_ntz")


def q_ingest_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports of ``orders``: the later one in another order, with a new column and values that outgrow their types."""
    orders = Tables(spark, sf_dir).orders
    base = scratch(spark, "drift")
    write_definition(spark, base, "Sales", "Orders", ORDER_ATTRIBUTES)
    key, cust, day = F.col("o_orderkey"), F.col("o_custkey").alias("CustKey"), F.col("o_orderdate").alias("OrderDate")
    early = orders.where(_before("o_orderdate", ORDERS_CUT))
    write_files(early.select(key.alias("OrderKey"), cust, F.floor("o_totalprice").alias("Total"), F.col("o_orderstatus").alias("Status"), day),
                base, "Sales", "Orders", "early")
    late = orders.where(~_before("o_orderdate", ORDERS_CUT))
    write_files(late.select(F.col("o_orderstatus").alias("Status"), F.col("o_orderpriority").alias("Priority"), F.col("o_totalprice").alias("Total"),
                            (key + 4_000_000_000).alias("orderkey"), cust, day), base, "Sales", "Orders", "late")
    ingest_entity(spark, base, "Sales", "Orders", f"{base}/raw", by_header=True)
    return spark.read.parquet(f"{base}/raw/Sales/Orders")


def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export loaded twice: between the runs one file is rewritten, one comes, one goes and one stays; with each row's run."""
    orders = Tables(spark, sf_dir).orders
    base, raw = scratch(spark, "ledger"), scratch(spark, "ledger-raw")
    write_definition(spark, base, "Sales", "Orders", [("OrderKey", "Int64"), ("Total", "Double"), ("Status", "String")])

    def put(name: str, priorities: list[str], status, total=F.col("o_totalprice").cast("string")) -> None:
        rows = orders.where(F.col("o_orderpriority").isin(priorities))
        write_files(rows.select(F.col("o_orderkey").alias("OrderKey"), total.alias("Total"), status.alias("Status")), base, "Sales", "Orders", name)
    state = F.col("o_orderstatus")
    put("urgent", ["1-URGENT"], state)
    put("high", ["2-HIGH"], state)
    put("rest", ["3-MEDIUM", "4-NOT SPECIFIED"], state)
    ledger.ingest_changed(spark, base, "Sales", "Orders", raw)
    remove_files(spark, base, "Sales", "Orders", "urgent")
    put("high", ["2-HIGH"], F.concat(state, F.lit("*")))
    put("low", ["5-LOW"], state, F.when(F.col("o_orderstatus") == "P", F.lit("open")).otherwise(F.col("o_totalprice").cast("string")))
    ledger.ingest_changed(spark, base, "Sales", "Orders", raw)
    runs = ledger.read_ledger(spark, raw, "Sales", "Orders").select(F.concat(F.lit("f"), F.substring(F.sha2("uri", 256), 1, 31)).alias("source_file"), "run")
    both = spark.read.parquet(f"{raw}/Sales/Orders").join(runs, "source_file")
    return both.select("OrderKey", "Total", "Status", (F.col("rejected") == "true").alias("rejected"), "run")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")


def q_history_scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of part of the first half of the events, then the second half merged in, then the first half's late rows."""
    ev = _events(spark, sf_dir)
    keys, order, tracked = ["user_id"], ["event_id"], ["event_type"]
    first, late = _before("ts", EVENTS_CUT), F.col("value") >= 30
    checkpoint_dir(spark)
    log = ev.where(first & ~F.coalesce(late, F.lit(False)))
    stored = history.scd2(log, keys, "ts", tracked, order, keep_order=True)
    for batch in (ev.where(~first), ev.where(first & F.coalesce(late, F.lit(False)))):
        stored, log = history.scd2_merge(stored, log, batch, keys, "ts", tracked, order)
        stored = stored.checkpoint()
    return stored.select("user_id", "event_type", "ValidFrom", "ValidTo", "IsCurrent")


def q_history_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MERGE of the second half's events into the first half's, by user, type and hour: every key's action and row."""
    ev = _events(spark, sf_dir).withColumn("hour", F.hour("ts"))
    keys, order = ["user_id", "event_type", "hour"], ["ts", "event_id"]
    target = quality.keep_latest(ev.where(_before("ts", EVENTS_CUT)), keys, order)
    source = quality.keep_latest(ev.where(~_before("ts", EVENTS_CUT)), keys, order)
    m = (Merge(target, source, keys)
         .when_matched_delete("s.event_type = 'error'")
         .when_matched_update(condition="s.value > t.value")
         .when_matched_update({"ts": "s.ts"}, "s.value < 5")
         .when_not_matched_insert({"ts": "s.ts", "event_id": "s.event_id", "value": "s.value"}, "s.value >= 1")
         .when_not_matched_by_source_delete("t.event_type = 'view'")
         .when_not_matched_by_source_update({"value": "0"}, "t.value < 10"))
    return m.actions()


ORDER_MART = deltas.DeltaMart(("order_year", "o_orderpriority"), {"total": "cast(o_totalprice as decimal(15,2))"},
                              {"least": "o_totalprice"}, {"most": "o_totalprice"})


def q_mart_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals kept up by deltas: new orders come, large old ones are cancelled, half-open ones change their price."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("order_year"),
                                                 _before("o_orderdate", ORDERS_CUT).alias("old"))
    before, new = orders.where("old"), orders.where("not old")
    large, half = F.col("o_totalprice") >= 400_000, F.col("o_orderstatus") == "P"
    cancelled, changed = before.where(large), before.where(~large & half)
    now = changed.withColumn("o_totalprice", F.floor(F.col("o_totalprice") / 2).cast("double"))
    after = before.where(~large & ~half).unionByName(now).unionByName(new)
    mart = ORDER_MART.build(before)
    changes = deltas.signed(new.unionByName(now), cancelled.unionByName(changed))
    return ORDER_MART.apply(mart, changes, after).withColumn("total", F.col("total").cast("double"))


def q_layout_zorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line's z-value by ship date and part; the bounds are exact up to about a million lines, as the oracle's are."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    return li.select("l_orderkey", "l_linenumber", zorder.z_value(li, ["l_shipdate", "l_partkey"], accuracy=1_000_000).alias("z"))


def q_layout_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` by status in many small files, compacted: all rows, and how many files each status has left."""
    path = scratch(spark, "small-files")
    Tables(spark, sf_dir).orders.repartition(24, "o_custkey").write.partitionBy("o_orderstatus").parquet(path)
    compact.compact(spark, path)
    rows = spark.read.parquet(path).select("o_orderkey", "o_totalprice", "o_orderstatus", F.col("_metadata.file_name").alias("file"))
    files = rows.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count_distinct("file").alias("files"))
    # a row for each folder: with it broadcast, the rows stay where they are read
    return rows.join(F.broadcast(files), F.col("o_orderstatus") == F.col("status")).select("o_orderkey", "o_totalprice", "o_orderstatus", "files")


def q_mart_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return distinct_marts.product_mart(t.lineitem, t.orders, t.part)


def q_mart_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return distinct_marts.segment_mart(t.lineitem, t.orders, t.customer)


def broken_events(ev: DataFrame) -> DataFrame:
    """``events`` with two bad loads: a day without views, and a day whose clicks have no value."""
    day = F.to_date("ts")
    gone = (day == F.lit(BREAK_DAYS[0]).cast("date")) & (F.col("event_type") == "view")
    blank = (day == F.lit(BREAK_DAYS[1]).cast("date")) & (F.col("event_type") == "click")
    return ev.where(~F.coalesce(gone, F.lit(False))).withColumn("value", F.when(~F.coalesce(blank, F.lit(False)), F.col("value")))


def q_dq_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics of the events against their own history, with two bad days."""
    h = quality_trend.metric_history(broken_events(_events(spark, sf_dir)), F.to_date("ts"), ["value", "event_type"], ["value"])
    return quality_trend.verdicts(h)


def q_dq_split_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written once, valid and rejected ones apart, and read back from either side."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    path = scratch(spark, "split")
    quality.write_split(li, (F.col("l_discount") <= 0.08) & (F.col("l_quantity") > 0), path)
    valid, rejected = quality.read_split(spark, path, li.schema)
    return valid.withColumn("side", F.lit("valid")).unionByName(rejected.withColumn("side", F.lit("rejected")))


def _schema() -> str:
    return f"q_{uuid.uuid4().hex[:12]}"


def q_catalog_append_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment in a table, the others appended with a column that the table lacks."""
    cat, schema, c = Catalog(spark), _schema(), Tables(spark, sf_dir).customer
    ours = F.col("c_mktsegment") == "BUILDING"
    cat.overwrite(c.where(ours).select("c_custkey", "c_name"), schema, "customer")
    cat.append(c.where(~ours).select("c_mktsegment", "c_custkey", "c_name"), schema, "customer", merge_schema=True)
    return cat.read(schema, "customer")


def q_catalog_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a table, those of one status under a price deleted."""
    cat, schema, o = Catalog(spark), _schema(), Tables(spark, sf_dir).orders
    cat.overwrite(o.select("o_orderkey", "o_orderstatus", "o_totalprice"), schema, "orders")
    cat.delete_where(schema, "orders", "o_orderstatus = 'F' and o_totalprice < 150000")
    return cat.read(schema, "orders")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_by_header": q_ingest_by_header,
    "ingest_incremental": q_ingest_incremental,
    "history_scd2_merge": q_history_scd2_merge,
    "history_merge": q_history_merge,
    "mart_delta": q_mart_delta,
    "mart_products": q_mart_products,
    "mart_segments": q_mart_segments,
    "layout_zorder": q_layout_zorder,
    "layout_compaction": q_layout_compaction,
    "dq_trend": q_dq_trend,
    "dq_split_write": q_dq_split_write,
    "catalog_append_merge": q_catalog_append_merge,
    "catalog_delete": q_catalog_delete,
}
