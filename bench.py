"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Two warm-ups, then the median of $BENCH_RUNS runs per query; each run builds
the plan and forces the full result with a ``noop``
write. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starloom.operators.conditional_join import promotion_join  # noqa: E402
from starloom.operators.range_join import interval_join  # noqa: E402
from starloom.operators.surrogate import dense_number  # noqa: E402
from starloom.plans import standins as si  # noqa: E402
from starloom.plans.facts import promotions_view  # noqa: E402
from starloom.plans.queries import QUERIES  # noqa: E402
from starloom.plans.tables import Tables  # noqa: E402
from starloom.session import build_session, checkpoint_dir  # noqa: E402
from tests.nested_joins import interval_join_nested, promotion_join_nested  # noqa: E402

HEADLINE = ["purchase_fact", "sales_fact", "dim_date", "fiscal_range_join", "dim_payment_types",
            "dq_duplicates", "dq_orphans", "dq_keep_latest", "mart_revenue_rollup",
            "mart_vendor_performance", "history_scd2", "incremental_watermark"]


def _supplier_promos(t: Tables):
    """One promotion per supplier: four volume bands, the rest 4-day
    January windows spread over the order years."""
    from starloom.operators.conditional_join import VOLUME_BANDS
    k = F.col("s_suppkey")
    name = F.when(k < 4, F.element_at(F.array(*[F.lit(b[0]) for b in VOLUME_BANDS]), (k + 1).cast("int")))
    name = name.otherwise(F.lit("Seasonal"))
    vf = F.make_date((F.lit(1995) + k % 7).cast("int"), F.lit(1), (k % 28 + 1).cast("int")).cast("timestamp_ntz")
    return t.supplier.select(k.alias("PromotionId"), name.alias("PromotionName"), vf.alias("ValidFrom"),
                             (vf + F.expr("make_dt_interval(3, 0, 0, 0)")).alias("ValidTo"),
                             ((k % 30 + 1).cast("double") / 100).alias("PromoPercentage"))


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, runs: int) -> float:
    fn()  # warm-up (twice: code generation and JIT settle on the second run)
    fn()
    xs = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        xs.append(time.perf_counter() - t)
    return round(statistics.median(xs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", app="starloom-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark, default=tempfile.mkdtemp(prefix="starloom-bench-ckpt-"))

    mode = os.environ.get("BENCH_VARIANTS", "1")  # 1: both, 0: headline only, only: variants only
    queries = {}
    for name in ([] if mode == "only" else (only or HEADLINE)):
        queries[name] = _time(lambda n=name: _force(QUERIES[n](spark, sf_dir)), runs)

    variants = {}
    if (not only and mode != "0") or mode == "only":
        t = Tables(spark, sf_dir)
        # sales-fact promotion matching: literal CASE join (nested loop) vs keyed
        # join, same inputs, with the stand-in promotions and with one
        # promotion per supplier (1,000 at sf0.1); the stand-in has 35
        sol = si.salesorderline(t).select("RecordId", "BookDate", "Qty")
        for label, src in (("standin", si.promotable(t)), ("suppliers", _supplier_promos(t))):
            promos = promotions_view(src)
            kw = dict(valid_from="PR_ValidFrom", valid_to="PR_ValidTo")
            variants[f"promo_{label}_case_nested_loop"] = _time(
                lambda p=promos: _force(promotion_join_nested(sol, p, **kw)), runs)
            variants[f"promo_{label}_keyed_join"] = _time(
                lambda p=promos: _force(promotion_join(sol, p, **kw)), runs)
        # range join: literal non-equi vs bucketed equi join, lines x fiscal months
        li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
        fp = si.fiscalperiod(t).select("FiscalPeriodName", "FiscalStartDate", "FiscalEndDate")
        variants["range_nested_loop"] = _time(
            lambda: _force(interval_join_nested(li, fp, "l_shipdate", "FiscalStartDate", "FiscalEndDate")), runs)
        variants["range_bucketed"] = _time(
            lambda: _force(interval_join(li, fp, "l_shipdate", "FiscalStartDate", "FiscalEndDate")), runs)
        # key assignment for ~all line identities as new members: one task's window vs distributed
        members = t.lineitem.select(F.format_string("%d-%d", "l_orderkey", "l_linenumber").alias("m")).distinct()
        variants["keys_single_task_window"] = _time(
            lambda: _force(members.withColumn("id", F.row_number().over(Window.orderBy("m")))), runs)
        variants["keys_distributed"] = _time(
            lambda: _force(dense_number(members, "m", "id")), runs)

    out = {"metric": "headline_total_median", "value": round(sum(queries.values()), 3), "unit": "sec",
           "queries": queries, "variants": variants, "sf": os.path.basename(sf_dir).removeprefix("sf"),
           "cpus": int(cpus), "runs": runs}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
