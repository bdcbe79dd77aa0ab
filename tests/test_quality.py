from pyspark.sql import functions as F

from starloom.operators import quality as Q


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k int, v string")
    assert Q.record_counts(df, df.limit(3)).first().asDict() == {
        "check": "record_count", "source_rows": 4, "target_rows": 3, "passed": False}
    assert [(r.k, r.dup_count) for r in Q.duplicates(df, ["k"]).collect()] == [(1, 2)]
    nc = Q.null_counts(df).first()
    assert (nc.total_rows, nc.null_k, nc.null_v) == (4, 1, 1)
    kv = Q.key_validity(df, ["k"]).first()
    assert (kv.null_key_rows, kv.duplicate_keys, kv.distinct_keys, kv.passed) == (1, 1, 2, False)
    dim = spark.createDataFrame([(1,)], "id int")
    assert sorted(r.k for r in Q.orphans(df, dim, "k", "id").collect()) == [2]
    good, bad = Q.split_valid(df, F.col("v") != "b")
    assert good.count() == 2 and bad.count() == 2  # NULL predicate goes to quarantine


def test_keep_latest_hot_key(spark):
    df = spark.range(0, 2000).select((F.col("id") % 2 * (F.col("id") % 50)).alias("k"),
                                     (F.col("id") % 17).alias("o"), F.col("id").alias("v"))
    got = {r.k: (r.o, r.v) for r in Q.keep_latest(df, ["k"], ["o", "v"]).collect()}
    ref = {}
    for r in df.collect():
        if r.k not in ref or (r.o, r.v) > ref[r.k]:
            ref[r.k] = (r.o, r.v)
    assert got == ref
    plan = Q.keep_latest(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_rules(spark):
    t = {"a": spark.createDataFrame([(1, 5), (1, 7), (None, 1)], "k int, x int"),
         "b": spark.createDataFrame([(1,)], "id int")}
    rules = [Q.Rule("nn", "a", "not_null", ("k",)), Q.Rule("uq", "a", "unique", ("k",)),
             Q.Rule("range", "a", "valid", predicate="x > 2"),
             Q.Rule("fk", "a", "foreign_key", ("k",), ref_table="b", ref_column="id"),
             Q.Rule("cnt", "b", "row_count", params={"min": 2})]
    got = {r.rule: (r.failed_rows, r.total_rows, r.passed) for r in Q.run_rules(rules, t).collect()}
    assert got == {"nn": (1, 3, False), "uq": (2, 3, False), "range": (1, 3, False),
                   "fk": (0, 3, True), "cnt": (1, 1, False)}


def test_orphan_count_plans(spark):
    # a third of the fact rows reference one key that is missing from the dimension
    fact = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(999999)).otherwise(F.col("id") % 50)
                                       .alias("fk"))
    dim = spark.range(0, 40).select(F.col("id").alias("pk"))
    want = 1000 + sum(1 for i in range(3000) if i % 3 and 40 <= i % 50)
    got = Q.orphan_row_count(fact, dim, "fk", "pk")
    assert got.first().orphan_rows == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    # keys are counted (partial aggregate) before the join's shuffle
    assert "LeftOuter" in plan and plan.index("LeftOuter") < plan.index("partial_count")
