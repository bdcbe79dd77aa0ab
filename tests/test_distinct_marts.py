from pyspark.sql import functions as F

from starloom.plans import distinct_marts as dm


def test_merged_bitmaps_count_what_count_distinct_counts(spark):
    df = spark.range(5000).select(
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None).cast("string")), (F.col("id") % 3 + 1).cast("int")).alias("g"),
        (F.col("id") % 4).alias("h"), F.when(F.col("id") % 11 > 0, (F.col("id") * F.col("id")) % 70_001).alias("who"))
    maps = dm.bitmaps(df, ["g", "h"], "who", {"n": F.lit(1).cast("long")})
    got = {(r["g"], r["h"], r["grouping_level"]): (r["k"], r["n"]) for r in dm.rollup_distinct(maps, [["g", "h"], ["g"], []], ["g", "h"], "k", ["n"]).collect()}
    want = {(r["g"], r["h"], r["l"]): (r["k"], r["n"]) for r in df.rollup("g", "h").agg(
        F.grouping_id().alias("l"), F.count_distinct("who").alias("k"), F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_no_rows_and_no_ids(spark):
    df = spark.createDataFrame([], "g string, who long")
    maps = dm.bitmaps(df, ["g"], "who")
    assert dm.distinct_counts(maps, ["g"], "k").count() == 0 and dm.distinct_counts(maps, [], "k").first()["k"] == 0
    only = dm.bitmaps(spark.createDataFrame([("a", None)], "g string, who long"), ["g"], "who", {"n": F.lit(1)})
    assert [tuple(r) for r in dm.distinct_counts(only, ["g"], "k", ["n"]).collect()] == [("a", 0, 1)]


def test_the_rows_are_shuffled_once(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), (F.col("id") % 5).alias("h"), F.col("id").alias("who"))
    out = dm.rollup_distinct(dm.bitmaps(df, ["g", "h"], "who"), [["g", "h"], ["g"], []], ["g", "h"], "k")
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 15 + 3 + 1 and plan.count("ReusedExchange") >= 2
