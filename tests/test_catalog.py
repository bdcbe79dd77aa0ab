import pytest

from starloom.sources.catalog import Catalog, SchemaMismatch, read_raw, write_raw


@pytest.fixture()
def cat(spark):
    c = Catalog(spark)
    yield c
    for t in c.list_tables("t_cat") if spark.catalog.databaseExists("t_cat") else []:
        c.drop_if_exists("t_cat", t)


def test_overwrite_names_lowercased_and_schema_guard(spark, cat):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    cat.overwrite(df, "T_Cat", "MyTable")
    assert "mytable" in cat.list_tables("t_cat")
    with pytest.raises(SchemaMismatch):
        cat.overwrite(spark.createDataFrame([(1,)], "id bigint"), "t_cat", "mytable")
    cat.overwrite(spark.createDataFrame([(1,)], "id bigint"), "t_cat", "mytable", allow_schema_change=True)
    assert cat.read("t_cat", "mytable").columns == ["id"]


def test_overwrite_table_read_by_same_plan(spark, cat):
    cat.overwrite(spark.createDataFrame([(1,), (2,)], "id int"), "t_cat", "selfref")
    cur = cat.read("t_cat", "selfref")
    cat.overwrite(cur.selectExpr("id * 10 as id"), "t_cat", "selfref")
    assert sorted(r.id for r in cat.read("t_cat", "selfref").collect()) == [10, 20]


def test_append_by_name_and_merge_schema(spark, cat):
    cat.overwrite(spark.createDataFrame([(1, "a")], "id int, v string"), "t_cat", "app")
    cat.append(spark.createDataFrame([("b", 2)], "v string, id int"), "t_cat", "app")
    assert sorted((r.id, r.v) for r in cat.read("t_cat", "app").collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(SchemaMismatch):
        cat.append(spark.createDataFrame([(3, "c", 1.5)], "id int, v string, w double"), "t_cat", "app")
    cat.append(spark.createDataFrame([(3, "c", 1.5)], "id int, v string, w double"), "t_cat", "app",
               merge_schema=True)
    rows = sorted((r.id, r.v, r.w) for r in cat.read("t_cat", "app").collect())
    assert rows == [(1, "a", None), (2, "b", None), (3, "c", 1.5)]


def test_create_insert_partial_and_delete(spark, cat):
    cat.create_if_absent("t_cat", "wt", "Vertical STRING, RecordId BIGINT")
    cat.create_if_absent("t_cat", "wt", "Vertical STRING, RecordId BIGINT")  # idempotent
    cat.insert_values("t_cat", "wt", ["Vertical", "RecordId"], [("Sales", 1), (None, 2)])
    cat.insert_values("t_cat", "wt", ["Vertical"], [("Data & AI",)])
    rows = sorted((r.Vertical or "", r.RecordId or 0) for r in cat.read("t_cat", "wt").collect())
    assert rows == [("", 2), ("Data & AI", 0), ("Sales", 1)]
    cat.delete_where("t_cat", "wt", "Vertical = 'Data & AI'")
    # the NULL-vertical row survives (predicate is NULL, not true)
    rows = sorted((r.Vertical or "", r.RecordId or 0) for r in cat.read("t_cat", "wt").collect())
    assert rows == [("", 2), ("Sales", 1)]


def test_raw_paths_and_external_table(spark, cat, scratch):
    p = f"{scratch}/raw/Others/CostCenter"
    write_raw(spark.createDataFrame([("CC1", 0.2)], "CostCenterNumber string, Vat double"), p)
    assert read_raw(spark, p).count() == 1
    cat.register_external("t_cat", "cc_ext", p)
    assert cat.read("t_cat", "cc_ext").first().CostCenterNumber == "CC1"


def test_clustered_layout_prunes(spark, scratch):
    from pyspark.sql import functions as F

    from starloom.sources.catalog import write_clustered
    df = spark.range(0, 5000).select(
        F.when(F.col("id") < 2000, F.lit(2024)).otherwise(F.lit(2020) + F.col("id") % 3).alias("year"),
        F.col("id").alias("k"))
    p = f"{scratch}/layout/facts"
    write_clustered(df, p, ["year"], ["k"], files=6)
    back = spark.read.parquet(p)
    assert back.count() == 5000
    q = back.filter((F.col("year") == 2024) & (F.col("k") < 10))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters" in plan
    assert q.count() == 10
    # the hot year (40% of rows) is written by several tasks, not one
    import glob
    assert len(glob.glob(f"{p}/year=2024/*.parquet")) > 1


def test_bucketed_tables_join_without_shuffle(spark, cat):
    from pyspark.sql import functions as F
    lines = spark.range(0, 4000).select((F.col("id") % 1000).alias("o_key"), F.col("id").alias("line"))
    heads = spark.range(0, 1000).select(F.col("id").alias("o_key"), (F.col("id") % 7).alias("prio"))
    cat.overwrite_bucketed(lines, "t_cat", "lines_b", 8, ["o_key"])
    cat.overwrite_bucketed(heads, "t_cat", "heads_b", 8, ["o_key"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = cat.read("t_cat", "lines_b").join(cat.read("t_cat", "heads_b"), "o_key")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_partitions_rewrites_only_touched(spark, cat):
    import os
    first = spark.createDataFrame([(1, "a", 2023), (2, "b", 2023), (3, "c", 2024)], "k int, v string, y int")
    cat.upsert_partitions(first, "t_cat", "part_up", ["k"], ["y"])
    loc = spark.sql("describe formatted t_cat.part_up").filter("col_name = 'Location'").first().data_type
    path_2023 = loc.replace("file:", "") + "/y=2023"
    before = sorted(os.listdir(path_2023))
    upd = spark.createDataFrame([(3, "c2", 2024), (4, "d", 2024)], "k int, v string, y int")
    cat.upsert_partitions(upd, "t_cat", "part_up", ["k"], ["y"])
    got = sorted((r.k, r.v, r.y) for r in cat.read("t_cat", "part_up").collect())
    assert got == [(1, "a", 2023), (2, "b", 2023), (3, "c2", 2024), (4, "d", 2024)]
    assert sorted(os.listdir(path_2023)) == before  # the untouched partition kept its files


def test_delete_rewrites_only_the_partitions_it_touches(spark):
    import os
    cat = Catalog(spark)
    cat.ensure_schema("stage")
    df = spark.createDataFrame([(i, "abc"[i % 3] if i < 30 else None) for i in range(40)], "k int, p string")
    df.write.partitionBy("p").mode("overwrite").saveAsTable("stage.del_parts")
    path = lambda: {f.getPath() if hasattr(f, "getPath") else f for f in cat.read("stage", "del_parts").inputFiles()}
    was = path()
    cat.delete_where("stage", "del_parts", "p = 'a' or (p = 'b' and k < 10) or (p is null and k = 35)")
    left = sorted((r["k"], str(r["p"])) for r in cat.read("stage", "del_parts").collect())
    want = sorted((i, "abc"[i % 3] if i < 30 else "None") for i in range(40)
                  if not (i < 30 and i % 3 == 0 or i < 30 and i % 3 == 1 and i < 10 or i == 35))
    assert left == want
    kept = {f for f in was if f"{os.sep}p=c{os.sep}" in f}
    assert kept and kept <= path() and not {f for f in path() if f"{os.sep}p=a{os.sep}" in f}
    cat.delete_where("stage", "del_parts", "p = 'nowhere'")
    assert sorted((r["k"], str(r["p"])) for r in cat.read("stage", "del_parts").collect()) == want
    cat.drop_if_exists("stage", "del_parts")
