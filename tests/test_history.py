import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.history import (high_water_mark, incremental_after, neighbor_in_key, scd2,
                                        snapshot_changes, upsert)

T = dt.datetime


def _skewed(spark):
    # user 0 holds about a third of all rows (the hot key)
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("user_id"),
        (F.lit(T(2024, 1, 1)).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 37 % 100000))
        .alias("ts"),
        F.col("id").alias("event_id"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None).cast("string")),
                     (F.col("id") * 7 % 3 + 1).cast("int")).alias("event_type"))
    return df


def test_neighbor_in_key_equals_window_lag_and_lead(spark):
    df = _skewed(spark)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = df.select("event_id", F.lag("event_type").over(w).alias("p"), F.lead("ts").over(w).alias("n"))
    got_p = neighbor_in_key(df, ["user_id"], ["ts", "event_id"], ["event_type"], "prev", partitions=7)
    got_n = neighbor_in_key(df, ["user_id"], ["ts", "event_id"], ["ts"], "next", partitions=5)
    a = {r.event_id: (r.p, r.n) for r in ref.collect()}
    p = {r.event_id: r.prev_event_type for r in got_p.collect()}
    n = {r.event_id: r.next_ts for r in got_n.collect()}
    assert len(p) == 3000 and all(a[k][0] == p[k] for k in a) and all(a[k][1] == n[k] for k in a)


def test_scd2_intervals(spark):
    rows = [(1, T(2024, 1, 1), 1, "a"), (1, T(2024, 1, 2), 2, "a"), (1, T(2024, 1, 3), 3, "b"),
            (1, T(2024, 1, 4), 4, None), (1, T(2024, 1, 5), 5, None), (2, T(2024, 1, 1), 6, None)]
    df = spark.createDataFrame(rows, "user_id int, ts timestamp, event_id int, event_type string")
    got = sorted((r.user_id, str(r.event_type), r.ValidFrom.day, r.ValidTo.day if r.ValidTo else None,
                  r.IsCurrent) for r in scd2(df, ["user_id"], "ts", ["event_type"], ["event_id"]).collect())
    assert got == [(1, "None", 4, None, True), (1, "a", 1, 3, False), (1, "b", 3, 4, False),
                   (2, "None", 1, None, True)]


def test_snapshot_changes_and_upsert(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "d")], "k int, v string")
    ch = {r.k: r.change for r in snapshot_changes(before, after, ["k"], ["v"]).collect()}
    assert ch == {2: "update", 4: "insert"}
    ch2 = {r.k: r.change for r in snapshot_changes(after, before, ["k"], ["v"]).collect()}
    assert ch2 == {2: "update", 4: "delete"}
    up = sorted((r.k, r.v) for r in upsert(before, after.filter("k >= 2"), ["k"]).collect())
    assert up == [(1, "a"), (2, "c"), (3, None), (4, "d")]


def test_incremental_after(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1), "x"), (1, T(2024, 1, 3), "y"), (2, T(2024, 1, 2), "z")],
                               "k int, ts timestamp, v string")
    assert high_water_mark(df.filter("ts < '2024-01-02'"), "ts") == T(2024, 1, 1)
    got = sorted((r.k, r.v) for r in incremental_after(df, "ts", T(2024, 1, 1), ["k"]).collect())
    assert got == [(1, "y"), (2, "z")]
