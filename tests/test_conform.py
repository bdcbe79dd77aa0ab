import datetime as dt

from pyspark.sql import functions as F

from starloom.functions.conform import (change_hash, date_key, hash_key, local_date, to_local,
                                        trimmed, ts_default)


def test_trim_spaces_only(spark):
    df = spark.createDataFrame([("  a b  ",), ("\tx ",), (None,)], "s string")
    got = [r[0] for r in df.select(trimmed("s")).collect()]
    assert got == ["a b", "\tx", None]


def test_to_local_observes_dst(spark):
    rows = [(dt.datetime(2024, 1, 15, 12, 0),), (dt.datetime(2024, 7, 15, 12, 0),),
            (dt.datetime(2024, 3, 10, 7, 59),), (dt.datetime(2024, 3, 10, 8, 0),),
            (dt.datetime(2024, 11, 3, 6, 59),), (dt.datetime(2024, 11, 3, 7, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp")
    got = [r[0] for r in df.select(to_local("ts")).collect()]
    assert got == [dt.datetime(2024, 1, 15, 6, 0), dt.datetime(2024, 7, 15, 7, 0),
                   dt.datetime(2024, 3, 10, 1, 59), dt.datetime(2024, 3, 10, 3, 0),
                   dt.datetime(2024, 11, 3, 1, 59), dt.datetime(2024, 11, 3, 1, 0)]
    cst = [r[0] for r in df.select(F.from_utc_timestamp("ts", "CST")).collect()]
    assert cst == got  # the source's 'CST' id behaves like America/Chicago


def test_local_date_vs_utc_date_key(spark):
    # 02:00 UTC on the 1st is the previous evening locally: keys differ by a day
    df = spark.createDataFrame([(dt.datetime(2024, 2, 1, 2, 0),)], "ts timestamp")
    r = df.select(date_key("ts").alias("k"), local_date("ts").alias("d"),
                  date_key(to_local("ts")).alias("lk")).first()
    assert r.k == 20240201 and r.d == dt.date(2024, 1, 31) and r.lk == 20240131


def test_ts_default_is_timestamp(spark):
    df = spark.createDataFrame([(None,), (dt.datetime(2024, 5, 1, 3, 4),)], "ts timestamp")
    out = df.select(ts_default("ts").alias("t"))
    assert out.schema["t"].dataType.simpleString() == "timestamp"
    assert [r.t for r in out.collect()] == [dt.datetime(1900, 1, 1), dt.datetime(2024, 5, 1, 3, 4)]


def test_hash_key_matches_xxhash64_and_is_type_sensitive(spark):
    df = spark.createDataFrame([(1, 1, "1", None)], "l long, i int, s string, n long")
    r = df.select(hash_key("l").alias("l"), hash_key("i").alias("i"), hash_key("s").alias("s"),
                  hash_key("n").alias("n"), F.xxhash64("l").alias("ref")).first()
    assert r.l == r.ref
    assert len({r.l, r.i, r.s}) == 3
    assert r.n == 42


def test_change_hash_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    plain = {r[0] for r in df.select(F.xxhash64("x", "y")).collect()}
    marked = {r[0] for r in df.select(change_hash("x", "y")).collect()}
    assert len(plain) == 1  # xxhash64 skips NULLs: the two rows collide
    assert len(marked) == 2
