import datetime
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starloom.operators import zorder


def test_rank_is_the_number_of_bounds_at_or_below(spark):
    for bounds in ([], [3], [1, 4, 4.5, 9]):
        df = spark.createDataFrame([(None,), (-1.0,), (1.0,), (4.0,), (4.2,), (9.0,), (10.0,)], "x double")
        got = [r[0] for r in df.select(zorder.rank(F.col("x"), bounds)).collect()]
        assert got == [0, *[sum(b <= x for b in bounds) for x in (-1, 1, 4, 4.2, 9, 10)]]


def test_interleave(spark):
    df = spark.createDataFrame([(a, b, c) for a in range(8) for b in range(8) for c in (0, 5)], "a long, b long, c long")
    for r in df.select("*", zorder.interleave([F.col("a"), F.col("b"), F.col("c")], 3).alias("z")).collect():
        want = sum(((v >> i) & 1) << (3 * i + j) for i in range(3) for j, v in enumerate((r["a"], r["b"], r["c"])))
        assert r["z"] == want
    with pytest.raises(ValueError):
        zorder.interleave([F.lit(1)] * 8, 8)


def test_bounds_share_skewed_and_repeated_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id")).cast("int").alias("x"), F.lit(None).cast("date").alias("d"))
    b = zorder.quantile_bounds(df, ["x", "d"], bits=4)
    assert b["x"][0] == 7 and len(b["x"]) == len(set(b["x"])) < 16 and b["d"] == []
    with pytest.raises(TypeError):
        zorder.quantile_bounds(df.select(F.lit("a").alias("s")), ["s"])


def test_a_filter_on_either_column_skips_most_files(spark, scratch):
    df = spark.range(40_000).select(F.col("id"), ((F.col("id") * 7919) % 40_009).alias("x"),
                                    F.expr("timestamp '2024-01-01' + make_dt_interval(0, 0, 0, (id * 104729) % 86400)").alias("t"))
    path = f"{scratch}/zorder"
    zorder.write_zordered(df, path, ["x", "t"], files=16)
    assert spark.read.parquet(path).count() == 40_000
    stats = []
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            cols = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics for i in range(meta.num_columns)}
            stats.append((cols["x"].min, cols["x"].max, cols["t"].min, cols["t"].max))
    assert len(stats) >= 12
    x = 20_000
    assert sum(a <= x <= b for a, b, *_ in stats) <= len(stats) // 2
    t = datetime.datetime(2024, 1, 1, 12, tzinfo=stats[0][2].tzinfo)
    assert sum(a <= t <= b for *_, a, b in stats) <= len(stats) // 2
