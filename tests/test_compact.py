import os

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from starloom.sources import compact


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _table(spark, path):
    df = spark.range(6000).selectExpr("id", "cast(id % 2 as int) p", "cast(rand(3) as string) s")
    df.where("id < 3000").repartition(1).write.partitionBy("p").parquet(path)  # one larger file in each folder
    df.where("id >= 3000").repartition(6).write.mode("append").partitionBy("p").parquet(path)
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_small_files_become_few_and_the_others_stay(spark, scratch):
    path = f"{scratch}/compact1"
    rows = _table(spark, path)
    was = _files(path)
    sizes = sorted(os.path.getsize(f) for f in was)
    large = {f for f in was if os.path.getsize(f) > sizes[-3]}
    target = 2 * sizes[-3] + 1  # small: under this size, which only the two larger files reach
    n = compact.compact(spark, path, target=target)
    now = _files(path)
    assert 10 <= n <= 12 and large <= now.keys() and all(was[f] == now[f] for f in large)
    assert len(now) < len(was) and len(now.keys() & was.keys()) == 14 - n  # a small file without a neighbour in its bin stays, too
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == rows
    assert {os.path.basename(os.path.dirname(f)) for f in now} == {"p=0", "p=1"} and not os.path.exists(f"{path}/{compact.WORK}")


def test_bins_fill_to_the_target_and_lone_files_stay(spark, scratch):
    path = f"{scratch}/compact2"
    spark.range(100).repartition(1).write.parquet(path)
    assert compact.compact(spark, path) == 0
    for _ in range(4):
        spark.range(100).repartition(1).write.mode("append").parquet(path)
    size = max(os.path.getsize(f) for f in _files(path))
    plan = compact.plan(spark, path, target=2 * size, small=0.9).collect()
    by = {}
    for r in plan:
        by.setdefault(r["bin"], []).append(r["size"])
    assert len(plan) == 4 and [len(x) for x in by.values()] == [2, 2]


def test_a_bin_is_rewritten_without_shuffle_or_sort(spark, scratch, monkeypatch):
    path = f"{scratch}/compact3"
    rows = _table(spark, path)
    real, plans = DataFrameWriter.parquet, []

    def parquet(self, to, *args, **kw):
        if f"{compact.WORK}/new" in to:
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
            assert self._df.rdd.getNumPartitions() == 1
        return real(self, to, *args, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    target = 3 * min(os.path.getsize(f) for f in _files(path))
    bins = {r["bin"] for r in compact.plan(spark, path, target=target, small=0.9).collect()}
    compact.compact(spark, path, target=target, small=0.9)
    assert len(plans) == len(bins) > 2 and not [p for p in plans if "Exchange" in p or "Sort" in p or "Join" in p]
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == rows


@pytest.mark.parametrize("after", ["new", "plan", "some"])
def test_a_compaction_cut_short_is_ended_or_undone(spark, scratch, monkeypatch, after):
    path = f"{scratch}/compact_{after}"
    rows = _table(spark, path)
    real, calls = compact.recover, []

    def recover(s, p):
        calls.append(1)
        if len(calls) == 1:
            return real(s, p)
        raise RuntimeError("lost")
    monkeypatch.setattr(compact, "recover", recover)
    with pytest.raises(RuntimeError):
        compact.compact(spark, path)
    monkeypatch.setattr(compact, "recover", real)
    before = len(_files(path)) - len(_files(f"{path}/{compact.WORK}"))
    if after == "new":
        os.remove(f"{path}/{compact.WORK}/plan/_SUCCESS")
    if after == "some":
        os.remove(spark.read.parquet(f"{path}/{compact.WORK}/plan").first()["path"].removeprefix("file:"))
    compact.recover(spark, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == rows
    assert (len(_files(path)) == before) == (after == "new")
