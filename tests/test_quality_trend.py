import datetime as dt
import statistics

from pyspark.sql import functions as F

from starloom.operators import quality_trend as qt

D0 = dt.date(2024, 1, 1)


def _history(spark, values):
    return spark.createDataFrame([(D0 + dt.timedelta(days=i), "rows", None, v) for i, v in enumerate(values)],
                                 "run date, metric string, column string, value double")


def test_bounds_are_median_and_deviation_of_the_runs_before(spark):
    values = [100.0, 104.0, 98.0, None, 101.0, 97.0, 150.0, 99.0, 103.0, 40.0]
    rows = sorted(qt.verdicts(_history(spark, values), runs=6, least=4).collect(), key=lambda r: r["run"])
    for i, r in enumerate(rows):
        past = [v for v in values[max(0, i - 6):i] if v is not None]
        assert r["n_before"] == len(past)
        if past:
            med = statistics.median(past)
            mad = statistics.median([abs(v - med) for v in past])
            width = max(qt.TIMES * qt.SCALE * mad, qt.FLOOR * abs(med))
            assert (r["median"], r["mad"]) == (med, mad) and abs(r["low"] - (med - width)) < 1e-9 and abs(r["high"] - (med + width)) < 1e-9
    assert [r["verdict"] for r in rows] == ["unknown"] * 5 + ["ok", "alarm", "ok", "ok", "alarm"]
    assert [rows[6]["reason"], rows[9]["reason"]] == ["above the bound", "below the bound"]


def test_a_run_without_a_value_and_a_metric_that_never_moved(spark):
    rows = sorted(qt.verdicts(_history(spark, [5.0] * 6 + [None, 5.0, 5.04, 5.2]), least=5).collect(), key=lambda r: r["run"])
    assert [(r["verdict"], r["reason"]) for r in rows[6:]] == [("alarm", "no value"), ("ok", "within bounds"), ("ok", "within bounds"), ("alarm", "above the bound")]


def test_metrics_of_every_run_and_none(spark):
    df = spark.createDataFrame([(D0, 1.0, "a"), (D0, None, "b"), (D0, 4.0, None), (dt.date(2024, 1, 2), None, "c")], "d date, x double, s string")
    got = {(r["run"].day, r["metric"], r["column"]): r["value"] for r in qt.metric_history(df, F.col("d"), ["x", "s"], ["x"]).collect()}
    assert got == {(1, "rows", None): 3.0, (1, "null_share", "x"): 1 / 3, (1, "null_share", "s"): 1 / 3, (1, "mean", "x"): 2.5,
                   (2, "rows", None): 1.0, (2, "null_share", "x"): 1.0, (2, "null_share", "s"): 0.0, (2, "mean", "x"): None}
    assert qt.verdicts(qt.metric_history(df.where("false"), F.col("d"), ["x"], ["x"])).count() == 0
