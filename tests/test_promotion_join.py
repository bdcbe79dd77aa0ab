import datetime as dt

import pytest
from nested_joins import promotion_join_nested
from pyspark.sql import functions as F

from starloom.operators.conditional_join import promotion_join, with_volume_bands

T = dt.datetime


def _rows(df):
    return sorted((tuple("" if v is None else str(v) for v in r) for r in df.collect()))


def _promos(spark):
    p = spark.createDataFrame([
        (1, "Volume Discount 11 to 20", T(2023, 1, 1), T(2023, 1, 10)),
        (2, "Volume Discount 21 to 40", T(2023, 1, 5), T(2023, 1, 31)),  # overlaps 1 in January
        (3, "Volume Discount 41 to 60", None, None),
        (4, "Volume Discount > 60", T(2022, 12, 20), T(2023, 1, 3)),
        (5, "New Year Sale", T(2023, 1, 8), T(2023, 1, 12)),            # unknown name: no band
        (6, "Backwards", T(2023, 1, 20), T(2023, 1, 2)),                 # inverted window
    ], "PromotionId int, PromotionName string, ValidFrom timestamp, ValidTo timestamp")
    return with_volume_bands(p)


def _lines(spark):
    rows = [
        (1, T(2023, 1, 15), 5.0),    # in window 2 only
        (2, T(2023, 1, 9), 5.0),     # in windows 1, 2 and 5
        (3, T(2023, 1, 25), 15.0),   # January: quantity ignored, window 2
        (4, T(2024, 1, 15), 15.0),   # January of another year: no window
        (5, T(2023, 1, 10), 1.0),    # end day of window 1 at midnight: inside
        (6, T(2023, 1, 10, 10), 1.0),  # end day at 10:00: outside window 1
        (7, None, 15.0),             # NULL date: quantity band 11-20
        (8, None, None),             # NULL date and qty: nothing
    ]
    qtys = [10, 11, 20, 21, 40, 41, 60, 61, 100000]
    rows += [(100 + i, T(2023, 5, 1), float(q)) for i, q in enumerate(qtys)]
    rows += [(200, T(2023, 5, 1), None)]
    return spark.createDataFrame(rows, "line int, BookDate timestamp, Qty double")


def test_promotion_join_equals_case_join(spark):
    lines, promos = _lines(spark), _promos(spark)
    ref = promotion_join_nested(lines, promos)
    got = promotion_join(lines, promos)
    assert _rows(got) == _rows(ref)
    pairs = {(r.line, r.PromotionId) for r in got.select("line", "PromotionId").collect()}
    assert {(2, 1), (2, 2), (2, 5)} <= pairs
    assert (5, 1) in pairs and (6, 1) not in pairs
    assert (7, 1) in pairs and (8, None) in pairs
    band = {ln: pid for ln, pid in pairs if ln >= 100}
    assert band[100] is None and band[101] == 1 and band[102] == 1 and band[103] == 2
    assert band[105] == 3 and band[107] == 4 and band[108] == 4 and band[200] is None


def test_promotion_join_coarse_keys(spark):
    lines, promos = _lines(spark), _promos(spark)
    ref = _rows(promotion_join_nested(lines, promos))
    assert _rows(promotion_join(lines, promos, max_rows=30)) == ref  # year keys, broadcast
    got = promotion_join(lines, promos, max_rows=1, rows_per_task=1)  # day keys, salted, no broadcast
    assert _rows(got) == ref
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__lsalt" in plan and "NestedLoop" not in plan


def test_bands_other_than_the_fixed_ones_are_refused(spark):
    other = _promos(spark).withColumn("VolumeEnd", F.col("VolumeEnd") + 1)
    with pytest.raises(ValueError, match="volume band"):
        promotion_join(_lines(spark), other)


def test_promotion_join_plan_has_no_nested_loop(spark):
    plan = promotion_join(_lines(spark), _promos(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
