import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from nested_joins import interval_join_nested

from starloom.operators.range_join import choose_unit, interval_join

D = dt.date


def _rows(df):
    return sorted((tuple("" if v is None else str(v) for v in r) for r in df.collect()))


def _periods(spark):
    # adjacent, gap, overlapping, inverted, NULL bound
    return spark.createDataFrame([
        (1, "P1", D(2024, 1, 1), D(2024, 1, 31)),
        (2, "P2", D(2024, 2, 1), D(2024, 2, 29)),      # adjacent to P1
        (3, "P3", D(2024, 3, 10), D(2024, 3, 20)),     # gap before
        (4, "P4", D(2024, 3, 15), D(2024, 4, 5)),      # overlaps P3
        (5, "P5", D(2024, 6, 10), D(2024, 6, 1)),      # inverted: never matches
        (6, "P6", None, D(2024, 7, 1)),                # NULL bound: never matches
    ], "pid int, name string, s date, e date")


def _points(spark):
    return spark.createDataFrame([
        (dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 1, 31, 0, 0),),
        (dt.datetime(2024, 1, 31, 10, 0),),           # after the end-day midnight: no P1
        (dt.datetime(2024, 2, 29, 0, 0),), (dt.datetime(2024, 3, 5, 0, 0),),
        (dt.datetime(2024, 3, 16, 0, 0),), (dt.datetime(2024, 6, 5, 0, 0),),
        (dt.datetime(2024, 6, 30, 0, 0),), (None,),
    ], "ts timestamp")


def test_interval_join_equals_nested_left(spark):
    p, q = _points(spark), _periods(spark)
    ref = interval_join_nested(p, q, "ts", "s", "e", "left")
    for unit in (None, "day", "month", "year"):
        got = interval_join(p, q, "ts", "s", "e", "left", unit=unit)
        assert _rows(got) == _rows(ref), unit
    assert got.count() == 10  # 9 points, one inside two overlapping periods


def test_interval_join_inner(spark):
    p, q = _points(spark), _periods(spark)
    assert _rows(interval_join(p, q, "ts", "s", "e", "inner")) == _rows(
        interval_join_nested(p, q, "ts", "s", "e", "inner"))


def test_interval_join_plan_is_equi_hash_join(spark):
    p, q = _points(spark), _periods(spark)
    plan = interval_join(p, q, "ts", "s", "e", "left")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "HashJoin" in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(-5, 40)), min_size=0, max_size=6),
       st.lists(st.integers(-3, 100), min_size=1, max_size=8))
def test_interval_join_property(spark, ivals, pts):
    base = D(2024, 1, 1)
    q = spark.createDataFrame([(i, base + dt.timedelta(days=a), base + dt.timedelta(days=a + b))
                               for i, (a, b) in enumerate(ivals)], "pid int, s date, e date")
    p = spark.createDataFrame([(base + dt.timedelta(days=x),) for x in pts], "d date")
    assert _rows(interval_join(p, q, "d", "s", "e", "left")) == _rows(
        interval_join_nested(p, q, "d", "s", "e", "left"))


def test_open_ended_periods_are_clamped_to_the_points(spark):
    p = _points(spark)
    q = spark.createDataFrame([(i, D(2024, 1, 1) + dt.timedelta(days=i), D(9999, 12, 31)) for i in range(400)],
                              "pid int, s date, e date")
    got = interval_join(p, q, "ts", "s", "e", "left")
    assert _rows(got) == _rows(interval_join_nested(p, q, "ts", "s", "e", "left"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_inverted_spans_add_nothing_to_the_bound_and_a_given_unit_is_checked(spark):
    q = spark.createDataFrame([(D(2024, 12, 31), D(2024, 1, 1))] * 30 + [(D(2024, 1, 1), D(2024, 1, 20))], "s date, e date")
    assert choose_unit(q, "s", "e", 19) == ("month", True)
    assert choose_unit(q, "s", "e", 20) == ("day", True)
    assert choose_unit(q, "s", "e", 19, "day") == ("day", False)
    assert choose_unit(q, "s", "e", 0) == ("day", False)


def test_interval_join_salted_fallback(spark):
    p, q = _points(spark), _periods(spark)
    got = interval_join(p, q, "ts", "s", "e", "left", max_rows=0, rows_per_task=1 / 200)
    assert _rows(got) == _rows(interval_join_nested(p, q, "ts", "s", "e", "left"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__ps" in plan and "__is" in plan  # the shuffle path joins on (bucket, salt)
