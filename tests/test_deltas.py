import random
from decimal import Decimal

import pytest

from starloom.operators.deltas import DeltaMart, between, signed

MART = DeltaMart(("g", "h"), {"total": "x", "dec": "cast(x as decimal(10,2))"}, {"lo": "x"}, {"hi": "x"})
DDL = "id int, g string, h int, x int"


def _rows(df):
    return sorted((tuple(r) for r in df.select(*MART.columns).collect()), key=str)


def _check(spark, before, came, went):
    left = list(before)
    for r in went:
        left.remove(r)
    after = left + came
    frame = lambda rows: spark.createDataFrame(rows, DDL)
    mart = MART.build(frame(before))
    got = MART.apply(mart, signed(frame(came), frame(went)), frame(after))
    assert _rows(got) == _rows(MART.build(frame(after)))
    return MART.merged(mart, signed(frame(came), frame(went)))


@pytest.mark.parametrize("seed", range(3))
def test_mart_after_changes_is_the_mart_from_scratch(spark, seed):
    rng = random.Random(seed)
    row = lambda i: (i, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, *range(-5, 6)]))
    before = [row(i) for i in range(60)]
    went = rng.sample(before, 25)
    came = [row(100 + i) for i in range(15)]
    _check(spark, before, came, went)


def test_only_groups_whose_extreme_went_are_read_again(spark):
    before = [(i, g, 1, x) for i, (g, x) in enumerate([("a", 1), ("a", 5), ("a", 9), ("b", 1), ("b", 5), ("b", 9), ("c", 3)])]
    m = _check(spark, before, [(50, "b", 1, 12), (51, "d", 1, 1)], [(2, "a", 1, 9), (4, "b", 1, 5), (6, "c", 1, 3)])
    assert {r["g"]: r["reread"] for r in m.collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_empty_marts_groups_that_go_and_exact_decimals(spark):
    _check(spark, [], [(1, "a", 1, 7)], [])
    m = _check(spark, [(1, "a", 1, 7)], [], [(1, "a", 1, 7)])
    assert [(r["rows"], r["dec"]) for r in m.collect()] == [(0, Decimal("0.00"))]
    with pytest.raises(ValueError):
        signed()


def test_without_extremes_the_base_is_not_read(spark):
    mart = DeltaMart(("g",), {"total": "x"}, {}, {})
    frame = lambda rows: spark.createDataFrame(rows, DDL)
    got = mart.apply(mart.build(frame([(1, "a", 1, 7)])), signed(frame([(2, "a", 1, 3)])), frame([]))
    assert [tuple(r) for r in got.collect()] == [("a", 2, 10)]


def test_changes_between_two_versions_with_repeated_rows_and_nulls(spark):
    frame = lambda rows: spark.createDataFrame(rows, DDL)
    before = [(1, "a", 1, 5)] * 3 + [(2, None, 2, None), (3, "b", None, 1)]
    after = [(1, "a", 1, 5)] + [(2, None, 2, None), (4, "b", None, 9), (4, "b", None, 9)]
    d = between(frame(before), frame(after))
    assert sorted((r["id"], r["_sign"]) for r in d.collect()) == [(1, -2), (3, -1), (4, 2)]
    assert _rows(MART.apply(MART.build(frame(before)), d, frame(after))) == _rows(MART.build(frame(after)))


def test_a_stored_mart_is_built_once_and_then_refreshed(spark):
    from starloom.plans.gold import refresh_mart
    from starloom.sources.catalog import Catalog
    cat, frame = Catalog(spark), lambda rows: spark.createDataFrame(rows, DDL)
    v1, v2 = [(1, "a", 1, 5), (2, "a", 1, 9), (3, "b", 2, 1)], [(1, "a", 1, 5), (3, "b", 2, 4), (4, "c", 3, 3)]
    none = between(frame(v1), frame(v1))
    assert refresh_mart(cat, MART, "delta_test", frame(v1), none) == "built"
    assert refresh_mart(cat, MART, "delta_test", frame(v2), between(frame(v1), frame(v2))) == "refreshed"
    assert _rows(cat.read("gold", "delta_test")) == _rows(MART.build(frame(v2)))
    cat.drop_if_exists("gold", "delta_test")
