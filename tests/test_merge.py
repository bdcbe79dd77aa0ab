import pytest

from starloom.operators.merge import Merge

T, S = "k int, a string, n int", "k int, a string, n int"


def _merge(spark, t, s):
    return Merge(spark.createDataFrame(t, T), spark.createDataFrame(s, S), ["k"])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_kind_of_clause(spark):
    t = [(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4), (5, "e", 5), (6, "f", 6)]
    s = [(1, "A", 10), (2, "B", -1), (3, "C", 0), (7, "G", 7), (8, "H", 0)]
    m = (_merge(spark, t, s).when_matched_delete("s.n < 0").when_matched_update(condition="s.n > t.n")
         .when_not_matched_insert({"a": "lower(s.a)"}, "s.n > 0")
         .when_not_matched_by_source_delete("t.k = 4").when_not_matched_by_source_update({"n": "t.n * 100"}, "t.k = 5"))
    assert _rows(m.result()) == [(1, "A", 10), (3, "c", 3), (5, "e", 500), (6, "f", 6), (7, "g", None)]
    assert {(r["k"], r["action"]) for r in m.actions().collect()} == {
        (1, "update"), (2, "delete"), (3, "keep"), (4, "delete"), (5, "update"), (6, "keep"), (7, "insert"), (8, "ignore")}


def test_first_clause_that_holds_decides_and_null_conditions_do_not_hold(spark):
    m = (_merge(spark, [(1, "a", 1), (2, "b", 1)], [(1, "x", None), (2, "y", 5)])
         .when_matched_update({"a": "'first'"}, "s.n = 5").when_matched_update({"a": "'second'"}))
    assert _rows(m.result()) == [(1, "second", 1), (2, "first", 1)]


def test_null_keys_match_and_empty_sides(spark):
    full = lambda t, s: _merge(spark, t, s).when_matched_update().when_not_matched_insert().when_not_matched_by_source_delete()
    assert _rows(full([(None, "a", 1)], [(None, "b", 2)]).result()) == [(None, "b", 2)]
    assert _rows(full([], [(1, "b", 2)]).result()) == [(1, "b", 2)]
    assert _rows(full([(1, "a", 1)], []).result()) == []
    assert _rows(full([], []).result()) == []


@pytest.mark.parametrize(("t", "s"), [([(1, "a", 1)], [(1, "x", 1), (1, "y", 2)]), ([(1, "a", 1), (1, "b", 1)], [(1, "x", 1)]),
                                      ([], [(None, "x", 1), (None, "y", 2)])])
def test_a_key_held_twice_is_refused(spark, t, s):
    with pytest.raises(Exception, match="more than one row of the key"):
        _merge(spark, t, s).when_matched_update().when_not_matched_insert().result().collect()


def test_other_columns_types_and_mistakes(spark):
    target = spark.createDataFrame([(1, "a", 1)], T)
    source = spark.createDataFrame([(1, 9.0, "z"), (2, 8.0, "y")], "K int, price double, A string")
    out = Merge(target, source, ["k"]).when_matched_update().when_not_matched_insert({"n": "s.price + 0.5"}).result()
    assert out.schema.simpleString() == target.schema.simpleString()
    assert _rows(out) == [(1, "z", 1), (2, None, 8)]
    with pytest.raises(ValueError, match="no columns"):
        Merge(target, source, ["k"]).when_matched_update({"price": "1"})
    with pytest.raises(ValueError, match="key"):
        Merge(target, source, ["k"]).when_matched_update({"K": "1"})


def test_one_shuffle(spark):
    plan = _merge(spark, [(1, "a", 1)], [(1, "b", 2)]).when_matched_update().result()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
