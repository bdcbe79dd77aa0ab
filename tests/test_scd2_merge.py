import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.history import has_large_key, scd2, scd2_merge

T0 = dt.datetime(2024, 1, 1)
DDL = "k string, ts timestamp, seq int, v string, w int"
KEYS, TRACKED, TIE = ["k"], ["v", "w"], ["seq"]


def _rows(df):
    return sorted((tuple(r) for r in df.select("k", "v", "w", "ValidFrom", "ValidTo", "IsCurrent", "VersionHash", "seq").collect()), key=str)


def _feed(rng, n):
    # few timestamps, so that ties are broken by seq; null keys and values among them
    return [(rng.choice(["hot", "hot", "hot", "a", "b", None]), T0 + dt.timedelta(hours=rng.randrange(30)), i, rng.choice(["x", "y", None]),
             rng.choice([1, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("split", [False, True])
def test_batches_in_any_order_equal_the_rebuild(spark, seed, split):
    rng = random.Random(seed)
    rows = _feed(rng, 90)
    frame = lambda r: spark.createDataFrame(r, DDL)
    rng.shuffle(rows)
    batches = [rows[:40], rows[40:45], rows[45:80], rows[80:]]
    log = frame(batches[0])
    history = scd2(log, KEYS, "ts", TRACKED, TIE, keep_order=True)
    for b in batches[1:]:
        history, log = scd2_merge(history, log, frame(b), KEYS, "ts", TRACKED, TIE, split_keys=split)
        history, log = history.checkpoint(), log.checkpoint()
    assert _rows(history) == _rows(scd2(frame(rows), KEYS, "ts", TRACKED, TIE, keep_order=True))
    assert log.count() == 90


def test_a_batch_delivered_twice_changes_nothing(spark):
    rows = _feed(random.Random(9), 40)
    frame = lambda r: spark.createDataFrame(r, DDL)
    history, log = scd2(frame(rows[:20]), KEYS, "ts", TRACKED, TIE, keep_order=True), frame(rows[:20])
    for b in (rows[20:], rows[20:], rows[5:25]):
        history, log = scd2_merge(history, log, frame(b), KEYS, "ts", TRACKED, TIE)
        history, log = history.checkpoint(), log.checkpoint()
    assert log.count() == 40 and _rows(history) == _rows(scd2(frame(rows), KEYS, "ts", TRACKED, TIE, keep_order=True))


def test_first_load_and_empty_batch(spark):
    none = spark.createDataFrame([], DDL)
    rows = spark.createDataFrame(_feed(random.Random(2), 15), DDL)
    empty = scd2(none, KEYS, "ts", TRACKED, TIE, keep_order=True)
    history, log = scd2_merge(empty, none, rows, KEYS, "ts", TRACKED, TIE)
    want = _rows(scd2(rows, KEYS, "ts", TRACKED, TIE, keep_order=True))
    assert _rows(history) == want
    again, _ = scd2_merge(history.checkpoint(), log.checkpoint(), none, KEYS, "ts", TRACKED, TIE)
    assert _rows(again) == want


def test_the_largest_key_decides_how_versions_are_worked_out(spark, monkeypatch):
    from starloom.operators import history
    df = spark.createDataFrame(_feed(random.Random(3), 80), DDL)
    plain = _rows(scd2(df, KEYS, "ts", TRACKED, TIE, keep_order=True))
    assert not has_large_key(df, KEYS) and has_large_key(df, KEYS, 20) and not has_large_key(df.where(F.lit(False)), KEYS)
    calls = []
    real = history.neighbor_in_key
    monkeypatch.setattr(history, "neighbor_in_key", lambda *a, **k: calls.append(1) or real(*a, **k))
    monkeypatch.setattr(history, "has_large_key", lambda df, keys: True)
    assert _rows(scd2(df, KEYS, "ts", TRACKED, TIE, keep_order=True)) == plain and len(calls) == 2
