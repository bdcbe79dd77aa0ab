import json
import os
import time

import pytest

from starloom.sources import ledger


def _define(base, attrs):
    os.makedirs(f"{base}/F/E", exist_ok=True)
    with open(f"{base}/F/E.cdm.json", "w") as fh:
        json.dump({"definitions": [{"hasAttributes": [{"name": n, "dataFormat": f} for n, f in attrs]}]}, fh)


def _put(base, name, lines, when=None):
    path = f"{base}/F/E/{name}"
    with open(path, "w") as fh:
        fh.write("".join(x + "\n" for x in lines))
    t = when or time.time()
    os.utime(path, (t, t))


def _run(spark, base, raw):
    rows = ledger.ingest_changed(spark, base, "F", "E", raw).collect()
    return {os.path.basename(r["path"]): r["action"] for r in rows}


def _rows(spark, raw):
    return sorted((r["k"], r["v"]) for r in ledger.read_valid(spark, raw, "F", "E").collect())


def _files(raw):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{raw}/F/E") for f in fs if f.endswith(".parquet")}


def test_only_new_and_changed_files_are_loaded(spark, scratch):
    base, raw = f"{scratch}/led1", f"{scratch}/led1_raw"
    _define(base, [("k", "Int32"), ("v", "String")])
    _put(base, "a.csv", ["k,v", "1,a", "2,b"], 1000)
    _put(base, "b.csv", ["v,k", "c,3"], 1000)
    _put(base, "c.csv", ["k,v", "4,d"], 1000)
    _put(base, "t.csv", ["k,v", "9,t"], 1000)
    assert set(_run(spark, base, raw).values()) == {"new"}
    assert _rows(spark, raw) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (9, "t")]
    was = _files(raw)
    assert set(_run(spark, base, raw).values()) == {"same"} and _files(raw) == was
    _put(base, "b.csv", ["v,k", "C,3", "D,5"], 2000)  # changed
    _put(base, "t.csv", ["k,v", "9,t"], 2000)  # written again with the same lines
    os.remove(f"{base}/F/E/c.csv")
    _put(base, "n.csv", ["k,v", "7,n", "x,y"], 2000)
    assert _run(spark, base, raw) == {"a.csv": "same", "b.csv": "changed", "t.csv": "touched", "c.csv": "removed", "n.csv": "new"}
    assert _rows(spark, raw) == [(1, "a"), (2, "b"), (3, "C"), (5, "D"), (7, "n"), (9, "t")]
    kept = {f: t for f, t in _files(raw).items() if f in was}
    assert len(kept) == 2 and all(was[f] == t for f, t in kept.items())  # the files of a.csv and t.csv
    assert [r["_corrupt_record"] for r in ledger.read_rejected(spark, raw, "F", "E").collect()] == ["x,y"]
    runs = {os.path.basename(r["path"]): r["run"] for r in ledger.read_ledger(spark, raw, "F", "E").collect()}
    assert runs == {"a.csv": 1, "b.csv": 3, "t.csv": 1, "n.csv": 3}
    _put(base, "n.csv", ["k,v", "7,n"], 3000)  # its rejected row goes, too
    assert _run(spark, base, raw)["n.csv"] == "changed"
    rejected = ledger.read_rejected(spark, raw, "F", "E") if os.path.exists(ledger.raw_path(raw, "F", "E", True)) and any(
        f.endswith(".parquet") for _, _, fs in os.walk(ledger.raw_path(raw, "F", "E", True)) for f in fs) else None
    assert rejected is None or rejected.count() == 0


def test_a_crash_before_the_ledger_is_mended_by_the_next_run(spark, scratch, monkeypatch):
    base, raw = f"{scratch}/led2", f"{scratch}/led2_raw"
    _define(base, [("k", "Int32"), ("v", "String")])
    _put(base, "a.csv", ["k,v", "1,a"], 1000)
    _run(spark, base, raw)
    _put(base, "a.csv", ["k,v", "1,A"], 2000)
    _put(base, "b.csv", ["k,v", "2,b"], 2000)
    real = ledger._ledger_path
    state = {"n": 0}

    def path(*a):
        state["n"] += 1
        if state["n"] == 1:
            return "nowhere://x"  # the run's own book: the write of the ledger fails
        return real(*a)
    monkeypatch.setattr(ledger, "_ledger_path", path)
    with pytest.raises(Exception):  # noqa: B017
        _run(spark, base, raw)
    monkeypatch.setattr(ledger, "_ledger_path", real)
    assert _run(spark, base, raw) == {"a.csv": "changed", "b.csv": "new"}
    assert _rows(spark, raw) == [(1, "A"), (2, "b")]


def test_new_columns_and_wider_types_load_everything_again(spark, scratch):
    base, raw = f"{scratch}/led3", f"{scratch}/led3_raw"
    _define(base, [("k", "Int32"), ("v", "Int32")])
    _put(base, "a.csv", ["k,v", "1,10"], 1000)
    _run(spark, base, raw)
    _put(base, "b.csv", ["v,k,w", "2.5,2,new"], 1000)
    assert _run(spark, base, raw) == {"a.csv": "reloaded", "b.csv": "new"}
    got = ledger.read_valid(spark, raw, "F", "E")
    assert sorted((r["k"], r["v"], r["w"]) for r in got.collect()) == [(1, 10.0, None), (2, 2.5, "new")]
    _put(base, "c.csv", ["k,v", "3,7"], 1000)  # fits the wider table: nothing else is read again
    assert _run(spark, base, raw) == {"a.csv": "same", "b.csv": "same", "c.csv": "new"}
    assert ledger.read_valid(spark, raw, "F", "E").count() == 3


def test_no_files_then_some_then_none(spark, scratch):
    base, raw = f"{scratch}/led4", f"{scratch}/led4_raw"
    _define(base, [("k", "Int32"), ("v", "String")])
    assert _run(spark, base, raw) == {}
    _put(base, "a.csv", ["k,v"], 1000)
    _put(base, "z.csv", [], 1000)
    assert _run(spark, base, raw) == {"a.csv": "new"}
    os.remove(f"{base}/F/E/a.csv")
    os.remove(f"{base}/F/E/z.csv")
    assert set(_run(spark, base, raw).values()) == {"removed"} and _run(spark, base, raw) == {}
