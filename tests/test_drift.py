import json
import os

import pytest
from pyspark.sql import types as T

from starloom.sources import drift
from starloom.sources.cdm import build_schema, ingest, ingest_entity

ATTRS = [("Id", "Int32"), ("Name", "String"), ("City", "String"), ("Amount", "Int32"), ("Day", "Date")]


def _tree(base, attrs, files, entity="E"):
    os.makedirs(f"{base}/F/{entity}", exist_ok=True)
    with open(f"{base}/F/F.manifest.cdm.json", "w") as fh:
        json.dump({"entities": [{"entityName": entity}]}, fh)
    with open(f"{base}/F/{entity}.cdm.json", "w") as fh:
        json.dump({"definitions": [{"hasAttributes": [{"name": n, "dataFormat": f} for n, f in attrs]}]}, fh)
    for name, lines in files.items():
        with open(f"{base}/F/{entity}/{name}.csv", "w", encoding="utf-8") as fh:
            fh.write("".join(x + "\n" for x in lines))


def _load(spark, scratch, name, attrs, files):
    base, raw = f"{scratch}/{name}", f"{scratch}/{name}_raw"
    _tree(base, attrs, files)
    res = ingest_entity(spark, base, "F", "E", raw, by_header=True)
    return res, spark.read.parquet(f"{raw}/F/E")


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_a_header_in_another_order_is_refused_whichever_file_has_it(spark, scratch):
    """Files are bound by position here, so each one's header must be the definition's."""
    base = f"{scratch}/drift_strict"
    _tree(base, ATTRS[:3], {"a": ["Id,Name,City", "1,Ann,Bonn"], "b": ["Id,City,Name", "2,Rome,Bob"]})
    with pytest.raises(ValueError, match="header of .*b.csv"):
        ingest_entity(spark, base, "F", "E", f"{scratch}/drift_strict_raw")


def test_columns_land_by_name(spark, scratch):
    res, df = _load(spark, scratch, "drift_names", ATTRS[:3], {
        "a": ["Id,Name,City", "1,Ann,Bonn"], "b": ["City,id, NAME ", "Rome,2,Bob"], "c": ["Name,Id,Phone", "Cid,3,55"], "d": [], "e": ["﻿Id,Name,City", "4,Dan,Oslo"]})
    assert _rows(df, "Id", "Name", "City", "Phone") == [(1, "Ann", "Bonn", None), (2, "Bob", "Rome", None), (3, "Cid", None, "55"), (4, "Dan", "Oslo", None)]
    assert res.rows == 4 and res.bad_rows == 0
    assert "City missing in 1 files" in res.drift and "Phone added in 1 files" in res.drift and "Id reordered in 2 files" in res.drift


def test_types_widen_as_far_as_a_row_asks(spark, scratch):
    res, df = _load(spark, scratch, "drift_types", ATTRS, {
        "a": ["Id,Name,City,Amount,Day", "1,x,y,5,2024-01-01", "2,x,y,6,2024-01-02"],
        "b": ["Id,Name,City,Amount,Day", "5000000000,x,y,7.25,2024-01-03T10:00:00"]})
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert (kinds["Id"], kinds["Amount"], kinds["Day"]) == ("bigint", "double", "timestamp") and res.bad_rows == 0
    assert sorted(r["Id"] for r in df.collect()) == [1, 2, 5000000000] and sorted(r["Amount"] for r in df.collect()) == [5.0, 6.0, 7.25]
    assert "Amount widened int -> double in 2 files" in res.drift


def test_a_garbled_cell_is_quarantined_and_a_column_of_text_is_text(spark, scratch):
    head = "Id,Name,City,Amount,Day"
    res, df = _load(spark, scratch, "drift_text", ATTRS, {
        "a": [head, *[f"{i},x,y,{i},2024-01-01" for i in range(8)], "9,x,y,oops,2024-01-01", "10,x,y"],
        "b": ["Day,Id,Name,City,Amount", "Q1,20,x,y,1", "Q2,21,x,y,2", "2024-01-05,22,x,y,3"]})
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds["Amount"] == "int" and kinds["Day"] == "string"
    assert (res.rows, res.bad_rows) == (11, 2)
    assert sorted(r["Day"] for r in df.where("Id >= 20").collect()) == ["2024-01-05", "Q1", "Q2"]


def test_integers_that_a_double_would_bend_become_text(spark, scratch):
    _, df = _load(spark, scratch, "drift_exact", [("k", "Int32"), ("v", "Int64")], {"a": ["k,v", "1,9007199254740993"], "b": ["k,v", "2,0.5"]})
    assert _rows(df, "k", "v") == [(1, "9007199254740993"), (2, "0.5")]


def test_quoted_headers_delimiters_and_repeated_names(spark, scratch):
    base = f"{scratch}/drift_quoted"
    _tree(base, [("Id", "Int32"), ("Full, name", "String")], {"a": ['"Full, name";Id', '"Ann; Ba";1']})
    found = drift.layouts(spark, f"{base}/F/E", {"delimiter": ";"})
    schema = build_schema([("Id", "Int32"), ("Full, name", "String")]).schema
    df = drift.read_by_header(spark, found, drift.full_schema(found, schema), {"delimiter": ";"})
    assert _rows(df, "Id", "`Full, name`") == [(1, "Ann; Ba")]
    _tree(f"{scratch}/drift_twice", [("Id", "Int32")], {"a": ["Id,id", "1,2"]})
    with pytest.raises(ValueError, match="repeats"):
        drift.layouts(spark, f"{scratch}/drift_twice/F/E")


def test_no_files_only_headers_and_the_report(spark, scratch):
    base = f"{scratch}/drift_report"
    _tree(base, ATTRS[:2], {"a": ["Name,Id"], "b": []})
    rep = ingest(spark, base, f"{scratch}/drift_report_raw", folders=["F"]).collect()
    assert [(r["status"], r["rows"], r["drift"]) for r in rep] == [("loaded", 0, "Name reordered in 1 files; Id reordered in 1 files")]
    assert spark.read.parquet(f"{scratch}/drift_report_raw/F/E").count() == 0
    assert drift.read_by_header(spark, [], T.StructType([T.StructField("a", T.IntegerType())]), {}).columns == ["a", "_corrupt_record"]
