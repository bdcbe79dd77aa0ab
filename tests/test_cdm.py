import datetime as dt
import json
import os

from pyspark.sql import types as T

from starloom.sources.cdm import (build_schema, ingest, read_definition, read_entity, read_manifest)


def _tree(base, folder, entity, attrs, lines, manifest=True, definition=True):
    os.makedirs(f"{base}/{folder}/{entity}", exist_ok=True)
    if manifest:
        with open(f"{base}/{folder}/{folder}.manifest.cdm.json", "w") as fh:
            json.dump({"manifestName": folder, "entities": [{"entityName": entity}]}, fh)
    if definition:
        with open(f"{base}/{folder}/{entity}.cdm.json", "w") as fh:
            json.dump({"definitions": [{"hasAttributes": attrs}]}, fh)
    with open(f"{base}/{folder}/{entity}/a.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")


ALL_TYPES = [{"name": "s", "dataFormat": "String"}, {"name": "i", "dataFormat": "Int32"},
             {"name": "l", "dataFormat": "Int64"}, {"name": "d", "dataFormat": "Double"},
             {"name": "m", "dataFormat": "Decimal"}, {"name": "b", "dataFormat": "Boolean"},
             {"name": "dt", "dataFormat": "Date"}, {"name": "ts", "dataFormat": "DateTime"},
             {"name": "g", "dataFormat": "Guid"}, {"name": "x"},
             {"name": "o", "dataFormat": "DateTimeOffset"}]


def test_schema_from_definition(spark, scratch):
    base = f"{scratch}/cdm1"
    _tree(base, "F", "E", ALL_TYPES, ["s,i,l,d,m,b,dt,ts,g,x,o"])
    es = read_definition(spark, f"{base}/F/E.cdm.json")
    assert [f.dataType.simpleString() for f in es.schema.fields] == [
        "string", "int", "bigint", "double", "double", "boolean", "date", "timestamp", "string",
        "string", "string"]
    assert all(f.nullable for f in es.schema.fields)
    assert es.fallbacks == [("x", None), ("o", "DateTimeOffset")]
    assert read_manifest(spark, f"{base}/F/F.manifest.cdm.json") == ["E"]
    dec = build_schema([("m", "Decimal")], "decimal(38,6)").schema
    assert dec.fields[0].dataType == T.DecimalType(38, 6)


def test_typed_read_and_quarantine(spark, scratch):
    base = f"{scratch}/cdm2"
    attrs = [{"name": "id", "dataFormat": "Int64"}, {"name": "amt", "dataFormat": "Double"},
             {"name": "ts", "dataFormat": "DateTime"}]
    _tree(base, "F", "E", attrs, ["id,amt,ts", "1,2.5,2024-01-01T00:00:00Z", "2,abc,2024-01-01T00:00:00Z",
                                  "3,1.0", "4,1.0,2024-01-01T00:00:00Z,extra"])
    raw = f"{scratch}/cdm2raw"
    rep = {r.entity: r for r in ingest(spark, base, raw, folders=["F"]).collect()}
    assert rep["E"].rows == 1 and rep["E"].bad_rows == 3
    good = spark.read.parquet(f"{raw}/F/E").collect()
    assert [(r.id, r.amt, r.ts) for r in good] == [(1, 2.5, dt.datetime(2024, 1, 1))]
    assert spark.read.parquet(f"{raw}/_quarantine/F/E").count() == 3


def test_header_options(spark, scratch):
    base = f"{scratch}/cdm3"
    attrs = [{"name": "RecordId", "dataFormat": "Int64"}, {"name": "Txt", "dataFormat": "String"}]
    _tree(base, "F", "E", attrs, ["1,a", "2,b"])
    es = read_definition(spark, f"{base}/F/E.cdm.json").schema
    # header-less file read with header=True silently loses its first row
    assert read_entity(spark, f"{base}/F/E", es, header=True).count() == 1
    assert read_entity(spark, f"{base}/F/E", es, header=False).count() == 2
    # a reordered header is ignored: binding is positional
    _tree(base, "G", "E", attrs, ["Txt,RecordId", "1,a"])
    r = read_entity(spark, f"{base}/G/E", es, header=True).first()
    assert r.RecordId == 1 and r.Txt == "a"


def test_failures_are_isolated(spark, scratch):
    base = f"{scratch}/cdm4"
    attrs = [{"name": "id", "dataFormat": "Int64"}]
    _tree(base, "Ok", "E", attrs, ["id", "1"])
    _tree(base, "NoDef", "E", attrs, ["id", "1"], definition=False)
    os.makedirs(f"{base}/NoManifest", exist_ok=True)
    _tree(base, "Empty", "E", attrs, ["id"])
    rep = ingest(spark, base, f"{scratch}/cdm4raw", folders=["Ok", "NoDef", "NoManifest", "Empty"]).collect()
    by = {(r.folder, r.entity): r for r in rep}
    assert by[("Ok", "E")].status == "loaded" and by[("Ok", "E")].rows == 1
    assert by[("NoDef", "E")].status == "failed"
    assert by[("NoManifest", "Manifest Read")].status == "failed"
    assert by[("Empty", "E")].status == "loaded" and by[("Empty", "E")].rows == 0


def test_inferred_and_text_reads(spark, scratch):
    from starloom.sources.cdm import read_text
    base = f"{scratch}/cdm5"
    _tree(base, "F", "E", [{"name": "a"}], ["a,b", "1,x"])
    inf = read_entity(spark, f"{base}/F/E", None, header=True, infer=True)
    assert inf.schema["a"].dataType.simpleString() == "int"
    assert read_text(spark, f"{base}/F/E.cdm.json", whole=True).count() == 1


def test_csv_options_from_manifest_traits(spark, scratch):
    from starloom.sources.cdm import read_manifest_entities
    base = f"{scratch}/cdm6"
    attrs = [{"name": "id", "dataFormat": "Int64"}, {"name": "txt", "dataFormat": "String"}]
    os.makedirs(f"{base}/F/E", exist_ok=True)
    os.makedirs(f"{base}/F/G", exist_ok=True)
    for e in ("E", "G"):
        with open(f"{base}/F/{e}.cdm.json", "w") as fh:
            json.dump({"definitions": [{"hasAttributes": attrs}]}, fh)
    with open(f"{base}/F/E/a.csv", "w") as fh:
        fh.write("1|x\n2|y\n")            # no header, pipe-delimited
    os.makedirs(f"{base}/F/G/2024/01", exist_ok=True)
    with open(f"{base}/F/G/2024/01/a.csv", "w") as fh:
        fh.write("id,txt\n7,z\n")         # nested export folder
    trait = {"traitReference": "is.partition.format.CSV", "arguments": [
        {"name": "columnHeaders", "value": "false"}, {"name": "delimiter", "value": "|"}]}
    with open(f"{base}/F/F.manifest.cdm.json", "w") as fh:
        json.dump({"manifestName": "F", "entities": [
            {"entityName": "E", "dataPartitions": [{"location": "E/a.csv", "exhibitsTraits": [trait]}]},
            {"entityName": "G"}]}, fh)
    ents = read_manifest_entities(spark, f"{base}/F/F.manifest.cdm.json")
    assert ents == [("E", {"header": "false", "delimiter": "|"}), ("G", {})]
    rep = {r.entity: r for r in ingest(spark, base, f"{scratch}/cdm6raw", folders=["F"], recursive=True).collect()}
    assert rep["E"].rows == 2 and rep["E"].bad_rows == 0 and rep["G"].rows == 1
    got = sorted((r.id, r.txt) for r in spark.read.parquet(f"{scratch}/cdm6raw/F/E").collect())
    assert got == [(1, "x"), (2, "y")]
