"""Exports whose files differ: binding by header, and types that widen.

Files of one entity may name their columns in another order, lack some or have
new ones. ``layouts`` groups the files by their first line; each group is read
by its own header and its columns bound to the definition by name, so no value
lands in another column. New columns are kept as STRING.

A column may outgrow its declared type. Where rows did not fit, ``needed``
reads the cells as text once and finds the types that would hold them, on the
lattice

    int -> long -> double -> string      date -> timestamp -> string
    boolean -> string                    decimal -> string

A number widens as far as any row asks. To STRING a column only goes if more
than ``STRING_SHARE`` of a layout's rows do not fit any other type: single
garbled cells stay in the quarantine.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
#: Share of a layout's rows from which a column of other types becomes a STRING.
STRING_SHARE = 0.5
#: Doubles hold integers exactly up to here.
EXACT = 1 << 53

_LATTICE = {
    "int": ["int", "bigint", "double", "string"],
    "bigint": ["bigint", "double", "string"],
    "double": ["double", "string"],
    "date": ["date", "timestamp", "string"],
    "timestamp": ["timestamp", "string"],
    "boolean": ["boolean", "string"],
}


def chain(kind: T.DataType) -> list[str]:
    """The types that a column of ``kind`` can widen to, itself first."""
    name = kind.simpleString()
    return _LATTICE.get(name, [name, "string"] if name.startswith("decimal") else [name])


@dataclass(frozen=True)
class Layout:
    """Files that share a header. names: as written; the schema's own names where they match."""

    names: tuple[str, ...]
    files: tuple[str, ...]


@dataclass(frozen=True)
class Drift:
    """One difference from the definition: reordered, missing, added or widened."""

    column: str
    change: str
    was: str | None
    now: str | None
    files: int

    def __str__(self) -> str:
        what = f" {self.was} -> {self.now}" if self.change == "widened" else ""
        return f"{self.column} {self.change}{what} in {self.files} files"


def _flag(options: dict[str, str], name: str) -> bool:
    return str(options.get(name, "false")).lower() == "true"


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> list[tuple[str, int, object]]:
    """(path, bytes, time) of the data files under ``path``; Spark lists them, no file is opened."""
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", True)
    rows = r.load(path).select("path", "length", "modificationTime").collect()  # a row for each file, as in any scan's plan
    return sorted((r["path"], r["length"], r["modificationTime"]) for r in rows)


def _first_line(spark: SparkSession, file: str, encoding: str) -> str:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
        return (reader.readLine() or "").lstrip("﻿")
    finally:
        stream.close()


def layouts(spark: SparkSession, path: str, options: dict[str, str] | None = None, files: list[str] | None = None) -> list[Layout]:
    """The files under ``path`` by their header, empty ones left out. Reads each file's first line, nothing more."""
    options = options or {}
    if files is None:
        files = [f for f, size, _ in list_files(spark, path, _flag(options, "recursiveFileLookup")) if size]
    encoding = options.get("encoding", "UTF-8")
    with ThreadPoolExecutor(16) as pool:
        heads = list(pool.map(lambda f: _first_line(spark, f, encoding), files))
    by: dict[str, list[str]] = {}
    for f, h in zip(files, heads, strict=True):
        if h:
            by.setdefault(h, []).append(f)
    style = {"delimiter": options.get("delimiter") or options.get("sep") or ",", "quotechar": options.get("quote") or '"'}
    out = []
    for h, fs in by.items():
        names = [n.strip() for n in next(csv.reader([h], **style))]
        low = [n.lower() for n in names]
        if len(set(low)) < len(low) or "" in low:
            raise ValueError(f"the header of {fs[0]} repeats or leaves out a name: {names}")
        out.append(Layout(tuple(names), tuple(fs)))
    return out


def check_headers(found: list[Layout], schema: T.StructType) -> None:
    """Raises if any file's header does not name the schema's columns in their order."""
    want = [f.name.lower() for f in schema.fields]
    for lay in found:
        if [n.lower() for n in lay.names] != want:
            raise ValueError(f"the header of {lay.files[0]} names {list(lay.names)}; the definition has {[f.name for f in schema.fields]}")


def differences(found: list[Layout], schema: T.StructType) -> list[Drift]:
    """What the layouts' headers do not share with the definition."""
    mine = {f.name.lower(): f for f in schema.fields}
    out: dict[tuple[str, str], Drift] = {}

    def note(column: str, change: str, was: str | None, now: str | None, files: int) -> None:
        old = out.get((column.lower(), change))
        out[column.lower(), change] = Drift(old.column if old else column, change, was, now, files + (old.files if old else 0))
    for lay in found:
        low = [n.lower() for n in lay.names]
        for n in lay.names:
            if n.lower() not in mine:
                note(n, "added", None, "string", len(lay.files))
        for k, f in mine.items():
            if k not in low:
                note(f.name, "missing", f.dataType.simpleString(), None, len(lay.files))
        shared, order = [n for n in low if n in mine], [k for k in mine if k in low]
        for a, b in zip(shared, order, strict=True):
            if a != b:
                note(mine[a].name, "reordered", None, None, len(lay.files))
    return list(out.values())


def full_schema(found: list[Layout], schema: T.StructType, widened: dict[str, str] | None = None) -> T.StructType:
    """The definition's columns, with wider types where given, then the layouts' new ones as STRING."""
    widened = widened or {}
    fields = [T.StructField(f.name, _type(widened[f.name.lower()]) if f.name.lower() in widened else f.dataType, True) for f in schema.fields]
    have = {f.name.lower() for f in fields}
    for lay in found:
        for n in lay.names:
            if n.lower() not in have:
                have.add(n.lower())
                fields.append(T.StructField(n, T.StringType(), True))
    return T.StructType(fields)


def _type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {name}").fields[0].dataType


def _reader(spark: SparkSession, options: dict[str, str]):
    r = spark.read
    for k, v in options.items():
        if k not in ("header", "recursiveFileLookup"):
            r = r.option(k, v)
    # a reader that parses only the columns asked for does not see that a row has too many or too few
    return r.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)


def read_layout(spark: SparkSession, lay: Layout, target: T.StructType, options: dict[str, str], file_as: str | None = None) -> DataFrame:
    """A layout's files, bound by name to ``target``: its columns in its order, then _corrupt_record.

    file_as: the name of a further column with each row's file.
    """
    by = {f.name.lower(): f for f in target.fields}
    fields = [by[n.lower()] for n in lay.names]
    df = _reader(spark, options).schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])).csv(list(lay.files))
    here = {f.name for f in fields}
    return df.select(*[F.col(f"`{f.name}`") if f.name in here else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields], CORRUPT,
                     *([F.col("_metadata.file_path").alias(file_as)] if file_as else []))


def read_by_header(spark: SparkSession, found: list[Layout], target: T.StructType, options: dict[str, str], file_as: str | None = None) -> DataFrame:
    """All layouts under one schema, with _corrupt_record."""
    if not found:
        more = [CORRUPT, *([file_as] if file_as else [])]
        return spark.createDataFrame([], T.StructType([*target.fields, *[T.StructField(c, T.StringType(), True) for c in more]]))
    return reduce(DataFrame.unionByName, [read_layout(spark, lay, target, options, file_as) for lay in found])


def widened(found: list[Layout], schema: T.StructType, wide: dict[str, str]) -> list[Drift]:
    """The columns of ``schema`` that ``wide`` (see ``needed``) gives another type."""
    out = []
    for f in schema.fields:
        if f.name.lower() in wide:
            files = sum(len(lay.files) for lay in found if f.name.lower() in {n.lower() for n in lay.names})
            out.append(Drift(f.name, "widened", f.dataType.simpleString(), wide[f.name.lower()], files))
    return out


def _level(cell: Column, steps: list[str]) -> Column:
    """The first of the types that holds the cell; the last, a STRING, holds any."""
    out = F.lit(len(steps) - 1)
    for i in reversed(range(len(steps) - 1)):
        holds = cell.try_cast(steps[i]).isNotNull()
        if steps[i] == "date":  # the cast would drop a time of day
            holds = holds & ~cell.rlike("[T:]")
        out = F.when(holds, F.lit(i)).otherwise(out)
    return F.when(cell.isNull(), F.lit(0)).otherwise(out)


def needed(spark: SparkSession, found: list[Layout], schema: T.StructType, options: dict[str, str],
           string_share: float = STRING_SHARE) -> dict[str, str]:
    """column (lower case) -> the wider type that its cells ask for.

    One aggregate for each layout, over its rows as text: how far each cell has
    to go. Rows with too few or too many cells ask for nothing.
    """
    declared = {f.name.lower(): f for f in schema.fields}
    most: dict[str, int] = {}
    big: dict[str, int] = {}
    for lay in found:
        typed = [n for n in lay.names if n.lower() in declared and len(chain(declared[n.lower()].dataType)) > 1]
        if not typed:
            continue
        text = T.StructType([T.StructField(n, T.StringType(), True) for n in [*lay.names, CORRUPT]])
        rows = _reader(spark, options).schema(text).csv(list(lay.files)).where(F.col(CORRUPT).isNull())
        aggs = [F.count(F.lit(1)).alias("n")]
        for i, n in enumerate(typed):
            steps, cell = chain(declared[n.lower()].dataType), F.col(f"`{n}`")
            level, text_at = _level(cell, steps), len(steps) - 1
            aggs += [F.max(F.when(level < text_at, level)).alias(f"level{i}"), F.count_if(level == text_at).alias(f"text{i}"),
                     F.max(F.abs(cell.try_cast("bigint"))).alias(f"big{i}")]
        row = rows.agg(*aggs).first()
        for i, n in enumerate(typed):
            k, steps = n.lower(), chain(declared[n.lower()].dataType)
            level = row[f"level{i}"] or 0
            if row["n"] and row[f"text{i}"] > string_share * row["n"]:
                level = len(steps) - 1
            most[k] = max(most.get(k, 0), level)
            big[k] = max(big.get(k, 0), row[f"big{i}"] or 0)
    out = {}
    for k, level in most.items():
        kind = chain(declared[k].dataType)[level]
        if kind == "double" and level and big[k] > EXACT:
            kind = "string"  # a double would lose digits that are there
        if level:
            out[k] = kind
    return out
