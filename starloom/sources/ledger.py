"""Incremental ingest of an entity's exports: a ledger of files.

The ledger holds each loaded file's path, size, time and content hash. A run
joins the listing with it:

* files that are not in it are ``new``;
* files whose size or time differ are hashed, and are ``changed`` or, with the
  same content, ``touched`` (nothing is loaded);
* files that are gone are ``removed``; the rest is the ``same``. Files of no
  bytes are none.

The raw table is partitioned by file, so that a changed file replaces its own
rows and no others. Valid and rejected rows come out of one scan, as
partitions of the same write: ``rejected=false`` is the raw table and
``rejected=true`` its quarantine.

A run first drops the partitions of new, changed and removed files, then writes the
new rows, then the ledger. Whatever a crash leaves is not in the ledger and is
dropped and loaded again by the next run. Run one at a time.

Headers and types may differ between files (see ``drift``). Where the files'
common schema is no longer the table's, all files are loaded again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.quality import REJECTED, split_path, write_split
from starloom.session import checkpoint_dir
from starloom.sources import drift
from starloom.sources.cdm import (CORRUPT, _exists, data_path, definition_path, entity_options, read_definition)

LEDGER = "path string, uri string, size long, time timestamp, lines long, digest string, run long"
FILE = "source_file"


def _ledger_path(raw_root: str, folder: str, entity: str) -> str:
    return f"{raw_root}/_ledger/{folder}/{entity}"


def read_ledger(spark: SparkSession, raw_root: str, folder: str, entity: str) -> DataFrame:
    """The files of the last run that ended; ``run`` is the run that loaded a file."""
    path = _ledger_path(raw_root, folder, entity)
    last = _last_run(spark, path)
    if not last:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER + ", at long").parquet(path).where(F.col("at") == last).drop("at").where("path is not null")


def _last_run(spark: SparkSession, book: str) -> int:
    if not _exists(spark, book):
        return 0
    return spark.read.schema(LEDGER + ", at long").parquet(book).agg(F.max("at").alias("at")).first()["at"] or 0


def digests(spark: SparkSession, files: list[str]) -> DataFrame:
    """uri, lines and digest of files: the lines' number and the sum of their hashes, so files are read in parallel and in pieces.

    Files with the same lines in another order have the same digest: as tables they are equal.
    """
    if not files:
        return spark.createDataFrame([], "uri string, lines long, digest string")
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("uri"), F.xxhash64("value").cast("decimal(38,0)").alias("h"))
    return lines.groupBy("uri").agg(F.count(F.lit(1)).alias("lines"), F.sum("h").cast("string").alias("digest"))


def plan(spark: SparkSession, path: str, ledger: DataFrame, recursive: bool = False) -> DataFrame:
    """Every file that is or was: path, uri, size, time, lines, digest, run (of the ledger) and ``action``."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    now = r.load(path).select("path", F.col("_metadata.file_path").alias("uri"), F.col("length").alias("size"),
                              F.col("modificationTime").alias("time"))  # a listing: contents are not read
    old = ledger.select("path", *[F.col(c).alias(f"old_{c}") for c in ("uri", "size", "time", "lines", "digest", "run")])
    j = now.join(old, "path", "full_outer")
    kept = (F.col("size") == F.col("old_size")) & (F.col("time") == F.col("old_time"))
    first = (F.when(F.col("size").isNull(), F.lit("removed")).when(F.col("old_size").isNull(), F.lit("new"))
             .when(kept, F.lit("same")).otherwise(F.lit("differs")))
    # the listing is read again by what follows: fixed here, so that files that arrive meanwhile wait for the next run
    listed = j.withColumn("action", first).checkpoint(eager=True)
    read = [x["path"] for x in listed.where("action in ('new', 'differs') and size > 0").select("path").collect()]
    d = digests(spark, read).select("uri", F.col("lines").alias("new_lines"), F.col("digest").alias("new_digest"))
    j = listed.join(d, "uri", "left")
    lines, digest = F.coalesce("new_lines", F.lit(0).cast("long")), F.coalesce("new_digest", F.lit(""))
    equal = (lines == F.col("old_lines")) & (digest == F.col("old_digest"))
    fresh = F.col("action").isin("new", "differs")
    return j.select("path", F.coalesce("uri", "old_uri").alias("uri"), "size", "time",
                    F.when(fresh, lines).otherwise(F.col("old_lines")).alias("lines"),
                    F.when(fresh, digest).otherwise(F.col("old_digest")).alias("digest"), F.col("old_run").alias("run"),
                    F.when(F.col("action") != "differs", F.col("action")).when(equal, F.lit("touched")).otherwise(F.lit("changed")).alias("action"))


def file_id(uri: str) -> str:
    """The partition value of a file; the letter in front keeps it from being read as a number."""
    return "f" + hashlib.sha256(uri.encode()).hexdigest()[:31]


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def raw_path(raw_root: str, folder: str, entity: str, rejected: bool = False) -> str:
    """Where an entity's valid (or rejected) rows are."""
    return split_path(f"{raw_root}/{folder}/{entity}", rejected)


def read_valid(spark: SparkSession, raw_root: str, folder: str, entity: str) -> DataFrame:
    """The entity's rows, with their file."""
    return spark.read.option("basePath", raw_path(raw_root, folder, entity)).parquet(raw_path(raw_root, folder, entity)).drop(CORRUPT)


def read_rejected(spark: SparkSession, raw_root: str, folder: str, entity: str) -> DataFrame | None:
    """The rows that did not fit, with their text; None if there are none."""
    path = raw_path(raw_root, folder, entity, True)
    return spark.read.parquet(path) if _exists(spark, path) else None


def ingest_changed(spark: SparkSession, base: str, folder: str, entity: str, raw_root: str, header: bool = True,
                   delimiter: str = ",", decimal_type: str | None = None, options: dict[str, str] | None = None,
                   recursive: bool = False) -> DataFrame:
    """Loads the files that are new or changed since the last run; returns path and ``action`` of every file.

    Where the files' schema has changed, files that are the same are loaded
    again, too, as ``reloaded``.
    """
    es = read_definition(spark, definition_path(base, folder, entity), decimal_type)
    csv, source = entity_options(header, delimiter, options, recursive), data_path(base, folder, entity)
    if csv["header"] != "true":
        raise ValueError("files are bound by their headers; an export without them is loaded by cdm.ingest_entity")
    checkpoint_dir(spark)
    table, book = f"{raw_root}/{folder}/{entity}", _ledger_path(raw_root, folder, entity)
    ledger = read_ledger(spark, raw_root, folder, entity)
    run = _last_run(spark, book) + 1
    files = plan(spark, source, ledger, recursive).checkpoint(eager=True)
    rows = files.select("path", "uri", "size", "action").collect()  # a row for each file, as Spark's own listing
    load = [r["path"] for r in rows if r["action"] in ("new", "changed") and r["size"]]
    # new files, too: a run that was cut short may have left rows of theirs
    stale = [r["uri"] for r in rows if r["action"] in ("new", "changed", "removed")]
    everything = [r["path"] for r in rows if r["action"] != "removed" and r["size"]]
    stored = _stored_schema(spark, raw_root, folder, entity)
    schema = _merged(es.schema, stored)
    reload = False
    if load:
        found = drift.layouts(spark, source, csv, load)
        target = drift.full_schema(found, schema)
        reload = stored is not None and _types(target) != _types(stored)
        if not reload:
            _drop(spark, raw_root, folder, entity, stale)
            if _write(spark, found, target, csv, table) and (wide := drift.needed(spark, found, schema, csv)):
                target, reload = drift.full_schema(found, schema, wide), True
        if reload:
            found = drift.layouts(spark, source, csv, everything)
            target = drift.full_schema(found, target)
            _delete(spark, table)
            if _write(spark, found, target, csv, table) and (wide := drift.needed(spark, found, target, csv)):
                _delete(spark, table)
                _write(spark, found, drift.full_schema(found, target, wide), csv, table)
    else:
        _drop(spark, raw_root, folder, entity, stale)
    redone = F.col("action").isin("new", "changed") | F.lit(reload)
    kept = files.where("action != 'removed'").select("path", "uri", "size", "time", "lines", "digest",
                                                     F.when(redone, F.lit(run)).otherwise(F.col("run")).cast("long").alias("run"))
    none = spark.createDataFrame([(None,) * 7], LEDGER)  # the run is there even if no file is
    (kept.unionByName(none).withColumn("at", F.lit(run).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("at").parquet(book))
    action = F.when(F.lit(reload) & F.col("action").isin("same", "touched"), F.lit("reloaded")).otherwise(F.col("action"))
    return files.select("path", action.alias("action"))


def _drop(spark: SparkSession, raw_root: str, folder: str, entity: str, uris: list[str]) -> None:
    """Deletes the rows of files, valid and rejected."""
    for uri in uris:
        for rejected in (False, True):
            _delete(spark, f"{raw_path(raw_root, folder, entity, rejected)}/{FILE}={file_id(uri)}")


def _write(spark: SparkSession, found: list[drift.Layout], target: T.StructType, csv: dict[str, str], table: str) -> int:
    """Adds the files' rows to the table, in one scan; returns how many were rejected."""
    obs = Observation("rejected")
    df = drift.read_by_header(spark, found, target, csv, file_as="__uri").observe(obs, F.count_if(F.col(CORRUPT).isNotNull()).alias("n"))
    ident = F.concat(F.lit("f"), F.substring(F.sha2("__uri", 256), 1, 31))
    write_split(df.withColumn(FILE, ident).drop("__uri"), F.col(CORRUPT).isNull(), table, partition_by=[FILE], mode="append")
    return int(obs.get["n"] or 0)


def _types(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _merged(schema: T.StructType, stored: T.StructType | None) -> T.StructType:
    """The definition with the types that the table has by now, and the table's further columns."""
    if stored is None:
        return schema
    have = {f.name.lower(): f for f in stored.fields}
    mine = {f.name.lower() for f in schema.fields}
    return T.StructType([*[T.StructField(f.name, have[f.name.lower()].dataType if f.name.lower() in have else f.dataType, True) for f in schema.fields],
                         *[f for f in stored.fields if f.name.lower() not in mine]])


def _stored_schema(spark: SparkSession, raw_root: str, folder: str, entity: str) -> T.StructType | None:
    path = f"{raw_root}/{folder}/{entity}"
    if not _exists(spark, path) or spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).isEmpty():
        return None
    return T.StructType([f for f in spark.read.parquet(path).schema.fields if f.name not in (CORRUPT, REJECTED, FILE)])
