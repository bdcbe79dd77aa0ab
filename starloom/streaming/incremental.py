"""Incremental export loading as a file stream.

New export files in a folder are picked up exactly once (the stream's
checkpoint records which files were read), each micro-batch is appended to,
or upserted into, a catalog table. ``availableNow`` processes everything
present and stops, so the same job serves scheduled batch runs.

``foreachBatch`` is at-least-once: after a failure a micro-batch may be
replayed with the same id. Both sinks are idempotent under replay: an
upsert of the same rows gives the same table, and appends land in a partition
of their own, named by the stream and the batch, overwritten (not added to) on
replay. Lines that do not fit the schema go to ``<table>_quarantine``.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.operators.history import upsert
from starloom.operators.quality import keep_latest
from starloom.session import checkpoint_dir
from starloom.sources.catalog import Catalog, SchemaMismatch
from starloom.sources.cdm import CORRUPT


def export_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
                  header: bool = True, max_files: int | None = None) -> DataFrame:
    """The folder's files as a stream; CSV lines that do not fit the schema keep their text in ``_corrupt_record``."""
    if fmt == "csv":
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


STREAM_COL, BATCH_COL = "_stream", "_batch_id"


def append_batch(cat: Catalog, batch: DataFrame, batch_id: int, schema: str, table: str,
                 stream: str = "default") -> None:
    """Idempotent append of one micro-batch: its rows replace the partition
    (stream, batch_id). Two streams, or one whose checkpoint was made anew,
    never share a partition. A batch with other columns than the table raises."""
    df = batch.withColumn(STREAM_COL, F.lit(stream)).withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
    if not cat.exists(schema, table):
        cat.ensure_schema(schema)
        (df.write.format(cat.fmt).mode("overwrite").partitionBy(STREAM_COL, BATCH_COL)
           .saveAsTable(cat.name(schema, table)))
        return
    have, want = ({c.lower() for c in x.columns} for x in (df, cat.read(schema, table)))
    if have != want:
        raise SchemaMismatch(f"the batch and {cat.name(schema, table)} differ in the columns {sorted(have ^ want)}")
    cat.replace_partitions(df, schema, table)


def load_incremental(spark: SparkSession, cat: Catalog, path: str, schema: StructType,
                     target_schema: str, table: str, keys: list[str] | None = None,
                     order: list[str] | None = None, fmt: str = "csv", header: bool = True,
                     checkpoint: str | None = None, partition_by: list[str] | None = None) -> int:
    """Process all new files under ``path`` into ``target_schema.table``.

    Without ``keys`` rows are appended (idempotently, see ``append_batch``;
    the table carries the partition columns ``_stream`` and ``_batch_id``).
    With ``keys`` each batch is reduced to the latest row per key by ``order``,
    which is then required, and upserted where it is not older than the
    table's row; with ``partition_by`` only the partitions a batch touches are
    rewritten. Returns the number of micro-batches run.
    """
    if keys and not order:
        raise ValueError("an upsert needs the columns that tell which of a key's rows is the latest")
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/{target_schema}.{table}"
    batches = {"n": 0, "stream": ""}
    started = threading.Event()

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        batches["n"] += 1
        if CORRUPT in batch.columns:
            bad = batch.filter(F.col(CORRUPT).isNotNull())
            if not bad.isEmpty():
                append_batch(cat, bad, batch_id, target_schema, f"{table}_quarantine", batches["stream"])
            batch = batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        if not keys:
            append_batch(cat, batch, batch_id, target_schema, table, batches["stream"])
            return
        latest = keep_latest(batch, keys, order)
        if partition_by:
            cat.upsert_partitions(latest, target_schema, table, keys, partition_by, order)
        elif cat.exists(target_schema, table):
            cat.overwrite(upsert(cat.read(target_schema, table), latest, keys, order), target_schema, table)
        else:
            cat.overwrite(latest, target_schema, table)

    q = (export_stream(spark, path, schema, fmt, header)
         .writeStream.foreachBatch(write)
         .option("checkpointLocation", ckpt)
         .trigger(availableNow=True)
         .start())
    batches["stream"] = str(q.id)  # a new checkpoint gives a new id
    started.set()
    q.awaitTermination()
    return batches["n"]
