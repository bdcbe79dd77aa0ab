"""Exports written from the driver's tables: what the ingest queries read."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from starloom.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_definition(spark: SparkSession, base: str, folder: str, entity: str, attributes: list[tuple[str, str]]) -> None:
    """The entity's definition, as Spark writes text."""
    text = json.dumps({"definitions": [{"entityName": entity, "hasAttributes": [{"name": n, "dataFormat": f} for n, f in attributes]}]})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/{folder}/{entity}.cdm.json")


def write_files(df: DataFrame, base: str, folder: str, entity: str, name: str) -> None:
    """``df`` as CSV files with a header, ``<name>-<i>.csv`` in the entity's folder; files of that name are replaced."""
    spark = df.sparkSession
    staged, target = f"{base}/_staged/{uuid.uuid4().hex}", f"{base}/{folder}/{entity}"
    df.write.option("header", True).csv(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(target)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(root)
    remove_files(spark, base, folder, entity, name)
    parts = sorted(str(f.getPath()) for f in fs.listStatus(hadoop.Path(staged)) if f.getPath().getName().startswith("part-"))
    for i, p in enumerate(parts):
        fs.rename(hadoop.Path(p), hadoop.Path(f"{target}/{name}-{i}.csv"))
    fs.delete(hadoop.Path(staged), True)


def remove_files(spark: SparkSession, base: str, folder: str, entity: str, name: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{base}/{folder}/{entity}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(root):
        if f.getPath().getName().startswith(f"{name}-"):
            fs.delete(f.getPath(), False)
