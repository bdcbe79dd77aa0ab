"""Compaction of small files: only undersized files are rewritten, the others keep name and time.

The files of a Parquet folder are listed with their sizes (nothing is read),
and within each partition folder the undersized ones are dealt to bins by a
running sum of their bytes. The files of a bin become one file: one task reads
them one after another and writes what it reads, without a shuffle or a sort,
so that a bin takes no more memory than a batch of rows and a row group.

New files are written to ``_compact`` below the table, which readers do not
see; then the plan is written beside them. From then on the old files are
deleted and the new ones moved in, and ``recover`` finishes that if it was cut
short; before, it throws the new files away. One writer, and no readers while
files are moved.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.sources.cdm import _exists

TARGET_BYTES = 256 << 20
#: Bins rewritten at once, at most.
MOST_JOBS = 64
WORK = "_compact"


def plan(spark: SparkSession, path: str, target: int = TARGET_BYTES, small: float = 0.5) -> DataFrame:
    """folder, path, uri, size and bin of the files to rewrite: those under ``small`` of the target, where a bin has two or more."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    files = files.select("path", F.col("_metadata.file_path").alias("uri"), F.col("length").alias("size"))
    little = files.where(F.col("size") < small * target).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    w = Window.partitionBy("folder").orderBy("path")
    upto = F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0))
    binned = little.withColumn("bin", F.floor((upto - F.col("size")) / target))
    together = Window.partitionBy("folder", "bin")
    return (binned.withColumn("n", F.count(F.lit(1)).over(together)).where("n > 1")
            .withColumn("bin", F.substring(F.sha2(F.concat_ws("|", "folder", F.col("bin").cast("string")), 256), 1, 20)).drop("n"))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def compact(spark: SparkSession, path: str, target: int = TARGET_BYTES, small: float = 0.5) -> int:
    """Rewrites the undersized files below ``path``; returns how many were replaced."""
    recover(spark, path)
    work = f"{path}/{WORK}"
    moves = plan(spark, path, target, small)
    rows = moves.select("path", "uri", "bin", "folder").collect()  # a row for each small file: their paths are what is read
    if not rows:
        return 0
    fixed = spark.createDataFrame([tuple(r) for r in rows], "path string, uri string, bin string, folder string")
    # files carry their folder's partition values in its name: without a base path they are not read as columns
    schema = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(*[r["path"] for r in rows]).schema
    bins: dict[str, list[str]] = {}
    for r in rows:
        bins.setdefault(r["bin"], []).append(r["path"])

    def rewrite(b: str) -> None:
        whole = spark.read.option("recursiveFileLookup", True).schema(schema).parquet(*bins[b])
        whole.coalesce(1).write.mode("overwrite").parquet(f"{work}/new/__bin={b}")
    # a bin is a job of one task: as many at once as the cluster has cores
    with ThreadPoolExecutor(max(1, min(len(bins), MOST_JOBS, spark.sparkContext.defaultParallelism))) as pool:
        list(pool.map(inheritable_thread_target(spark)(rewrite), bins))
    fixed.coalesce(1).write.mode("overwrite").parquet(f"{work}/plan")
    recover(spark, path)
    return len(rows)


def recover(spark: SparkSession, path: str) -> None:
    """Ends a compaction that was cut short: whole if its plan was written, not at all if not."""
    work = f"{path}/{WORK}"
    if not _exists(spark, work):
        return
    if _exists(spark, f"{work}/plan/_SUCCESS"):
        rows = spark.read.parquet(f"{work}/plan").collect()
        fs, _ = _fs(spark, path)
        hadoop = spark._jvm.org.apache.hadoop.fs
        for r in rows:
            fs.delete(hadoop.Path(r["path"]), False)
        for b, folder in sorted({(r["bin"], r["folder"]) for r in rows}):
            there = hadoop.Path(f"{work}/new/__bin={b}")
            if fs.exists(there):
                for f in fs.listStatus(there):
                    name = f.getPath().getName()
                    if name.endswith(".parquet"):  # a job's marker of success stays behind
                        fs.rename(f.getPath(), hadoop.Path(f"{folder}/compact-{b}-{name}"))
    fs, p = _fs(spark, work)
    fs.delete(p, True)
