"""Catalog tables and raw paths on the installed table format.

Parquet tables (the default here) cannot DELETE, MERGE, carry IDENTITY
columns or merge schemas on append, and Spark refuses to overwrite a table
the same plan reads. Those operations are written as a staging table, which is
then swapped in by renames: target to ``<t>__old``, ``<t>__staging`` to target,
drop ``__old``. Renames happen only after staging is complete, so whatever a
crash leaves behind, ``recover`` finds either the old or the new rows whole;
every operation on a table recovers it first. Run one writer per table (as the
source does).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from starloom.operators.history import upsert

#: Suffixes of the tables that a swap or a partial upsert passes through.
_STEPS = ("__staging", "__old", "__upsert")


class SchemaMismatch(ValueError):
    pass


def write_raw(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Full overwrite of a path-addressed table (raw layer)."""
    w = df.write.format(fmt).mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_clustered(df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str],
                    files: int | None = None, fmt: str = "parquet") -> None:
    """Partitioned, clustered layout (also the compaction rewrite).

    Rows are range-partitioned on (partition columns, cluster columns) and
    sorted within each task: a partition value holding a third of the rows
    is spread over many tasks (a hash on the partition column would send it
    to one), every file covers a narrow key range so Parquet min/max
    statistics skip row groups, and the number of files is ``files``
    (default: shuffle partitions) instead of one per input split.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in partition_by + cluster_by]
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
       .write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path))


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped named view (CREATE OR REPLACE TEMP VIEW)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def _fields(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


class Catalog:
    """Named tables under ``[catalog.]schema.table`` (names lower-cased)."""

    def __init__(self, spark: SparkSession, catalog: str | None = None, fmt: str = "parquet"):
        self.spark = spark
        self.catalog = catalog
        self.fmt = fmt

    # -- names -------------------------------------------------------------
    def name(self, schema: str, table: str) -> str:
        parts = [schema.lower(), table.lower()]
        if self.catalog:
            parts.insert(0, self.catalog)
        return ".".join(parts)

    def ensure_schema(self, schema: str) -> None:
        s = f"{self.catalog}.{schema.lower()}" if self.catalog else schema.lower()
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {s}")

    def schema_exists(self, schema: str) -> bool:
        return self.spark.catalog.databaseExists(f"{self.catalog}.{schema.lower()}" if self.catalog else schema.lower())

    def exists(self, schema: str, table: str) -> bool:
        self.recover(schema, table)
        return self._there(schema, table)

    def _there(self, schema: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(schema, table))

    def read(self, schema: str, table: str) -> DataFrame:
        """Current content; the cached file listing is refreshed first because
        other sessions (e.g. a stream's micro-batches) may have written."""
        self.recover(schema, table)
        n = self.name(schema, table)
        self.spark.catalog.refreshTable(n)
        return self.spark.table(n)

    def list_tables(self, schema: str) -> list[str]:
        db = f"{self.catalog}.{schema.lower()}" if self.catalog else schema.lower()
        return sorted(t.name for t in self.spark.catalog.listTables(db)
                      if not t.isTemporary and not t.name.endswith(_STEPS))

    # -- writes ------------------------------------------------------------
    def _drop(self, schema: str, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(schema, table)}")

    def _rename(self, schema: str, old: str, new: str) -> None:
        # the new name never carries the catalog: a table stays in its own
        self.spark.sql(f"ALTER TABLE {self.name(schema, old)} RENAME TO {schema.lower()}.{new.lower()}")

    def recover(self, schema: str, table: str) -> None:
        """Finishes or undoes a swap that a crash cut short.

        The old rows' table is there only from the moment staging is complete
        until the new rows are in place, so if it is, the swap goes on from
        where it was. Staging alone is unfinished work, and the next swap
        drops it.
        """
        old, staging = f"{table}__old", f"{table}__staging"
        if not self._there(schema, old):
            return  # no swap of an existing table is under way
        self._mend_partitions(schema, old)
        if not self._there(schema, table):
            self._rename(schema, staging if self._there(schema, staging) else old, table)
        self._mend_partitions(schema, table)
        self._drop(schema, old)

    def _mend_partitions(self, schema: str, table: str) -> None:
        """Points a renamed table's partitions at its folder: some catalogs
        move the folder and leave the partitions' locations as they were, so
        that dropping the table would delete what is in its former folder."""
        if not self.layout(schema, table)[0]:
            return
        name = self.name(schema, table)
        info = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect():  # metadata, a row for each partition
            spec = []
            for part in r["partition"].split("/"):
                k, v = part.split("=", 1)
                v = unquote(v).replace("\\", "\\\\").replace("'", "\\'")
                spec.append(f"`{k}` = " + ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'"))
            self.spark.sql(f"ALTER TABLE {name} PARTITION ({', '.join(spec)}) SET LOCATION '{info['Location']}/{r['partition']}'")
        self.spark.catalog.refreshTable(name)

    def layout(self, schema: str, table: str) -> tuple[list[str], int, list[str]]:
        """(partition columns, buckets, bucket columns) of a table."""
        cols = self.spark.catalog.listColumns(self.name(schema, table))
        buckets = [c.name for c in cols if c.isBucket]
        n = 0
        if buckets:
            rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(schema, table)}").collect()  # metadata
            n = next((int(r["data_type"]) for r in rows if r["col_name"] == "Num Buckets"), 0)
        return [c.name for c in cols if c.isPartition], n, buckets

    def _swap_in(self, df: DataFrame, schema: str, table: str, partition_by: list[str] | None = None,
                 buckets: int = 0, bucket_by: list[str] | None = None) -> None:
        """Replaces the table by ``df``, in the layout given or else in its present one."""
        staging, old = f"{table}__staging", f"{table}__old"
        there = self.exists(schema, table)
        if there and partition_by is None and not bucket_by:
            partition_by, buckets, bucket_by = self.layout(schema, table)
            have = {c.lower() for c in df.columns}
            partition_by = [c for c in partition_by if c.lower() in have]
            bucket_by = bucket_by if {c.lower() for c in bucket_by} <= have else []
        self._drop(schema, staging)
        w = df.write.format(self.fmt).mode("overwrite" if there else "errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by and buckets:
            w = w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        if not there:  # a table is registered once its rows are written: nothing to swap
            w.saveAsTable(self.name(schema, table))
            return
        w.saveAsTable(self.name(schema, staging))
        self._rename(schema, table, old)
        self._mend_partitions(schema, old)
        self._rename(schema, staging, table)
        self._mend_partitions(schema, table)
        self._drop(schema, old)

    def overwrite(self, df: DataFrame, schema: str, table: str,
                  allow_schema_change: bool = False, cluster_by: list[str] | None = None) -> None:
        """Full overwrite. Refuses a schema change unless allowed (the
        transactional format refuses it without overwriteSchema; Parquet
        would silently replace it). Goes through staging, so ``df`` may read
        the table it replaces."""
        self.ensure_schema(schema)
        if self.exists(schema, table) and not allow_schema_change:
            old = _fields(self.read(schema, table).schema)
            if old != _fields(df.schema):
                raise SchemaMismatch(f"{self.name(schema, table)}: {old} != {_fields(df.schema)}")
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        self._swap_in(df, schema, table)

    def overwrite_bucketed(self, df: DataFrame, schema: str, table: str, buckets: int,
                           keys: list[str]) -> None:
        """Full overwrite as a bucketed table, sorted by ``keys`` in each
        bucket. Two tables bucketed the same way on their join keys join
        without shuffling either side (e.g. order lines and order headers)."""
        self.ensure_schema(schema)
        self._swap_in(df, schema, table, [], buckets, keys)

    def append(self, df: DataFrame, schema: str, table: str, merge_schema: bool = False) -> None:
        """Append by column name; columns that ``df`` lacks are NULL. New columns
        raise, or with ``merge_schema`` are added to the table's definition:
        files that are there stay as they are, and their rows read NULL."""
        self.ensure_schema(schema)
        if not self.exists(schema, table):
            df.write.format(self.fmt).mode("overwrite").saveAsTable(self.name(schema, table))
            return
        cur = self.read(schema, table)
        cur_cols = {c.lower() for c in cur.columns}
        extra = [c for c in df.columns if c.lower() not in cur_cols]
        if extra:
            if not merge_schema:
                raise SchemaMismatch(f"new columns {extra} for {self.name(schema, table)}")
            cols = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in extra)
            self.spark.sql(f"ALTER TABLE {self.name(schema, table)} ADD COLUMNS ({cols})")
            cur = self.read(schema, table)
        have = {c.lower(): c for c in df.columns}
        aligned = df.select(*[(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                              for f in cur.schema.fields])
        aligned.write.insertInto(self.name(schema, table))

    def upsert_partitions(self, updates: DataFrame, schema: str, table: str, keys: list[str],
                          partition_by: list[str], order: list[str] | None = None) -> None:
        """Upsert into a table partitioned by ``partition_by``, rewriting only
        the partitions that receive updates (dynamic partition overwrite).

        A key must stay in one partition across versions (partition on a
        value that never changes for a key). Other partitions are not read
        or written, so the cost follows the batch, not the table. With
        ``order``, a row only replaces one that is not newer.
        """
        name = self.name(schema, table)
        if not self.exists(schema, table):
            self.ensure_schema(schema)
            (updates.write.format(self.fmt).mode("overwrite").partitionBy(*partition_by)
                    .saveAsTable(name))
            return
        cur = self.read(schema, table)
        touched = updates.select(*[F.col(c).alias(f"__p_{c}") for c in partition_by]).distinct()
        cond = None
        for c in partition_by:
            e = F.col(c).eqNullSafe(F.col(f"__p_{c}"))
            cond = e if cond is None else (cond & e)
        merged = upsert(cur.join(touched, cond, "left_semi"), updates, keys, order)
        self.replace_partitions(merged, schema, table)

    def replace_partitions(self, df: DataFrame, schema: str, table: str) -> None:
        """Overwrites just the partitions that ``df`` has rows for; ``df`` may
        read them, as it is written to a staging table first.

        The dynamic mode is set on a session of its own, so others that share
        the caller's session never see it.
        """
        name, staged = self.name(schema, table), self.name(schema, f"{table}__upsert")
        self.spark.sql(f"DROP TABLE IF EXISTS {staged}")
        df.select(*self.spark.table(name).columns).write.format(self.fmt).mode("overwrite").saveAsTable(staged)
        own = self.spark.newSession()
        own.conf.set("spark.sql.session.timeZone", self.spark.conf.get("spark.sql.session.timeZone"))
        own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        own.table(staged).write.mode("overwrite").insertInto(name)
        self.spark.catalog.refreshTable(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {staged}")

    def create_if_absent(self, schema: str, table: str, columns_ddl: str) -> None:
        self.ensure_schema(schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(schema, table)} ({columns_ddl}) "
                       f"USING {self.fmt}")

    def insert_select(self, schema: str, table: str, df: DataFrame, columns: list[str]) -> None:
        """INSERT INTO t(cols) SELECT ... FROM {df}; unnamed columns get NULL."""
        cols = ", ".join(columns)
        self.spark.sql(f"INSERT INTO {self.name(schema, table)} ({cols}) SELECT {cols} FROM {{src}}",
                       src=df)

    def insert_values(self, schema: str, table: str, columns: list[str], rows: list[tuple]) -> None:
        """Literal rows into some columns (the others NULL)."""
        if not rows:
            return
        tgt = self.read(schema, table).schema
        types = {f.name.lower(): f.dataType.simpleString() for f in tgt.fields}
        ddl = ", ".join(f"`{c}` {types[c.lower()]}" for c in columns)
        df = self.spark.createDataFrame(rows, ddl)
        self.insert_select(schema, table, df, columns)

    def delete_where(self, schema: str, table: str, predicate: str) -> None:
        """DELETE FROM t WHERE p, as a rewrite keeping rows where p is false
        or NULL (three-valued logic, like DELETE). Of a partitioned table only
        the partitions that hold such rows are rewritten, or dropped where no
        row is left."""
        cur = self.read(schema, table)
        goes = F.coalesce(F.expr(predicate), F.lit(False))
        by = self.layout(schema, table)[0]
        if not by:
            self._swap_in(cur.filter(~goes), schema, table)
            return
        counts = cur.groupBy(*by).agg(F.count_if(goes).alias("__gone"), F.count_if(~goes).alias("__left")).where("__gone > 0")
        counts = counts.collect()  # a row for each partition that is touched
        if not counts:
            return
        left = [r for r in counts if r["__left"]]
        if left:
            touched = self.spark.createDataFrame([tuple(r[c] for c in by) for r in left],
                                                 StructType([StructField(f"__p_{c}", cur.schema[c].dataType) for c in by]))
            same = F.lit(True)
            for c in by:
                same = same & F.col(c).eqNullSafe(F.col(f"__p_{c}"))
            self.replace_partitions(cur.join(touched, same, "left_semi").filter(~goes), schema, table)
        for r in counts:
            if not r["__left"]:
                spec = ", ".join(f"`{c}` = " + ("NULL" if r[c] is None else "'" + str(r[c]).replace("\\", "\\\\").replace("'", "\\'") + "'") for c in by)
                self.spark.sql(f"ALTER TABLE {self.name(schema, table)} DROP IF EXISTS PARTITION ({spec})")
        self.spark.catalog.refreshTable(self.name(schema, table))

    def register_external(self, schema: str, table: str, path: str, fmt: str | None = None) -> None:
        """CREATE TABLE ... USING fmt LOCATION path over existing raw data."""
        self.ensure_schema(schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(schema, table)} "
                       f"USING {fmt or self.fmt} LOCATION '{path}'")

    def drop_if_exists(self, schema: str, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(schema, table)}")
