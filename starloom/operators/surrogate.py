"""Insert-only dimensions with dense surrogate keys.

new members = distinct(source) EXCEPT ALL existing members
new ids     = max(existing id, default 0) + row_number() over (order by member)

``exceptAll`` on a distinct input is the null-safe anti join, which is what
is planned here (NULL = NULL, as in set operations). Existing ids are never
touched; a rerun with no new member yields no rows.

Numbering: the new members are range-partitioned on the order key, numbered
inside each partition, and shifted by the row counts of the preceding
partitions (a table with one row per partition). The partitioned members are
written to the shared checkpoint folder once, so they are worked out a single
time, both uses see the same partitioning even after an executor loss, and no
task ever holds them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import checkpoint_dir

def distinct_members(source: DataFrame, member: str, keep_null: bool = False,
                     trim: bool = False) -> DataFrame:
    c = F.trim(F.col(member)) if trim else F.col(member)
    m = source.select(c.alias(member)).distinct()
    return m if keep_null else m.filter(F.col(member).isNotNull())


def new_members(members: DataFrame, existing: DataFrame, member: str) -> DataFrame:
    """Members not already in ``existing`` (null-safe), given distinct members."""
    ex = existing.select(F.col(member).alias("__ex")).distinct()
    return members.join(ex, F.col(member).eqNullSafe(F.col("__ex")), "left_anti")


def max_id(existing: DataFrame, id_col: str) -> int:
    """ifnull(max(id), 0): one scalar to the driver, never rows."""
    return int(existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"])


def dense_number(df: DataFrame, order_col: str, id_col: str, offset: int = 0,
                 partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = offset + 1-based rank of ``order_col`` (values distinct)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = (df.repartitionByRange(n, F.col(order_col).asc_nulls_first())
               .sortWithinPartitions(F.col(order_col).asc_nulls_first())
               .withColumn("__pid", F.spark_partition_id())
               .withColumn("__mid", F.monotonically_increasing_id())
               .checkpoint(eager=True))
    counts = parts.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # one row per partition: bounded by the partition count, safe to broadcast
    local_idx = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (parts.join(F.broadcast(offsets), "__pid")
                 .withColumn(id_col, F.col("__off") + local_idx + 1 + F.lit(offset))
                 .drop("__pid", "__mid", "__off"))


def incremental_keys(source: DataFrame, existing: DataFrame, member: str, id_col: str,
                     keep_null: bool = False, trim: bool = False,
                     id_type: str = "int") -> DataFrame:
    """Rows to append to an insert-only dimension: (id_col, member)."""
    members = distinct_members(source, member, keep_null=keep_null, trim=trim)
    fresh = new_members(members, existing, member)
    out = dense_number(fresh, member, id_col, offset=max_id(existing, id_col))
    return out.select(F.col(id_col).cast(id_type).alias(id_col), F.col(member))


def dimension_after(source: DataFrame, existing: DataFrame, member: str, id_col: str,
                    **kw) -> DataFrame:
    """Existing rows plus the appended ones: the dimension after one run."""
    add = incremental_keys(source, existing, member, id_col, **kw)
    id_type = kw.get("id_type", "int")
    ex = existing.select(F.col(id_col).cast(id_type).alias(id_col), F.col(member))
    return ex.unionByName(add)
