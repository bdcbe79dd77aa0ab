"""Data-quality checks, each a distributed aggregate returning a small frame.

Every check is one pass (or one anti join) over its input with map-side
partial aggregation, so a hot key never concentrates raw rows in one task.
``run_rules`` evaluates a list of rules into one result frame.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType


def record_counts(source: DataFrame, target: DataFrame, check: str = "record_count") -> DataFrame:
    """Q1: source vs target row counts in one row (no cross join: a union
    of two one-row aggregates folded by a global aggregate)."""
    s = source.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("source"))
    t = target.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("target"))
    both = s.unionByName(t)
    src = F.sum(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows")
    tgt = F.sum(F.when(F.col("side") == "target", F.col("n"))).alias("target_rows")
    return both.agg(src, tgt).select(
        F.lit(check).alias("check"), "source_rows", "target_rows",
        (F.col("source_rows") == F.col("target_rows")).alias("passed"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q2: key values occurring more than once, with their counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
              .filter(F.col("dup_count") > 1))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Q3: one row: total rows and NULL count per column, in one pass."""
    cols = cols or df.columns
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def key_validity(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q4: a key is valid when no part is NULL and no value repeats."""
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else (any_null | F.col(k).isNull())
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.max(any_null.cast("int")).alias("has_null"))
    out = per_key.agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(F.col("has_null") == 1, F.col("n")).otherwise(0)).alias("null_key_rows"),
        F.count_if((F.col("n") > 1) & (F.col("has_null") == 0)).alias("duplicate_keys"),
        F.count_if(F.col("has_null") == 0).alias("distinct_keys"),
    )
    return out.withColumn("passed", (F.col("null_key_rows") == 0) & (F.col("duplicate_keys") == 0))


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Q5: fact rows whose non-NULL foreign key has no dimension row."""
    d = dim.select(F.col(dim_key).alias("__dk")).distinct()
    f = fact.filter(F.col(fact_key).isNotNull())
    return f.join(d, F.col(fact_key) == F.col("__dk"), "left_anti")


def orphan_row_count(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Q5 as a count: one row ``orphan_rows``.

    The fact keys are counted per value first, so a foreign key held by a
    third of the rows is collapsed by the map-side partial aggregate before
    the join, whose sides are then one row per key. That order is written as
    a left outer join + IS NULL, because Catalyst would push a left anti join
    back below the aggregate.
    """
    d = dim.select(F.col(dim_key).alias("__dk")).distinct()
    f = fact.filter(F.col(fact_key).isNotNull())
    keys = f.groupBy(F.col(fact_key).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    missing = keys.join(d, F.col("__fk") == F.col("__dk"), "left").filter(F.col("__dk").isNull())
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("orphan_rows"))


def orphan_counts(checks: list[tuple[str, DataFrame, DataFrame, str, str]]) -> DataFrame:
    """Q5 over several foreign keys: one row (check, orphan_rows) each."""
    parts = [orphan_row_count(f, d, fk, dk).select(F.lit(name).alias("check"), "orphan_rows")
             for name, f, d, fk, dk in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def split_valid(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Q6: (valid, quarantine). A row whose predicate is NULL is not valid."""
    ok = F.coalesce(predicate, F.lit(False))
    return df.filter(ok), df.filter(~ok)


#: The partition that tells valid rows (false) from the others (true).
REJECTED = "rejected"


def split_path(path: str, rejected: bool = False) -> str:
    """Where ``write_split`` puts the valid or the rejected rows below ``path``."""
    return f"{path}/{REJECTED}={str(rejected).lower()}"


def write_split(df: DataFrame, valid: Column, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Q6 in one scan: valid and rejected rows (``valid`` false or NULL) as partitions of a single write.

    ``df`` is read and worked out once; either side is then read by its
    partition alone (``read_split``), and ``split_path`` names its folder.
    """
    flagged = df.withColumn(REJECTED, ~F.coalesce(valid, F.lit(False)))
    flagged.write.format(fmt).mode(mode).partitionBy(REJECTED, *(partition_by or [])).save(path)


def read_split(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of what ``write_split`` wrote; schema: that of the rows, as a side without rows has no files."""
    full = StructType([*schema.fields, StructField(REJECTED, BooleanType())])
    both = spark.read.format(fmt).schema(full).load(path)
    return both.where(~F.col(REJECTED)).drop(REJECTED), both.where(F.col(REJECTED)).drop(REJECTED)


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Q7: one row per key, the one with the largest ``order`` tuple (ties
    broken by the remaining columns, so the choice is deterministic).

    A max over a struct is an ordinary aggregate with a map-side partial
    step: a key holding a third of all rows is reduced inside each task
    before the shuffle, unlike a row_number window over the key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    return agg.select(*keys, *[F.col("__best")[c].alias(c) for c in order + rest]).select(*df.columns)


@dataclass(frozen=True)
class Rule:
    """Q8 rule. kind: not_null | unique | valid | foreign_key | row_count."""
    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    predicate: str | None = None
    ref_table: str | None = None
    ref_column: str | None = None
    params: dict = field(default_factory=dict)


def _rule_frame(rule: Rule, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[rule.table]
    total = F.count(F.lit(1)).alias("total_rows")
    if rule.kind == "not_null":
        bad = None
        for c in rule.columns:
            bad = F.col(c).isNull() if bad is None else (bad | F.col(c).isNull())
        res = df.agg(F.count_if(bad).alias("failed_rows"), total)
    elif rule.kind == "unique":
        per = df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n"))
        res = per.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed_rows"),
                      F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"))
    elif rule.kind == "valid":
        ok = F.coalesce(F.expr(rule.predicate), F.lit(False))
        res = df.agg(F.count_if(~ok).alias("failed_rows"), total)
    elif rule.kind == "foreign_key":
        fk = rule.columns[0]
        a = orphan_row_count(df, tables[rule.ref_table], fk, rule.ref_column).select(
            F.col("orphan_rows").alias("failed_rows"), F.lit(0).cast("long").alias("total_rows"))
        b = df.agg(F.lit(0).cast("long").alias("failed_rows"), total)
        res = a.unionByName(b).agg(F.sum("failed_rows").alias("failed_rows"),
                                   F.sum("total_rows").alias("total_rows"))
    elif rule.kind == "row_count":
        lo = rule.params.get("min", 0)
        res = df.agg(total).select(F.when(F.col("total_rows") < lo, F.lit(1)).otherwise(0)
                                   .cast("long").alias("failed_rows"), "total_rows")
    else:
        raise ValueError(f"unknown rule kind {rule.kind}")
    return res.select(F.lit(rule.name).alias("rule"), F.lit(rule.table).alias("table_name"),
                      F.lit(rule.kind).alias("kind"),
                      F.col("failed_rows").cast("long").alias("failed_rows"),
                      F.col("total_rows").cast("long").alias("total_rows"),
                      (F.col("failed_rows") == 0).alias("passed"))


_ROW_LEVEL = ("not_null", "valid", "row_count")


def _row_level_failed(rule: Rule) -> Column:
    """Aggregate expression counting a row-level rule's failures."""
    if rule.kind == "not_null":
        bad = None
        for c in rule.columns:
            bad = F.col(c).isNull() if bad is None else (bad | F.col(c).isNull())
        return F.count_if(bad)
    if rule.kind == "valid":
        return F.count_if(~F.coalesce(F.expr(rule.predicate), F.lit(False)))
    lo = rule.params.get("min", 0)
    return F.when(F.count(F.lit(1)) < lo, F.lit(1)).otherwise(F.lit(0))


def run_rules(rules: list[Rule], tables: dict[str, DataFrame]) -> DataFrame:
    """Q8: evaluate every rule; one row per rule.

    Row-level rules (not_null, valid, row_count) of one table share a single
    aggregate pass over it, unpivoted into one row per rule; uniqueness and
    foreign-key rules each need their own aggregate or join.
    """
    frames = []
    grouped: dict[str, list[Rule]] = {}
    for r in rules:
        if r.kind in _ROW_LEVEL:
            grouped.setdefault(r.table, []).append(r)
        else:
            frames.append(_rule_frame(r, tables))
    for table, rs in grouped.items():
        one = tables[table].agg(F.count(F.lit(1)).alias("__total"),
                                *[_row_level_failed(r).alias(f"__f{i}") for i, r in enumerate(rs)])
        per_rule = F.explode(F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.table).alias("table_name"),
                     F.lit(r.kind).alias("kind"), F.col(f"__f{i}").cast("long").alias("failed_rows"),
                     F.col("__total").cast("long").alias("total_rows"))
            for i, r in enumerate(rs)]))
        frames.append(one.select(per_rule.alias("__r")).select("__r.*")
                      .withColumn("passed", F.col("failed_rows") == 0))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
