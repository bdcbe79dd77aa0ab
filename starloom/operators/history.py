"""History and incremental loading: neighbours in key order, SCD type 2 from a
feed or merged into a stored history, snapshot change detection, upsert without MERGE, high-water-mark loads.

``neighbor_in_key`` is the skew-safe alternative to lag/lead over
``Window.partitionBy(key)``: rows are range-partitioned on (key, order), so
a key holding a third of all rows is spread over many tasks. Each range
partition computes its neighbours locally; the first (or last) row of every
(partition, key) slice takes its neighbour from a summary with one row per
(partition, key) slice, ordered over partitions. The partitioned rows are
checkpointed once so every use sees the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.conform import change_hash
from starloom.operators.quality import keep_latest
from starloom.session import checkpoint_dir


def neighbor_in_key(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
                    direction: str = "prev", prefix: str | None = None,
                    partitions: int | None = None) -> DataFrame:
    """Add ``<prefix><c>`` = value of ``c`` on the previous ('prev') or next
    ('next') row of the same key in ``order`` (a total order within the key),
    NULL at the ends."""
    if direction not in ("prev", "next"):
        raise ValueError(direction)
    prefix = prefix if prefix is not None else f"{direction}_"
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(c).asc_nulls_first() for c in keys + order]
    parts = (df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
               .withColumn("__pid", F.spark_partition_id())
               .checkpoint(eager=True))
    w_local = Window.partitionBy("__pid", *keys).orderBy(*[F.col(c) for c in order])
    step = F.lag if direction == "prev" else F.lead
    local = parts
    for c in cols:
        local = local.withColumn(f"{prefix}{c}", step(F.col(c), 1).over(w_local))
    local = local.withColumn("__edge", step(F.lit(1), 1).over(w_local).isNull())

    # one row per (partition, key) slice: its first and last row's values
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"__v_{c}") for c in cols])
    summary = parts.groupBy("__pid", *keys).agg(F.min(packed).alias("__first"),
                                               F.max(packed).alias("__last"))
    # per key, slices ordered by partition: a key has at most n slices
    w_slices = Window.partitionBy(*keys).orderBy("__pid")
    if direction == "prev":
        src = F.lag(F.col("__last"), 1).over(w_slices)
    else:
        src = F.lead(F.col("__first"), 1).over(w_slices)
    fix = summary.select("__pid", *keys, src.alias("__nb"))
    fix = fix.select("__pid", *[F.col(k).alias(f"__k_{k}") for k in keys],
                     *[F.col("__nb")[f"__v_{c}"].alias(f"__f_{c}") for c in cols])

    edges = local.filter(F.col("__edge"))
    inner = local.filter(~F.col("__edge"))
    cond = F.col("__pid") == F.col("__fpid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    fix = fix.withColumnRenamed("__pid", "__fpid")
    edges = edges.join(fix, cond, "left")
    for c in cols:
        edges = edges.withColumn(f"{prefix}{c}", F.col(f"__f_{c}"))
    edges = edges.select(*inner.columns)
    return inner.unionByName(edges).drop("__pid", "__edge")


#: Rows of one key that a task may hold; above, a key's rows are spread over tasks.
KEY_ROWS = 1_000_000


def has_large_key(df: DataFrame, keys: list[str], rows: int = KEY_ROWS) -> bool:
    """Does any key hold more than ``rows`` rows? One aggregate with a map-side step; a single number comes back."""
    most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("m")).first()["m"]
    return (most or 0) > rows


def scd2(changes: DataFrame, keys: list[str], ts: str, tracked: list[str],
         tiebreak: list[str] | None = None, split_keys: bool | None = None, keep_order: bool = False) -> DataFrame:
    """Validity intervals from a change feed.

    A new version starts at a key's first row and wherever any tracked
    column differs (NULL-safe) from the key's previous row; it is valid until
    the next version starts (ValidTo NULL and IsCurrent for the last one).
    ``ts`` plus ``tiebreak`` must order each key's rows totally.
    Output: keys, tracked columns, ValidFrom, ValidTo, IsCurrent, VersionHash;
    with ``keep_order`` also the tiebreak columns of the row that starts the
    version, which ``scd2_merge`` needs.

    Both steps are windows over the key, which share one shuffle and sort. If
    single keys hold too many rows for a task, ``split_keys`` works them out
    by ``neighbor_in_key`` instead, at the cost of two checkpoints; by default
    the largest key's count decides (``has_large_key``).
    """
    order = [ts] + (tiebreak or [])
    if split_keys is None:
        split_keys = has_large_key(changes, keys)
    base = changes.select(*keys, *order, *[c for c in tracked if c not in order]).withColumn("__one", F.lit(1))
    seen = [*tracked, "__one"]
    if split_keys:
        with_prev = neighbor_in_key(base, keys, order, seen, "prev", prefix="__p_")
    else:
        w = Window.partitionBy(*keys).orderBy(*order)
        with_prev = base.select("*", *[F.lag(c).over(w).alias(f"__p_{c}") for c in seen])
    start = F.col("__p___one").isNull()
    for c in tracked:
        start = start | ~F.col(c).eqNullSafe(F.col(f"__p_{c}"))
    starts = with_prev.filter(start).select(*base.columns)
    if split_keys:
        nxt = neighbor_in_key(starts, keys, order, [ts], "next", prefix="__n_")
    else:
        nxt = starts.withColumn(f"__n_{ts}", F.lead(ts).over(w))
    return nxt.select(
        *keys, *tracked,
        F.col(ts).alias("ValidFrom"),
        F.col(f"__n_{ts}").alias("ValidTo"),
        F.col(f"__n_{ts}").isNull().alias("IsCurrent"),
        change_hash(*tracked).alias("VersionHash"),
        *(tiebreak or [] if keep_order else []),
    )


def _on(keys: list[str], prefix: str):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return cond


def scd2_merge(history: DataFrame, log: DataFrame, batch: DataFrame, keys: list[str], ts: str, tracked: list[str],
               tiebreak: list[str] | None = None, split_keys: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """A stored SCD2 history and its change log, after a batch of new and late rows.

    history: what ``scd2(..., keep_order=True)`` gave for ``log``; log: keys, ts,
    tiebreak and tracked columns of all rows so far. Returns (history, log).

    Only the batch's keys are touched, and of each only what follows the last
    row before the batch's first one (``pivot``): versions that started up to
    the pivot stay as they are, but for the last one's end; later ones are
    worked out again from the pivot, the log's rows behind it and the batch.
    So rows may come in any order, and a row that was delivered before (same
    key and order) changes nothing. The result equals ``scd2`` over the whole
    feed. NULL is a value of keys and tracked columns; ts and tiebreak are not NULL.
    """
    order = [ts] + (tiebreak or [])
    rows = [*keys, *order, *[c for c in tracked if c not in order]]
    log, batch = log.select(*rows), batch.select(*rows)
    rest = [c for c in rows if c not in keys and c not in order]
    # one row for each key and order, the log's before the batch's, the least of the batch's own
    seen = F.struct(F.col("__new"), *[F.col(c) for c in rest])
    mine = batch.groupBy(*keys, *order).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("__v"))
    mine = mine.select(*keys, *order, *[F.col("__v")[c].alias(c) for c in rest])
    at = F.struct(*[F.col(c) for c in order])
    first = mine.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(F.min(at).alias("__first"))
    touched = log.join(first, _on(keys, "__k_"))
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    pivots = touched.where(at < F.col("__first")).groupBy(*keys).agg(F.max(packed).alias("__p"))
    pivot_rows = pivots.select(*keys, *[F.col("__p")[c].alias(c) for c in [*order, *rest]])
    behind = touched.where(at >= F.col("__first")).select(*rows)
    both = behind.withColumn("__new", F.lit(0)).unionByName(mine.withColumn("__new", F.lit(1)))
    tail = both.groupBy(*keys, *order).agg(F.min(seen).alias("__v"))
    fresh = tail.where(F.col("__v")["__new"] == 1).select(*keys, *order, *[F.col("__v")[c].alias(c) for c in rest])
    tail = tail.select(*keys, *order, *[F.col("__v")[c].alias(c) for c in rest])
    again = scd2(pivot_rows.unionByName(tail), keys, ts, tracked, tiebreak, split_keys, keep_order=True)

    # the batch's keys, with their pivot where they have one
    bounds = first.join(pivots.select(*[F.col(k).alias(f"__q_{k}") for k in keys], F.struct(*[F.col("__p")[c].alias(c) for c in order]).alias("__pivot")),
                        _same_keys(keys), "left").select(*[f"__k_{k}" for k in keys], "__pivot")
    start = F.struct(F.col("ValidFrom").alias(ts), *[F.col(c) for c in tiebreak or []])
    cols = [*keys, *tracked, "ValidFrom", "ValidTo", "IsCurrent", "VersionHash", *(tiebreak or [])]
    untouched = history.join(bounds, _on(keys, "__k_"), "left_anti").select(*cols)
    before = history.join(bounds, _on(keys, "__k_")).where(start <= F.col("__pivot")).withColumn("__start", start)
    redone = again.join(bounds, _on(keys, "__k_"), "left").withColumn("__start", start)
    new = redone.where(F.col("__pivot").isNull() | (F.col("__start") > F.col("__pivot"))).select(*cols)
    # the version that the pivot is in: the last that started up to it; its end is that of the redone version at the pivot
    end = (redone.where(F.col("__start") == F.col("__pivot"))
           .select(*[F.col(k).alias(f"__e_{k}") for k in keys], F.col("ValidTo").alias("__to")))
    last = before.groupBy(*[F.col(k).alias(f"__l_{k}") for k in keys]).agg(F.max("__start").alias("__last"))
    ends = last.join(end, _same_keys(keys, "__l_", "__e_")).select(*[f"__l_{k}" for k in keys], "__last", "__to")
    kept = before.join(ends, _on(keys, "__l_"), "left")
    is_last = F.coalesce(F.col("__start") == F.col("__last"), F.lit(False))
    kept = kept.select(*[F.when(is_last, F.col("__to")).otherwise(F.col("ValidTo")).alias(c) if c == "ValidTo"
                         else F.when(is_last, F.col("__to").isNull()).otherwise(F.col("IsCurrent")).alias(c) if c == "IsCurrent"
                         else F.col(c) for c in cols])
    return untouched.unionByName(kept).unionByName(new), log.unionByName(fresh.select(*rows))


def _same_keys(keys: list[str], left: str = "__k_", right: str = "__q_"):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}"))
    return cond


def snapshot_changes(before: DataFrame, after: DataFrame, keys: list[str],
                     compare: list[str]) -> DataFrame:
    """Keys whose row was inserted, deleted or updated between two snapshots
    (one row per key each). Rows are compared by a NULL-aware change hash,
    with an exact NULL-safe comparison as the final word."""
    b = before.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in compare],
                      F.lit(True).alias("__in_b"))
    a = after.select(*[F.col(k).alias(f"__a_{k}") for k in keys], *compare,
                     F.lit(True).alias("__in_a"))
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"__a_{k}"))
        cond = e if cond is None else (cond & e)
    j = b.join(a, cond, "full_outer")
    in_b = F.col("__in_b").isNotNull()
    in_a = F.col("__in_a").isNotNull()
    same = F.lit(True)
    for c in compare:
        same = same & F.col(c).eqNullSafe(F.col(f"__b_{c}"))
    hb = change_hash(*[F.col(f"__b_{c}") for c in compare])
    ha = change_hash(*[F.col(c) for c in compare])
    kind = (F.when(~in_a, F.lit("delete")).when(~in_b, F.lit("insert"))
             .when((ha != hb) | ~same, F.lit("update")))
    out = j.select(*[F.coalesce(F.col(k), F.col(f"__a_{k}")).alias(k) for k in keys],
                   kind.alias("change"))
    return out.filter(F.col("change").isNotNull())


def upsert(target: DataFrame, updates: DataFrame, keys: list[str],
           order: list[str] | None = None) -> DataFrame:
    """MERGE-free upsert: every update row, plus target rows whose key is not
    updated (NULL-safe key match). Columns follow ``target``; an update with
    other columns raises.

    With ``order``, the row with the larger order tuple wins (an update wins
    ties), so a late row never replaces a newer one; both sides hold one row
    per key. It is one aggregate over both sides, so nothing depends on which
    of them is larger.
    """
    mine, theirs = {c.lower() for c in target.columns}, {c.lower() for c in updates.columns}
    if mine != theirs:
        raise ValueError(f"an upsert needs the same columns on both sides; they differ in {sorted(mine ^ theirs)}")
    u = updates.select(*target.columns)
    if order:
        rest = [c for c in target.columns if c not in keys]
        packed = F.struct(*[F.col(c) for c in order], F.col("__new"), *[F.col(c) for c in rest if c not in order])
        both = target.withColumn("__new", F.lit(0)).unionByName(u.withColumn("__new", F.lit(1)))
        best = both.groupBy(*keys).agg(F.max(packed).alias("__best"))
        return best.select(*[F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in target.columns])
    cond = None
    uk = u.select(*[F.col(k).alias(f"__u_{k}") for k in keys]).distinct()
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"__u_{k}"))
        cond = e if cond is None else (cond & e)
    kept = target.join(uk, cond, "left_anti")
    return kept.unionByName(u)


def incremental_after(df: DataFrame, ts: str, watermark, keys: list[str] | None = None,
                      order: list[str] | None = None, inclusive: bool = False) -> DataFrame:
    """Rows newer than the high-water mark; with ``keys``, only the latest
    row per key (skew-safe aggregate, see keep_latest).

    Rows without a timestamp are loaded by every run, as no run could tell
    that it is their turn; ``inclusive`` also takes the rows at the mark,
    for sources that go on writing at their last timestamp. An upsert makes
    both harmless.
    """
    mark = F.lit(watermark).cast(df.schema[ts].dataType)
    newer = F.col(ts) >= mark if inclusive else F.col(ts) > mark
    fresh = df.filter(newer | F.col(ts).isNull())
    if not keys:
        return fresh
    return keep_latest(fresh, keys, order or [ts])


def high_water_mark(df: DataFrame, ts: str):
    """max(ts) of what was loaded: the next run's watermark (a scalar)."""
    return df.agg(F.max(ts).alias("m")).first()["m"]
