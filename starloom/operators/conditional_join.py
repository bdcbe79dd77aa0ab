"""Promotion matching: a left join on a CASE that returns a boolean.

    CASE WHEN month(BookDate) = M THEN BookDate BETWEEN ValidFrom AND ValidTo
         ELSE Qty BETWEEN VolumeStart AND VolumeEnd END

Spark can only run this as a nested loop. Both branches get an equi key that
is a necessary condition of the branch predicate:

* month M: the bucket (day, or year for coarse windows) of BookDate, probing
  the promotion validity windows exploded to their month-M buckets;
* otherwise (including NULL BookDate): the start of the fixed volume band the
  quantity falls in, probing each promotion's VolumeStart. Bands are disjoint
  and come from a fixed name table, so a matching promotion always has the
  band start of the line's quantity.

The key is a (kind, value) pair so one hash join serves both branches with a
single pass over the lines, and the exact CASE is kept as the residual.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.sizing import BROADCAST_MAX_ROWS, row_bound

# Fixed values (must equal the source rules): promotion name -> volume band.
#   'Volume Discount 11 to 20' -> 11 .. 20
#   'Volume Discount 21 to 40' -> 21 .. 40
#   'Volume Discount 41 to 60' -> 41 .. 60
#   'Volume Discount > 60'     -> 61 .. 9999999
#   any other name             -> NULL (never matches on quantity)
VOLUME_BANDS = (
    ("Volume Discount 11 to 20", 11, 20),
    ("Volume Discount 21 to 40", 21, 40),
    ("Volume Discount 41 to 60", 41, 60),
    ("Volume Discount > 60", 61, 9999999),
)
WINDOW_MONTH = 1  # the month in which validity windows decide (January)


def _name_case(name: Column, pick: int) -> Column:
    expr = None
    for band in VOLUME_BANDS:
        expr = (F.when(name == band[0], F.lit(band[pick])) if expr is None
                else expr.when(name == band[0], F.lit(band[pick])))
    return expr  # otherwise NULL


def with_volume_bands(promos: DataFrame, name_col: str = "PromotionName") -> DataFrame:
    """Add VolumeStart / VolumeEnd from the promotion name (value CASE)."""
    name = F.col(name_col)
    return promos.withColumn("VolumeStart", _name_case(name, 1)).withColumn(
        "VolumeEnd", _name_case(name, 2))


def band_start(qty: Column) -> Column:
    """Start of the band containing qty, NULL when in none."""
    expr = None
    for _, lo, hi in VOLUME_BANDS:
        cond = qty.between(lo, hi)
        expr = F.when(cond, F.lit(lo)) if expr is None else expr.when(cond, F.lit(lo))
    return expr


def case_predicate(date: Column, qty: Column, valid_from: Column, valid_to: Column,
                   vol_start: Column, vol_end: Column, month: int = WINDOW_MONTH) -> Column:
    """The source predicate, verbatim in meaning."""
    return (F.when(F.month(date) == month, date.between(valid_from, valid_to))
            .otherwise(qty.between(vol_start, vol_end)))


def _epoch_day(c: Column) -> Column:
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")


def _key_array(promos: DataFrame, vf: str, vt: str, month: int, unit: str) -> Column:
    """Per promotion, the array of (kind, key) pairs it can match:
    kind 0 = month-``month`` buckets of its validity window (epoch days, or
    years for coarse windows), kind 1 = the start of its volume band."""
    s, e = F.col(vf), F.col(vt)
    valid = s.isNotNull() & e.isNotNull() & (s <= e)
    if unit == "day":
        days = F.filter(F.sequence(F.to_date(s), F.to_date(e)), lambda d: F.month(d) == month)
        win = F.transform(days, lambda d: F.struct(F.lit(0).alias("kind"), _epoch_day(d).alias("key")))
    else:
        def overlaps(y):
            m_start = F.make_date(y, F.lit(month), F.lit(1))
            return (F.last_day(m_start) >= F.to_date(s)) & (m_start <= F.to_date(e))
        years = F.filter(F.sequence(F.year(s), F.year(e)), overlaps)
        win = F.transform(years, lambda y: F.struct(F.lit(0).alias("kind"), y.cast("long").alias("key")))
    empty = F.array().cast("array<struct<kind:int,key:bigint>>")
    win = F.when(valid, win).otherwise(empty)
    band = F.when(F.col("VolumeStart").isNotNull(),
                  F.array(F.struct(F.lit(1).alias("kind"), F.col("VolumeStart").cast("long").alias("key"))))
    return F.concat(win, F.coalesce(band, empty))


def promotion_join(lines: DataFrame, promos: DataFrame, date_col: str = "BookDate",
                   qty_col: str = "Qty", valid_from: str = "ValidFrom",
                   valid_to: str = "ValidTo", month: int = WINDOW_MONTH,
                   max_rows: int = BROADCAST_MAX_ROWS, rows_per_task: int = 1_000_000) -> DataFrame:
    """Left join lines to banded promotions (see module doc).

    ``promos`` must already carry VolumeStart / VolumeEnd out of the fixed
    bands (others raise ValueError: the band keys would not find them);
    column names of the two inputs must not overlap. Fan-out is kept: a line
    inside two windows yields two rows, as in the source.

    One aggregate over the promotions checks the bands and bounds the keys.
    If the key side is too large to broadcast, the join shuffles by day and
    band; a band holds about a fifth of all lines, so keys are salted, with
    as many salts as leave about ``rows_per_task`` lines of a band to a task.
    A line's salt is a hash of its row, the same whenever it is recomputed.
    """
    s, e = F.to_date(F.col(valid_from)), F.to_date(F.col(valid_to))
    valid = F.col(valid_from).isNotNull() & F.col(valid_to).isNotNull() & (F.col(valid_from) <= F.col(valid_to))
    banded = F.col("VolumeStart").isNotNull() | F.col("VolumeEnd").isNotNull()
    fixed = F.lit(False)
    for _, lo, hi in VOLUME_BANDS:
        fixed = fixed | (F.col("VolumeStart").eqNullSafe(F.lit(lo)) & F.col("VolumeEnd").eqNullSafe(F.lit(hi)))
    b = promos.agg(
        F.coalesce(F.sum(F.when(valid, F.datediff(e, s) + 1)), F.lit(0)).alias("d"),
        F.coalesce(F.sum(F.when(valid, F.year(e) - F.year(s) + 1)), F.lit(0)).alias("y"),
        F.count_if(banded).alias("q"), F.count_if(banded & ~fixed).alias("other")).first()
    if b["other"]:
        raise ValueError(f"{b['other']} promotions have a volume band that is none of {VOLUME_BANDS}")
    limit = row_bound(promos, max_rows)
    days, years = int(b["d"]) + int(b["q"]), int(b["y"]) + int(b["q"])
    unit = "year" if years <= limit < days else "day"
    small = min(days, years) <= limit

    # one pass over the promotions: each row explodes into all its keys
    keyed = (promos.withColumn("__k", F.explode(_key_array(promos, valid_from, valid_to, month, unit)))
                   .withColumn("__kind", F.col("__k.kind")).withColumn("__key", F.col("__k.key"))
                   .drop("__k"))
    d, q = F.col(date_col), F.col(qty_col)
    in_month = F.month(d) == month
    date_key = _epoch_day(d) if unit == "day" else F.year(d).cast("long")
    left = (lines
            .withColumn("__lkind", F.when(in_month, F.lit(0)).otherwise(F.lit(1)))
            .withColumn("__lkey", F.when(in_month, date_key)
                        .otherwise(band_start(q).cast("long"))))
    cond = ((F.col("__lkind") == F.col("__kind")) & (F.col("__lkey") == F.col("__key"))
            & case_predicate(d, q, F.col(valid_from), F.col(valid_to),
                             F.col("VolumeStart"), F.col("VolumeEnd"), month))
    if small:
        keyed = F.broadcast(keyed)
    else:
        salts = max(1, math.ceil(lines.count() / (len(VOLUME_BANDS) * rows_per_task)))
        left = left.withColumn("__lsalt", F.pmod(F.xxhash64(*lines.columns), F.lit(salts)))
        keyed = keyed.withColumn("__salt", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
        cond = cond & (F.col("__lsalt") == F.col("__salt"))
    out = left.join(keyed, cond, "left")
    return out.drop("__lkind", "__lkey", "__kind", "__key", "__lsalt", "__salt")
