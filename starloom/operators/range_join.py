"""Interval (range) join: point BETWEEN start AND end, inclusive.

Spark plans a non-equi join as a nested loop (O(n*m)). Here the interval side
is exploded into calendar buckets (day, month or year) and joined on the
bucket with the exact predicate kept as a residual, so the big point side is
never exploded or shuffled when the interval side is broadcastable.

The bucket is a necessary condition: point in [start, end] implies
to_date(point) lies in [to_date(start), to_date(end)], and so does its
month/year truncation. Intervals with a NULL bound or start > end can never
satisfy the predicate, so they are dropped before exploding (without that,
``sequence`` would count backwards over an inverted interval).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.sizing import BROADCAST_MAX_ROWS, row_bound

_UNITS = ("day", "month", "year")


def bucket_of(c: Column, unit: str) -> Column:
    d = F.to_date(c)
    if unit == "day":
        return d
    if unit == "month":
        return F.trunc(d, "MM")
    if unit == "year":
        return F.trunc(d, "YEAR")
    raise ValueError(unit)


def _valid(start: str, end: str) -> Column:
    return F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end))


def _span_counts(intervals: DataFrame, start: str, end: str) -> dict[str, int]:
    """Buckets of each unit that the intervals explode into; inverted and open ones add nothing."""
    s, e = F.to_date(F.col(start)), F.to_date(F.col(end))
    row = intervals.filter(_valid(start, end)).agg(
        F.coalesce(F.sum(F.datediff(e, s) + 1), F.lit(0)).alias("day"),
        F.coalesce(F.sum(F.months_between(F.trunc(e, "MM"), F.trunc(s, "MM")).cast("long") + 1),
                   F.lit(0)).alias("month"),
        F.coalesce(F.sum(F.year(e) - F.year(s) + 1), F.lit(0)).alias("year"),
    ).first()
    return {u: int(row[u]) for u in _UNITS}


def choose_unit(intervals: DataFrame, start: str, end: str,
                max_rows: int = BROADCAST_MAX_ROWS, unit: str | None = None) -> tuple[str, bool]:
    """(unit, broadcastable): the finest bucket (or the one asked for) whose
    exploded size is at most max_rows; the finest of all where none is, since
    a shuffle gains from small buckets. One aggregate over the interval side."""
    counts = _span_counts(intervals, start, end)
    for u in _UNITS if unit is None else (unit,):
        if counts[u] <= max_rows:
            return u, True
    return unit or _UNITS[0], False


def explode_buckets(intervals: DataFrame, start: str, end: str, unit: str,
                    bucket_col: str = "__bucket", between: tuple | None = None) -> DataFrame:
    """A row for each bucket an interval touches, ``between`` two dates if given."""
    s, e = F.col(start), F.col(end)
    valid = intervals.filter(_valid(start, end))
    first, last = F.to_date(s), F.to_date(e)
    if between:
        lo, hi = (F.lit(d).cast("date") for d in between)
        valid = valid.filter((last >= lo) & (first <= hi))
        first, last = F.greatest(first, lo), F.least(last, hi)
    step = {"day": "interval 1 day", "month": "interval 1 month", "year": "interval 1 year"}[unit]
    return valid.withColumn(
        bucket_col,
        F.explode(F.sequence(bucket_of(first, unit), bucket_of(last, unit), F.expr(step))),
    )


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str,
                  end: str, how: str = "left", unit: str | None = None,
                  max_rows: int = BROADCAST_MAX_ROWS, rows_per_task: int = 1_000_000) -> DataFrame:
    """``points`` joined to ``intervals`` where start <= point <= end.

    Column names of the two sides must not overlap (rename first).
    ``how`` is 'left' or 'inner'. Unmatched points keep NULL interval columns
    for 'left'; a point inside several intervals yields one row per interval.

    One aggregate over the intervals picks the finest bucket whose exploded
    side may be broadcast. Only if there is none, a second one over the points
    gives their first and last day, to which the buckets are clamped (an end in
    9999 then costs no more than the data's last day), and their number. If
    the clamped side is still too large, both sides shuffle by day, with as
    many salts as leave about ``rows_per_task`` points to a task on average; a
    point's salt is a hash of its row, so a recomputed task deals it the same.
    """
    if how not in ("left", "inner"):
        raise ValueError("interval_join supports 'left' and 'inner'")
    bound = row_bound(intervals, max_rows)
    unit, small = choose_unit(intervals, start, end, bound, unit)
    between, salts = None, 1
    if not small:
        day = F.to_date(F.col(point))
        r = points.agg(F.min(day).alias("lo"), F.max(day).alias("hi"), F.count(day).alias("n")).first()
        if r["n"]:
            between = (r["lo"], r["hi"])
            clamped = intervals.filter(_valid(start, end)).select(
                F.greatest(F.to_date(F.col(start)), F.lit(r["lo"])).alias("__s"),
                F.least(F.to_date(F.col(end)), F.lit(r["hi"])).alias("__e"))
            unit, small = choose_unit(clamped, "__s", "__e", bound)
            salts = max(1, math.ceil(r["n"] / (((r["hi"] - r["lo"]).days + 1) * rows_per_task)))
    right = explode_buckets(intervals, start, end, unit, "__ib", between)
    left = points.withColumn("__pb", bucket_of(F.col(point), unit))
    cond = (
        (F.col("__pb") == F.col("__ib"))
        & (F.col(point) >= F.col(start))
        & (F.col(point) <= F.col(end))
    )
    if small:
        right = F.broadcast(right)
    elif salts > 1:
        left = left.withColumn("__ps", F.pmod(F.xxhash64(*points.columns), F.lit(salts)))
        right = right.withColumn("__is", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
        cond = cond & (F.col("__ps") == F.col("__is"))
    return left.join(right, cond, how).drop("__pb", "__ib", "__ps", "__is")
