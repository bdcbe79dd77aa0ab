"""Z-order layout: rows that are near in several columns come to lie in the same files.

Each column's values become ranks between the column's own quantiles, so that
skew and units do not matter; the ranks' bits are interleaved into one number,
and the rows are range-partitioned and sorted by it. Parquet's minimum and
maximum of a file are then narrow in every one of the columns, and a filter on
any of them skips files.

The quantiles of all columns are one aggregate of bounded sketches; only the
bounds reach the driver. Ranks and interleaving are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a rank: 2 ** BITS - 1 bounds a column.
BITS = 6
#: Accuracy of the quantiles: an error of one in so many rows. Exact for fewer rows.
ACCURACY = 100_000


def quantile_bounds(df: DataFrame, cols: list[str], bits: int = BITS, accuracy: int = ACCURACY) -> dict[str, list]:
    """The bounds between equal shares of each column's values, ascending, repeated ones once."""
    n = 1 << bits
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    numeric = {c: _number(df, c) for c in cols}
    row = df.agg(*[F.approx_percentile(numeric[c], shares, F.lit(accuracy)).alias(c) for c in cols]).first()
    return {c: sorted(set(row[c] or [])) for c in cols}


def _number(df: DataFrame, c: str) -> Column:
    """A column as something that quantiles are taken of: dates and timestamps by their count of days or microseconds."""
    kind = df.schema[c].dataType.simpleString()
    if kind == "date":
        return F.unix_date(c)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(c).cast("timestamp"))
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.col(c)
    raise TypeError(f"{c} is a {kind}; Z-order takes numbers, dates and timestamps")


def rank(x: Column, bounds: list) -> Column:
    """How many bounds are at or below x, by a binary search of comparisons; NULL has rank 0."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x < F.lit(bounds[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))
    return F.when(x.isNull(), F.lit(0)).otherwise(search(0, len(bounds))).cast("long")


def interleave(ranks: list[Column], bits: int = BITS) -> Column:
    """Bit b of rank j becomes bit b * len(ranks) + j."""
    if bits * len(ranks) > 62:
        raise ValueError(f"{len(ranks)} ranks of {bits} bits do not fit into a long")
    out = F.lit(0).cast("long")
    for b in range(bits):
        for j, r in enumerate(ranks):
            out = out + F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long")), b * len(ranks) + j)
    return out


def z_value(df: DataFrame, cols: list[str], bits: int = BITS, accuracy: int = ACCURACY) -> Column:
    """The z-value of a row of ``df``; runs the one aggregate for the bounds."""
    bounds = quantile_bounds(df, cols, bits, accuracy)
    return interleave([rank(_number(df, c), bounds[c]) for c in cols], bits)


def write_zordered(df: DataFrame, path: str, cols: list[str], files: int | None = None, bits: int = BITS, fmt: str = "parquet") -> None:
    """Full overwrite of ``path`` in Z-order of ``cols``, in about ``files`` files (default: shuffle partitions).

    Equal z-values can share a file only up to a bound, as ties are ordered by
    the columns themselves.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = "__z"
    keys = [F.col(name), *[F.col(c) for c in cols]]
    (df.withColumn(name, z_value(df, cols, bits)).repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop(name)
       .write.format(fmt).mode("overwrite").save(path))
