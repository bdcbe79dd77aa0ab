"""Aggregates kept up by deltas: signed change rows folded into a stored mart.

A change is a row with ``_sign`` +1 (it came) or -1 (it went); an update is
one of each, and n equal rows may be one row with n or -n. Counts and sums take the signed rows as they are. A minimum or
maximum takes a new value at once, and a value that went only matters if it
was the extreme itself: then, and only then, the group's rows are read again.
So a refresh costs the changes, plus the rows of the groups whose extreme went.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGN = "_sign"


def signed(came: DataFrame | None = None, went: DataFrame | None = None) -> DataFrame:
    """Change rows from the rows that came and those that went."""
    parts = [df.withColumn(SIGN, F.lit(s)) for df, s in ((came, 1), (went, -1)) if df is not None]
    if not parts:
        raise ValueError("no changes given")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def between(before: DataFrame, after: DataFrame) -> DataFrame:
    """The change rows from one version of a table to the next, in one aggregate over both: how often each row came (+) or went (-).

    Rows are compared by all their columns, NULL equal to NULL; what both
    versions hold equally often falls out.
    """
    cols = before.columns
    both = after.select(*cols).withColumn(SIGN, F.lit(1)).unionByName(before.withColumn(SIGN, F.lit(-1)))
    return both.groupBy(*cols).agg(F.sum(SIGN).cast("int").alias(SIGN)).where(F.col(SIGN) != 0)


def _same(a: list[str], b: list[str]) -> Column:
    on = F.lit(True)
    for x, y in zip(a, b, strict=True):
        on = on & F.col(x).eqNullSafe(F.col(y))
    return on


@dataclass(frozen=True)
class DeltaMart:
    """A mart of ``rows`` (a count), sums and extremes by ``dims``.

    sums, mins, maxs: result column -> SQL expression over the base rows.
    Sums should be of an exact type (integers, decimals), so that what is
    taken away is what was added.
    """

    dims: tuple[str, ...]
    sums: dict[str, str]
    mins: dict[str, str]
    maxs: dict[str, str]

    @property
    def columns(self) -> list[str]:
        return [*self.dims, "rows", *self.sums, *self.mins, *self.maxs]

    def build(self, base: DataFrame) -> DataFrame:
        """The mart from scratch. The sum of no values is 0."""
        return base.groupBy(*self.dims).agg(
            F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(F.expr(e)), F.lit(0)).alias(c) for c, e in self.sums.items()],
            *[F.min(F.expr(e)).alias(c) for c, e in self.mins.items()], *[F.max(F.expr(e)).alias(c) for c, e in self.maxs.items()])

    def _folded(self, changes: DataFrame) -> DataFrame:
        """The changes, one row a group: d_rows, d_<sum>, up_<extreme> (came) and down_<extreme> (went)."""
        s, came, went = F.col(SIGN), F.col(SIGN) > 0, F.col(SIGN) < 0
        aggs = [F.sum(s).cast("long").alias("d_rows")]
        aggs += [F.coalesce(F.sum(F.when(came, F.expr(e) * s)), F.lit(0)).alias(f"p_{c}") for c, e in self.sums.items()]
        aggs += [F.coalesce(F.sum(F.when(went, F.expr(e) * -s)), F.lit(0)).alias(f"m_{c}") for c, e in self.sums.items()]
        for kind, cols in ((F.min, self.mins), (F.max, self.maxs)):
            for c, e in cols.items():
                aggs += [kind(F.when(came, F.expr(e))).alias(f"up_{c}"), kind(F.when(went, F.expr(e))).alias(f"down_{c}")]
        return changes.groupBy(*[F.col(d).alias(f"d_{d}") for d in self.dims]).agg(*aggs)

    def merged(self, mart: DataFrame, changes: DataFrame) -> DataFrame:
        """The mart with the changes folded in, and ``reread``: an extreme went, so the group's rows must say what is next.

        Every group of either side is there, also one that has no rows left.
        """
        d = self._folded(changes)
        j = mart.join(d, _same(list(self.dims), [f"d_{x}" for x in self.dims]), "full_outer")
        there, rows = F.col("rows").isNotNull(), F.coalesce("rows", F.lit(0)) + F.coalesce("d_rows", F.lit(0))
        cols = [F.when(there, F.col(x)).otherwise(F.col(f"d_{x}")).alias(x) for x in self.dims]
        out = [rows.alias("rows")]
        for c in self.sums:
            kind = mart.schema[c].dataType
            zero = F.lit(0)
            out.append((F.coalesce(c, zero) + F.coalesce(f"p_{c}", zero) - F.coalesce(f"m_{c}", zero)).cast(kind).alias(c))
        reread = F.lit(False)
        for cols_of, best, reached in ((self.mins, F.least, lambda down, now: down <= now), (self.maxs, F.greatest, lambda down, now: down >= now)):
            for c in cols_of:
                # least and greatest skip NULLs
                now = best(F.col(c), F.col(f"up_{c}"))
                out.append(now.alias(c))
                reread = reread | F.coalesce(reached(F.col(f"down_{c}"), now), F.lit(False))
        return j.select(*cols, *out, (reread & (rows > 0)).alias("reread"))

    def apply(self, mart: DataFrame, changes: DataFrame, base: DataFrame) -> DataFrame:
        """The mart after the changes. ``base``: the rows as they are now; only groups with a lost extreme are read.

        A group without rows goes. NULL is a value of the dimensions.
        """
        m = self.merged(mart, changes)
        again = m.where("reread").select(*[F.col(d).alias(f"r_{d}") for d in self.dims])
        extremes = [*self.mins, *self.maxs]
        kept = m.where("not reread and rows > 0").select(*self.columns)
        if not extremes:
            return kept
        touched = base.join(again, _same(list(self.dims), [f"r_{d}" for d in self.dims]), "left_semi")
        anew = self.build(touched).select(*[F.col(d).alias(f"r_{d}") for d in self.dims], *[F.col(c).alias(f"r_{c}") for c in extremes])
        lost = m.where("reread").join(anew, _same(list(self.dims), [f"r_{d}" for d in self.dims]))
        return kept.unionByName(lost.select(*self.dims, "rows", *self.sums, *[F.col(f"r_{c}").alias(c) for c in extremes]))
