"""Checks over time: each run's metrics against the metric's own history.

A metric is one number a run (a day's load, say) and column: rows, share of
NULLs, mean, distinct values. Its bounds are the median of the preceding runs
plus and minus a multiple of their median absolute deviation, which a few odd
runs do not move. Every run gets a verdict with its reason.

Metrics are one aggregate over the data, however many there are; what follows
works on a row for each run and metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Preceding runs that bound a run, the least that must be there, the multiple
#: of the deviation (1.4826 makes it a standard deviation under normal noise),
#: and the least width as a share of the median, so that a metric that never
#: moved does not alarm at a rounding error.
RUNS, LEAST_RUNS, TIMES, SCALE, FLOOR = 14, 5, 4.0, 1.4826, 0.01


def metric_history(df: DataFrame, run: Column, columns: list[str], numeric: list[str]) -> DataFrame:
    """run, metric, column, value: rows of the run, each column's NULL share, each numeric column's mean."""
    rows = F.count(F.lit(1))
    made = [("rows", None, rows.cast("double"))]
    made += [("null_share", c, F.count_if(F.col(c).isNull()).cast("double") / rows) for c in columns]
    # summed as decimals, so that the mean does not depend on the order of the rows
    made += [("mean", c, F.sum(F.col(c).cast("decimal(30,6)")).cast("double") / F.nullif(F.count(c), F.lit(0))) for c in numeric]
    one = df.groupBy(run.alias("run")).agg(*[m.alias(f"m{i}") for i, (_, _, m) in enumerate(made)])
    long = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.lit(c).cast("string").alias("column"), F.col(f"m{i}").alias("value"))
                               for i, (n, c, _) in enumerate(made)]))
    return one.select("run", long.alias("x")).select("run", "x.*")


def _median(xs: Column) -> Column:
    """The middle of a sorted array of numbers, or the mean of the two middle ones; NULL if empty."""
    n = F.size(xs)
    mid = lambda at: F.try_element_at(xs, at.cast("int"))
    return F.when(n > 0, (mid(F.floor((n + 1) / 2)) + mid(F.floor(n / 2) + 1)) / 2)


def verdicts(history: DataFrame, runs: int = RUNS, least: int = LEAST_RUNS, times: float = TIMES, floor: float = FLOOR,
             by: tuple[str, ...] = ("metric", "column")) -> DataFrame:
    """``history`` with n_before, median, mad, low, high, verdict (ok, alarm or unknown) and reason.

    A run's own value and later ones never count for its bounds. Runs without
    a value (NULL) are no history and get ``alarm`` where there is one.
    """
    before = Window.partitionBy(*by).orderBy("run").rowsBetween(-runs, -1)
    h = history.withColumn("__past", F.sort_array(F.collect_list("value").over(before)))  # at most ``runs`` values
    h = h.withColumn("n_before", F.size("__past").cast("long")).withColumn("median", _median(F.col("__past")))
    off = F.sort_array(F.transform("__past", lambda v: F.abs(v - F.col("median"))))
    h = h.withColumn("mad", _median(off))
    width = F.greatest(F.lit(times * SCALE) * F.col("mad"), F.lit(floor) * F.abs("median"))
    h = h.withColumn("low", F.col("median") - width).withColumn("high", F.col("median") + width)
    known = F.col("n_before") >= least
    verdict = (F.when(~known, F.lit("unknown")).when(F.col("value").isNull() | (F.col("value") < F.col("low")) | (F.col("value") > F.col("high")), F.lit("alarm"))
               .otherwise(F.lit("ok")))
    reason = (F.when(~known, F.lit("too few runs before")).when(F.col("value").isNull(), F.lit("no value"))
              .when(F.col("value") < F.col("low"), F.lit("below the bound")).when(F.col("value") > F.col("high"), F.lit("above the bound"))
              .otherwise(F.lit("within bounds")))
    return h.withColumn("verdict", verdict).withColumn("reason", reason).drop("__past")
