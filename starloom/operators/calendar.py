"""Generated calendars, built distributed with spark.range (no driver frame)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed calendar span of the source: 2018-01-01 through 2026-12-31.
DEFAULT_START = _dt.date(2018, 1, 1)
DEFAULT_END = _dt.date(2026, 12, 31)


def calendar(spark: SparkSession, start: _dt.date = DEFAULT_START,
             end: _dt.date = DEFAULT_END, col: str = "Date") -> DataFrame:
    """One row per day in [start, end]; ``col`` is a midnight TIMESTAMP."""
    n = max((end - start).days + 1, 0)
    return spark.range(0, n).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).cast("timestamp").alias(col))


def calendar_for(df: DataFrame, ts_col: str, col: str = "Date") -> DataFrame:
    """Whole calendar years spanning the values of ``ts_col``.

    The span comes from one min/max aggregate (two scalars on the driver);
    the days themselves are generated by spark.range across tasks.
    """
    r = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi")).first()
    if r["lo"] is None:
        return calendar(df.sparkSession, DEFAULT_START, DEFAULT_START - _dt.timedelta(days=1), col)
    return calendar(df.sparkSession, _dt.date(r["lo"].year, 1, 1), _dt.date(r["hi"].year, 12, 31), col)
