"""The literal nested-loop forms of the keyed joins: what the tests and the
benchmark hold them against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.conditional_join import WINDOW_MONTH, case_predicate


def interval_join_nested(points: DataFrame, intervals: DataFrame, point: str,
                         start: str, end: str, how: str = "left") -> DataFrame:
    """The literal non-equi form (nested-loop plan)."""
    cond = (F.col(point) >= F.col(start)) & (F.col(point) <= F.col(end))
    return points.join(intervals, cond, how)


def promotion_join_nested(lines: DataFrame, promos: DataFrame, date_col: str = "BookDate",
                          qty_col: str = "Qty", valid_from: str = "ValidFrom",
                          valid_to: str = "ValidTo", month: int = WINDOW_MONTH) -> DataFrame:
    """Literal CASE join (nested loop); reference semantics for tests."""
    cond = case_predicate(F.col(date_col), F.col(qty_col), F.col(valid_from),
                          F.col(valid_to), F.col("VolumeStart"), F.col("VolumeEnd"), month)
    return lines.join(promos, cond, "left")
