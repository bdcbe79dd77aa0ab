"""The row bound under which a side may be broadcast explicitly.

Lookups carry no hint: Spark decides by file sizes and run-time statistics.
Only the bucketed joins, whose exploded size is known from one aggregate,
broadcast by hand, and only under this bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Bounds under which a side is broadcast: at most 2M rows and at most
# 512 MB by the width estimate below, far under the 8 GB broadcast ceiling.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 512 * 1024 * 1024

# Assumed bytes per value when estimating a row's width (strings and nested
# values are taken at a generous average, fixed-width types at their size).
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
          T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DecimalType: 16, T.StringType: 48, T.BinaryType: 64}


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row (plus a fixed per-row overhead)."""
    return 16 + sum(_WIDTH.get(type(f.dataType), 128) for f in df.schema.fields)


def row_bound(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
              max_bytes: int = BROADCAST_MAX_BYTES) -> int:
    """Largest row count of ``df`` that is still safe to broadcast."""
    return max(0, min(max_rows, max_bytes // row_width(df)))
