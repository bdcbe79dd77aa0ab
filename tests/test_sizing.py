from pyspark.sql import functions as F

from starloom.operators.sizing import row_bound, row_width


def test_row_bound_respects_bytes(spark):
    narrow = spark.range(0, 10).select(F.col("id"))
    wide = spark.range(0, 10).select(*[F.col("id").cast("string").alias(f"s{i}") for i in range(50)])
    assert row_width(narrow) == 16 + 8 and row_width(wide) == 16 + 50 * 48
    assert row_bound(narrow, max_rows=1000) == 1000
    assert row_bound(wide, max_rows=10 ** 9, max_bytes=10 ** 6) == 10 ** 6 // (16 + 50 * 48)
