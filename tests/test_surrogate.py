from pyspark.sql import functions as F

from starloom.operators.surrogate import dense_number, dimension_after, incremental_keys

DDL = "PaymentTypeId int, PaymentTypeDesc string"


def _src(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "PaymentTypeDesc string")


def _dim(df):
    return sorted(((r.PaymentTypeDesc, r.PaymentTypeId) for r in df.collect()),
                  key=lambda t: (t[0] is not None, t[0] or "", t[1]))


def test_empty_target_then_rerun_then_new_member(spark):
    src = _src(spark, ["Card", "Cash", "Card", None, "Wire"])
    empty = spark.createDataFrame([], DDL)
    d1 = dimension_after(src, empty, "PaymentTypeDesc", "PaymentTypeId")
    assert _dim(d1) == [("Card", 1), ("Cash", 2), ("Wire", 3)]
    d1 = spark.createDataFrame(d1.collect(), DDL)
    # rerun with nothing new appends nothing
    assert incremental_keys(src, d1, "PaymentTypeDesc", "PaymentTypeId").count() == 0
    # a new member continues after the max id; old ids unchanged
    src2 = src.unionByName(_src(spark, ["PayPal"]))
    add = incremental_keys(src2, d1, "PaymentTypeDesc", "PaymentTypeId")
    assert [(r.PaymentTypeDesc, r.PaymentTypeId) for r in add.collect()] == [("PayPal", 4)]
    assert add.schema["PaymentTypeId"].dataType.simpleString() == "int"


def test_null_member_parity_option(spark):
    src = _src(spark, ["b", None, "a"])
    empty = spark.createDataFrame([], DDL)
    add = incremental_keys(src, empty, "PaymentTypeDesc", "PaymentTypeId", keep_null=True)
    assert _dim(add) == [(None, 1), ("a", 2), ("b", 3)]
    existing = spark.createDataFrame([(1, None)], DDL)
    # NULL = NULL for the membership test, as in EXCEPT ALL
    add2 = incremental_keys(src, existing, "PaymentTypeDesc", "PaymentTypeId", keep_null=True)
    assert _dim(add2) == [("a", 2), ("b", 3)]


def test_gaps_in_existing_ids(spark):
    existing = spark.createDataFrame([(1, "a"), (4, "d")], DDL)
    add = incremental_keys(_src(spark, ["a", "d", "c", "b"]), existing, "PaymentTypeDesc", "PaymentTypeId")
    assert _dim(add) == [("b", 5), ("c", 6)]


def test_distributed_numbering_equals_window(spark):
    df = spark.range(0, 5000).select(F.format_string("m%05d", (F.col("id") * 7919) % 5000).alias("m"))
    small = dense_number(df, "m", "id", offset=10)
    big = dense_number(df, "m", "id", offset=10, partitions=7)
    a = sorted((r.m, r.id) for r in small.collect())
    b = sorted((r.m, r.id) for r in big.collect())
    assert a == b
    assert a[0] == ("m00000", 11) and a[-1] == ("m04999", 5010)


def test_identity_like_vertical_keys(spark):
    from starloom.plans.dims import new_verticals
    w = spark.createDataFrame([(" Sales ",), ("Sales",), ("Data & AI",), (None,)], "Vertical string")
    empty = spark.createDataFrame([], "VerticalId bigint, Vertical string")
    add = new_verticals(w, empty)
    assert sorted((r.Vertical, r.VerticalId) for r in add.collect()) == [("Data & AI", 1), ("Sales", 2)]
    assert add.schema["VerticalId"].dataType.simpleString() == "bigint"
