from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.functions.casts import align, trim_or_keep, typed, typed_projection, validate
from tiers.specs import FERTILIZER

WHOLE = [
    ("7", 7),
    (" 7 ", 7),
    ("\t7\n", 7),
    ("+7", 7),
    ("-7", -7),
    ("007", 7),
    ("1.5", 1),
    ("-1.9", -1),
    ("1.", 1),
    (" 12.0 ", 12),
    (".5", 0),
    ("-.5", 0),
    (".", None),
    ("+.", None),
    ("", None),
    (" ", None),
    ("-", None),
    ("1e3", None),
    ("1,000", None),
    ("1 2", None),
    ("1.2.3", None),
    ("5mg", None),
    ("NaN", None),
    (None, None),
]


def one_column(spark, values, name="c"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("kind", [T.LongType(), T.IntegerType()])
def test_whole_numbers(spark, kind):
    df = one_column(spark, [text for text, _ in WHOLE])
    got = df.select("c", typed(F.col("c"), kind).alias("v"))
    assert got.schema["v"].dataType == kind
    assert [tuple(r) for r in got.collect()] == WHOLE


def test_whole_numbers_out_of_range(spark):
    texts = ["2147483647", "2147483648", "-2147483649.5", "9223372036854775807", "9223372036854775808"]
    df = one_column(spark, texts)
    rows = df.select(typed(F.col("c"), T.IntegerType()), typed(F.col("c"), T.LongType())).collect()
    assert [r[0] for r in rows] == [2147483647, None, None, None, None]
    assert [r[1] for r in rows] == [2147483647, 2147483648, -2147483649, 9223372036854775807, None]


def test_dates_and_times(spark):
    texts = ["2024-01-05", "2024-1-5", "2024-01-05 10:20:00", " 2024-01-05 ", "2024-13-01", "soon", "", None]
    rows = one_column(spark, texts).select(typed(F.col("c"), T.DateType()), typed(F.col("c"), T.TimestampType()))
    got = rows.collect()
    day = date(2024, 1, 5)
    assert [r[0] for r in got] == [day, day, day, day, None, None, None, None]
    assert got[2][1] == datetime(2024, 1, 5, 10, 20)
    assert [r[1] for r in got[4:]] == [None] * 4


def test_trim_or_keep(spark):
    df = one_column(spark, [" 42 ", "1.5", " A-17 ", "", None])
    assert [r[0] for r in df.select(trim_or_keep(F.col("c"))).collect()] == ["42", "1", "A-17", "", None]


def test_validate_flags_and_keeps_the_original(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])
    df = spark.createDataFrame([("1.5", "a", 1), ("x", "b", 2), (None, None, 3)], "n string, s string, extra int")
    got = validate(df, schema, keep=["extra"])
    assert got.columns == ["n", "n_valid", "n_raw", "s", "extra"]
    assert [tuple(r) for r in got.collect()] == [
        (1, True, "1.5", "a", 1),
        (None, False, "x", "b", 2),
        (None, False, None, None, 3),
    ]


def test_validate_needs_no_original_of_a_typed_column(spark):
    schema = T.StructType([T.StructField("t", T.TimestampType())])
    got = validate(spark.createDataFrame([(datetime(2024, 1, 1),), (None,)], "t timestamp"), schema)
    assert got.columns == ["t", "t_valid"]
    assert [r["t_valid"] for r in got.collect()] == [True, False]


def test_typed_projection_drops_what_the_analysis_does_not_use(spark):
    row = ("12", "c1", "7", "foliar", "5mg", "daily")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in FERTILIZER.feed_order))
    got = typed_projection(df, FERTILIZER)
    assert got.columns == ["purchaseid", "consumerid", "fertilizerid", "type", "mg"]
    assert tuple(got.first()) == (12, "c1", 7, "foliar", None)


def test_align_orders_and_converts(spark):
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    got = align(spark.createDataFrame([("x", " 3.9", True)], "a string, b string, flag boolean"), schema)
    assert got.schema.names == ["b", "a"]
    assert tuple(got.first()) == (3, "x")
