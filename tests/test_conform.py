"""Conversion rules, value by value."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from sluice.errors import LoadPlanError
from sluice.functions.conform import conform, may_reject
from sluice.plans.spec import LoadSpec, TargetColumn

TEXT, LONG, DOUBLE, BYTES = T.StringType(), T.LongType(), T.DoubleType(), T.BinaryType()


def converted(spark, values, kind, target, **options):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType(
        [T.StructField("i", T.IntegerType()), T.StructField("v", kind)]))
    out = rows.select("i", conform(F.col("v"), kind, target, **options).alias("v"))
    assert out.schema["v"].dataType == target.spark_type
    return [r["v"] for r in sorted(out.collect(), key=lambda r: r["i"])]


INTEGER = TargetColumn("c", "INTEGER")


def test_text_to_integer(spark):
    values = ["124", "aa", "", " 12 ", "+5", "-7\n", "12.7", "1e3", "9223372036854775807", "9223372036854775808",
              "-9223372036854775808", "-9223372036854775809", "0" * 50 + "9", "9" * 60, " " * 30 + "8", "0x1", None]
    assert converted(spark, values, TEXT, INTEGER) == [
        124, None, None, 12, 5, -7, None, None, 2**63 - 1, None, -2**63, None, 9, None, 8, None, None,
    ]


def test_double_to_integer(spark):
    values = [2.5, -2.5, 2.4999, 0.49999999999999994, float(2**52 + 1), 9.3e18, -2.0**63, float("nan"), float("inf"), None]
    assert converted(spark, values, DOUBLE, INTEGER) == [3, -2, 2, 0, 2**52 + 1, None, -2**63, None, None, None]


def test_decimal_to_integer(spark):
    kind = T.DecimalType(38, 2)
    values = [Decimal("2.50"), Decimal("-2.50"), Decimal("2.49"), Decimal("999999999999999999999999999999999999.99"), None]
    assert converted(spark, values, kind, INTEGER) == [3, -2, 2, None, None]


@pytest.mark.parametrize("width, limit", [(1, 2**7), (2, 2**15), (4, 2**31)])
def test_narrow_integers_reject_instead_of_wrapping(spark, width, limit):
    target = TargetColumn("c", "INTEGER", width=width)
    assert converted(spark, [limit - 1, limit, -limit, -limit - 1], LONG, target) == [limit - 1, None, -limit, None]


def test_boolean(spark):
    target = TargetColumn("c", "BOOLEAN")
    assert converted(spark, ["true", "N", "1", " Yes\t", "maybe", "", None], TEXT, target) == \
        [True, False, True, True, None, None, None]
    assert converted(spark, [0, 1, -3, None], LONG, target) == [False, True, True, None]


def test_text_to_float(spark):
    target = TargetColumn("c", "DOUBLE PRECISION")
    values = ["1.5", " -2e3 ", ".5", "5.", "1d", "0x1p3", "abc", "", None]
    assert converted(spark, values, TEXT, target) == [1.5, -2000.0, 0.5, 5.0, None, None, None, None, None]


def test_numeric(spark):
    target = TargetColumn("c", "NUMERIC", 7, 2)
    assert converted(spark, [2.675, 99999.994, 100000.0, None], DOUBLE, target) == \
        [Decimal("2.68"), Decimal("99999.99"), None, None]
    assert converted(spark, ["1e3", "-0.005", "99999.995", "x", "12d"], TEXT, target) == \
        [Decimal("1000.00"), Decimal("-0.01"), None, None, None]


def test_numeric_limits(spark):
    target = TargetColumn("c", "NUMERIC", 5, 2)
    edge = [999.99, 999.994, 999.995, 999.9999, 1000.0, -999.994, -999.995, float("nan"), float("-inf")]
    fits = [Decimal("999.99"), Decimal("999.99"), None, None, None, Decimal("-999.99"), None, None, None]
    assert converted(spark, edge, DOUBLE, target) == fits
    decimals = [Decimal(v) for v in ("999.990", "999.994", "999.995", "1000.000", "-999.994", "-999.995")]
    assert converted(spark, decimals, T.DecimalType(20, 3), target) == fits[:3] + fits[4:7]
    assert converted(spark, [999, 1000, -999, -1000, None], LONG, target) == [Decimal(999), None, Decimal(-999), None, None]
    wide = TargetColumn("c", "NUMERIC", 38, 0)
    assert [v is None for v in converted(spark, [1e37, 9.9e37, 1.1e38, -1.1e38], DOUBLE, wide)] == [False, False, True, True]
    assert converted(spark, [2**63 - 1, -2**63], LONG, wide) == [Decimal(2**63 - 1), Decimal(-2**63)]
    huge = [Decimal("9" * 38), Decimal("-" + "9" * 38), None]
    assert converted(spark, huge, T.DecimalType(38, 0), wide) == huge
    assert converted(spark, huge, T.DecimalType(38, 0), TargetColumn("c", "NUMERIC", 38, 1)) == [None, None, None]


def test_lengths_count_bytes(spark):
    assert converted(spark, ["abc", "äb", "äbc", "abcd", "", None], TEXT, TargetColumn("c", "VARCHAR", 3)) == \
        ["abc", "äb", None, None, "", None]
    assert converted(spark, ["a", "ä", "äb", "äbc", None], TEXT, TargetColumn("c", "CHAR", 3)) == \
        ["a  ", "ä ", "äb", None, None]
    assert converted(spark, ["ä", "abcd"], TEXT, TargetColumn("c", "VARBINARY", 3)) == ["ä".encode(), None]
    assert converted(spark, [b"\x01", b"abcd", None], BYTES, TargetColumn("c", "BINARY", 3, fixed=True)) == \
        [b"\x01\x00\x00", None, None]
    assert converted(spark, [b"\x01", b"abcd"], BYTES, TargetColumn("c", "BINARY", 3)) == [b"\x01", None]


def test_timestamps_drop_sub_millisecond_digits(spark):
    wall = T.TimestampNTZType()
    target = TargetColumn("c", "TIMESTAMP")
    before = datetime(2015, 3, 8, 2, 30, 0, 123456)  # does not exist in the session's zone
    old = datetime(1960, 1, 1, 0, 0, 0, 999)
    assert converted(spark, [before, old, None], wall, target) == [before.replace(microsecond=123000), old.replace(microsecond=0), None]
    assert converted(spark, [before], wall, target, precision="micros") == [before]


def test_instants_as_text_use_the_load_zone(spark):
    rows = spark.sql("SELECT timestamp_micros(1704067200000000) AS v")
    kind = T.TimestampType()
    shown = rows.select(conform(F.col("v"), kind, TargetColumn("c", "VARCHAR", 30), zone="Asia/Tokyo")).first()[0]
    assert shown == "2024-01-01 09:00:00"


@pytest.mark.parametrize("target", ["DATE", "TIME", "TIMETZ", "TIMESTAMP", "TIMESTAMPTZ", "INTERVAL"])
def test_date_family_needs_date_like_input(target):
    with pytest.raises(LoadPlanError):
        conform(None, TEXT, TargetColumn("c", target))


@pytest.mark.parametrize("target", ["INTEGER", "VARCHAR", "NUMERIC", "BOOLEAN"])
def test_nested_input_is_refused(target):
    with pytest.raises(LoadPlanError):
        conform(None, T.ArrayType(T.FloatType()), TargetColumn("c", target))


def test_type_names():
    assert TargetColumn("c", "double  precision").type_name == "DOUBLE PRECISION"
    assert TargetColumn("c", "varchar", 3).type_text == "VARCHAR(3)"
    for bad in (("GEOMETRY",), ("CHAR",), ("NUMERIC", 40, 2), ("VARCHAR", 0)):
        with pytest.raises(LoadPlanError):
            TargetColumn("c", *bad)
    with pytest.raises(LoadPlanError):
        TargetColumn("c", "INTEGER", width=3)
    with pytest.raises(LoadPlanError):
        LoadSpec([TargetColumn("a", "DATE"), TargetColumn("A", "DATE")])


def test_conversions_that_cannot_fail_are_not_checked():
    assert not may_reject(LONG, INTEGER)
    assert not may_reject(T.TimestampNTZType(), TargetColumn("c", "TIMESTAMP"))
    assert not may_reject(TEXT, TargetColumn("c", "VARCHAR"))
    assert may_reject(TEXT, TargetColumn("c", "VARCHAR", 5))
    assert may_reject(T.TimestampNTZType(), TargetColumn("c", "VARCHAR", 5))
