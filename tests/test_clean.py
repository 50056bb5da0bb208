import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tallyboard.operators import clean


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_fill_covers_nan_and_ignores_unknown_names(spark):
    df = spark.createDataFrame([(None, "a"), (float("nan"), None), (2.5, "b")], "x double, t string")
    assert rows(clean.fill_defaults(df, {"x": 0, "gone": 1})) == [(0.0, "a"), (0.0, None), (2.5, "b")]
    assert clean.fill_defaults(df, {"gone": 1}) is df


def test_add_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = clean.add_missing(df, {"a": (9, "int"), "t": ("Unknown", "string"), "n": (0, "decimal(3,2)")})
    assert rows(out) == [(1, "Unknown", Decimal("0.00"))]


def test_conversions(spark):
    df = spark.createDataFrame([("2024-01-31", "47.9", -2.7), (None, None, None)], "d string, s string, x double")
    out = clean.to_whole(clean.to_day(df, ["d"]), ["s", "x"])
    assert rows(out) == [(dt.date(2024, 1, 31), 47, -2), (None, None, None)]


def test_bad_date_fails(spark):
    df = spark.createDataFrame([("31.01.2024",)], "d string")
    with pytest.raises(PySparkException):
        clean.to_day(df, ["d"]).collect()


def test_decimals_round_away_from_zero(spark):
    df = spark.createDataFrame([(2.675,), (-2.675,), (9.994,), (None,)], "x double")
    assert [r[0] for r in clean.conform(df, {"x": T.DecimalType(3, 2)}).collect()] == [
        Decimal("2.68"), Decimal("-2.68"), Decimal("9.99"), None
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_overflow_fails_in_any_session_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(56.0,)], "ces_score double")
        with pytest.raises(PySparkException, match="does not fit"):
            clean.conform(df, {"ces_score": "decimal(3,2)"}).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_rejects_keep_their_values(spark):
    df = spark.createDataFrame([(1, 7.0, 1.0), (2, 56.0, 2.0), (3, None, 3.0)], "k int, a double, b double")
    good, wrong = clean.conform_or_reject(df, {"a": "decimal(3,2)", "b": "decimal(5,2)"})
    assert rows(good) == [(1, Decimal("7.00"), Decimal("1.00")), (3, None, Decimal("3.00"))]
    assert rows(wrong) == [(2, 56.0, 2.0)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert sorted(rows(clean.key_violations(df, "k")), key=str) == [
        (1, "duplicate key", 2), (None, "null key", 1)
    ]
    assert clean.key_violations(df.where("k = 2"), "k").count() == 0
