import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyboard.functions import calendar as cal
from tallyboard.functions import scores

DAYS = [dt.date(2024, 12, 29), dt.date(2024, 12, 30), dt.date(2024, 12, 31), dt.date(2024, 7, 1), None]


@pytest.fixture(scope="module")
def days(spark):
    return spark.createDataFrame([(i, d) for i, d in enumerate(DAYS)], "i int, date date")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_calendar_columns(days):
    got = rows(cal.with_calendar(days, "date").orderBy("i").drop("i"))
    assert got == [
        (DAYS[0], "Sunday", "December", 52, 1, "Q4"),
        (DAYS[1], "Monday", "December", 1, 0, "Q4"),
        (DAYS[2], "Tuesday", "December", 1, 0, "Q4"),
        (DAYS[3], "Monday", "July", 27, 0, "Q3"),
        (None, None, None, None, None, None),
    ]


def test_names_match_the_date_formatter(spark):
    year = spark.sql("SELECT explode(sequence(date'2023-12-25', date'2025-01-07')) AS d")
    wrong = year.where(
        (cal.day_name("d") != F.date_format("d", "EEEE")) | (cal.month_name("d") != F.date_format("d", "MMMM"))
        | (cal.day_name("d", True) != F.rpad(F.date_format("d", "EEEE"), 9, " "))
        | (cal.month_name("d", True) != F.rpad(F.date_format("d", "MMMM"), 9, " "))
    )
    assert year.count() == 380 and wrong.count() == 0


def test_text_and_back(days):
    texts = days.select("date", cal.format_day("date").alias("t")).withColumn("back", cal.parse_day("t"))
    assert texts.where("NOT date <=> back").count() == 0
    assert texts.where("t = '2024-07-01'").count() == 1


def test_spine_is_inclusive(spark):
    bounds = spark.createDataFrame([("a", dt.date(2024, 2, 27), dt.date(2024, 3, 1))], "k string, s date, e date")
    assert rows(cal.day_spine(bounds, "s", "e")) == [("a", dt.date(2024, 2, 27) + dt.timedelta(n)) for n in range(4)]


def test_fill_days(spark):
    daily = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 2, 1.5), ("a", dt.date(2024, 1, 4), 3, 2.5), ("b", dt.date(2024, 1, 2), 1, None),
         ("b", None, 9, 9.0)],
        "k string, day date, n int, v double",
    )
    filled = cal.fill_days(daily, "day", ["n"], by=["k"])
    assert filled.dtypes == daily.dtypes
    assert sorted(rows(filled), key=str) == [
        ("a", dt.date(2024, 1, 1), 2, 1.5), ("a", dt.date(2024, 1, 2), 0, None), ("a", dt.date(2024, 1, 3), 0, None),
        ("a", dt.date(2024, 1, 4), 3, 2.5), ("b", dt.date(2024, 1, 2), 1, None),
    ]
    assert cal.fill_days(daily.where("false"), "day", ["n"]).count() == 0


def test_tier_bounds(spark):
    df = spark.createDataFrame([(100.0,), (80.0,), (79.99,), (75.0,), (70.0,), (69.99,), (0.0,), (None,)], "x double")
    assert [r[0] for r in df.select(scores.tier("x")).collect()] == [
        "Excellent", "Excellent", "Good", "Good", "Average", "Needs Improvement", "Needs Improvement",
        "Needs Improvement",
    ]
    assert df.select(scores.tier("x", (), "none")).distinct().collect()[0][0] == "none"


def test_clamp_and_truncate(spark):
    df = spark.createDataFrame([(-5.5,), (3.7,), (99.0,), (None,)], "x double")
    assert rows(df.select(scores.clamp("x", 0.0, 10.0), scores.truncate("x"), scores.clamp("x", low=1.0))) == [
        (0.0, -5, 1.0), (3.7, 3, 3.7), (10.0, 99, 99.0), (None, None, None)
    ]


def test_rounding_modes(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,), (None,)], "x double")
    assert rows(df.select(scores.round_away("x", 2), scores.round_even("x", 2))) == [
        (0.13, 0.12), (0.38, 0.38), (-0.13, -0.12), (None, None)
    ]


# Rows of a daily survey table: nps, csat, effort, rate and the composite they give.
SCORED = [(45, 75, 7, 78.0, 54.1), (61, 100, 7, 95.0, 69.8), (33, 46, 7, 61.5, 38.5), (0, 0, 8, 0.0, 0.0)]


def test_composite(spark):
    df = spark.createDataFrame(SCORED, "n int, c int, e int, r double, want double")
    assert df.where(scores.composite("n", "c", "e", "r") != F.col("want")).count() == 0
    null = spark.createDataFrame([(None, 1, 1, 1.0)], "n int, c int, e int, r double")
    assert null.select(scores.composite("n", "c", "e", "r")).first()[0] is None


def test_calendar_factor(spark):
    days = [dt.date(2024, 7, 6), dt.date(2024, 9, 10), dt.date(2024, 12, 2), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(scores.calendar_factor("d", F.lit(2.0))).collect()]
    want = [0.95 * 1.0 * 1.05 * 2, 1 + 2 / 5 * 0.15, (1 + 5 / 5 * 0.15) * 0.92 * 2]
    want[1] *= 2
    assert got[:3] == pytest.approx(want) and got[3] is None
