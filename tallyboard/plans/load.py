"""The load job: CSV, clean, derive, conform, upsert, summarise."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.functions.calendar import iso_week
from tallyboard.functions.scores import composite, tier
from tallyboard.operators import clean
from tallyboard.operators.stats import load_summary, share_of_total
from tallyboard.operators.upsert import upsert_table
from tallyboard.scratch import stage
from tallyboard.sources.csv import read_csv
from tallyboard.sources.tables import read_table

SCORE = T.DecimalType(3, 2)
RATE = T.DecimalType(5, 2)
UNKNOWN = "Unknown"

# Columns, order and types of the survey metrics table.
SURVEY_TABLE = {
    "date": T.DateType(),
    "nps_score": T.IntegerType(),
    "csat_score": T.IntegerType(),
    "ces_score": SCORE,
    "response_rate": RATE,
    "completion_rate": RATE,
    "responses_count": T.IntegerType(),
    "cx_composite_score": RATE,
    "product_satisfaction": SCORE,
    "support_satisfaction": SCORE,
    "ease_of_use": SCORE,
    "value_score": SCORE,
    "day_of_week": T.StringType(),
    "month": T.StringType(),
    "week_number": T.IntegerType(),
    "quarter": T.StringType(),
    "is_weekend": T.IntegerType(),
    "performance_tier": T.StringType(),
}

# What replaces null in a column that is there.
SURVEY_FILL = {
    "nps_score": 0,
    "csat_score": 0,
    "ces_score": 0,
    "response_rate": 0,
    "completion_rate": 0,
    "responses_count": 0,
    "cx_composite_score": 0,
    "product_satisfaction": 0,
    "support_satisfaction": 0,
    "ease_of_use": 0,
    "value_score": 0,
    "week_number": 1,
    "is_weekend": 0,
}
SURVEY_WHOLE = ("nps_score", "csat_score", "responses_count", "week_number", "is_weekend")


@dataclass(frozen=True)
class Profile:
    """How raw rows become rows of a typed table with one row per date."""

    table: Mapping[str, T.DataType]
    fill: Mapping[str, Any]
    whole: Sequence[str]
    date: str = "date"
    week: str = "week_number"
    score: str = "cx_composite_score"
    tier: str = "performance_tier"
    # Columns the score is computed from where the input has no score.
    score_inputs: tuple[str, str, str, str] = ("nps_score", "csat_score", "ces_score", "response_rate")

    def raw_schema(self) -> T.StructType:
        """Types to read raw text with: numbers as double, as cells may be empty."""
        numeric = (T.IntegerType, T.DecimalType)
        return T.StructType([
            T.StructField(c, T.DoubleType() if isinstance(t, numeric) else t) for c, t in self.table.items()
        ])


SURVEY = Profile(SURVEY_TABLE, SURVEY_FILL, SURVEY_WHOLE)


def prepare(df: DataFrame, profile: Profile = SURVEY, keep: Sequence[str] = ()) -> DataFrame:
    """Clean and complete raw rows, carrying the columns ``keep`` along.

    The order counts: a missing score is 0 before tiers are set.
    """
    df = clean.fill_defaults(df, profile.fill)
    derived = {}
    if profile.week not in df.columns:
        derived[profile.week] = iso_week(profile.date)
    if profile.score not in df.columns:
        lacking = [c for c in profile.score_inputs if c not in df.columns]
        if lacking:
            raise ValueError(f"no {profile.score}, and it cannot be computed without {', '.join(lacking)}")
        derived[profile.score] = composite(*profile.score_inputs)
    df = df.withColumns(derived) if derived else df
    if profile.tier not in df.columns:
        df = df.withColumn(profile.tier, tier(profile.score))
    df = clean.to_day(df, [profile.date])
    df = clean.to_whole(df, [c for c in profile.whole if c in df.columns])
    texts = [c for c, t in profile.table.items() if isinstance(t, T.StringType)]
    df = clean.add_missing(df, {
        c: (UNKNOWN, "string") if c in texts else (0, t.simpleString()) for c, t in profile.table.items()
        if c != profile.date
    })
    return clean.select_in_order(df, [*profile.table, *keep])


@dataclass(frozen=True)
class LoadResult:
    report: DataFrame
    violations: DataFrame
    summary: DataFrame
    tiers: DataFrame


def load(
    spark: SparkSession, csv_path: str, table_path: str, now: dt.datetime, profile: Profile = SURVEY
) -> LoadResult:
    """Load one CSV file, or a folder of them, into the table and describe the table afterwards.

    Of several rows for one date the last counts; files are in the order of their paths.
    """
    raw = read_csv(spark, csv_path, profile.raw_schema(), position="_place")
    return load_frame(raw, table_path, now, "_place", profile)


def load_frame(
    raw: DataFrame, table_path: str, now: dt.datetime, seq: str, profile: Profile = SURVEY
) -> LoadResult:
    """Load raw rows; ``seq`` is the column that orders the rows of one date."""
    spark = raw.sparkSession
    # Written once: the violations below are those of the rows that were loaded.
    typed = stage(clean.conform(prepare(raw, profile, keep=[seq]), profile.table), "typed")
    report = upsert_table(spark, table_path, typed, [profile.date], [seq], now, stored=list(profile.table))
    table = read_table(spark, table_path)
    numbers = [c for c in ("nps_score", "csat_score", profile.score) if c in table.columns]
    return LoadResult(
        report, clean.key_violations(typed, profile.date),
        load_summary(table, profile.date, numbers, profile.tier), share_of_total(table, profile.tier),
    )
