"""Scores, tiers, rounding and calendar factors as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyboard.functions.calendar import as_column, day

# Tier thresholds, highest first, and the tier below all of them.
TIERS = ((80, "Excellent"), (75, "Good"), (70, "Average"))
LOWEST_TIER = "Needs Improvement"

# Composite weights; effort counts as (8 - effort) * 12.5.
NPS_WEIGHT = 0.3
CSAT_WEIGHT = 0.3
EFFORT_WEIGHT = 0.2
RATE_WEIGHT = 0.2
EFFORT_TOP = 8
EFFORT_STEP = 12.5

# Weekend, trend and season factors.
WEEKEND_FACTOR = 0.95
TREND_FIRST_MONTH = 7
TREND_MONTHS = 5
TREND_GAIN = 0.15
SEASON_FACTORS = (((11, 12), 0.92), ((7, 8), 1.05))


def first_case(cases: Sequence[tuple[Column, Any]], default: Any) -> Column:
    """Value of the first condition that holds, else ``default``."""
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return F.lit(default) if chain is None else chain.otherwise(default)


def tier(c: Column | str, tiers: Sequence[tuple[float, str]] = TIERS, lowest: str = LOWEST_TIER) -> Column:
    """Name of the highest threshold reached. Null falls through to ``lowest``."""
    value = as_column(c)
    highest_first = sorted(tiers, key=lambda t: -t[0])
    return first_case([(value >= low, name) for low, name in highest_first], lowest)


def round_away(c: Column | str, digits: int = 0) -> Column:
    """SQL ROUND: halves go away from zero."""
    return F.round(as_column(c), digits)


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Halves go to the even neighbour, as scripting languages round."""
    return F.bround(as_column(c), digits)


def clamp(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to [low, high]; null stays null."""
    value = as_column(c)
    bounded = value
    if high is not None:
        bounded = F.least(F.lit(high), bounded)
    if low is not None:
        bounded = F.greatest(F.lit(low), bounded)
    return F.when(value.isNotNull(), bounded)


def truncate(c: Column | str) -> Column:
    """Drop the fraction, toward zero."""
    return as_column(c).cast("int")


def weighted_sum(terms: Sequence[tuple[Column | str, float]], digits: int | None = None) -> Column:
    """Sum of column times weight in the given order, optionally rounded half to even."""
    total = reduce(lambda a, b: a + b, [as_column(c) * F.lit(w) for c, w in terms])
    return total if digits is None else round_even(total, digits)


def composite(nps: Column | str, csat: Column | str, effort: Column | str, rate: Column | str) -> Column:
    """The composite experience score, one decimal."""
    ease = (F.lit(EFFORT_TOP) - as_column(effort)) * F.lit(EFFORT_STEP)
    return weighted_sum(
        [(nps, NPS_WEIGHT), (csat, CSAT_WEIGHT), (ease, EFFORT_WEIGHT), (rate, RATE_WEIGHT)], digits=1
    )


def weekend_factor(date: Column | str) -> Column:
    d = day(date)
    return F.when(F.weekday(d) >= 5, WEEKEND_FACTOR).when(d.isNotNull(), 1.0)


def trend_factor(date: Column | str) -> Column:
    progress = (F.month(day(date)) - F.lit(TREND_FIRST_MONTH)) / F.lit(float(TREND_MONTHS))
    return F.lit(1.0) + progress * F.lit(TREND_GAIN)


def season_factor(date: Column | str) -> Column:
    d = day(date)
    factor = first_case([(F.month(d).isin(*months), f) for months, f in SEASON_FACTORS], 1.0)
    return F.when(d.isNotNull(), factor)


def calendar_factor(date: Column | str, event_factor: Column | None = None) -> Column:
    """Weekend times trend times season, times the factor of an event window if given."""
    total = weekend_factor(date) * trend_factor(date) * season_factor(date)
    return total if event_factor is None else total * event_factor
