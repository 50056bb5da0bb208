"""Calendar columns derived from a date (or timestamp) column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed value: the blank-padded width of day and month names in the SQL template 'Day' / 'Month'.
NAME_WIDTH = 9

# The names themselves, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(c: Column | str) -> Column:
    """Day grain. A cast keeps zone-less timestamps zone-less."""
    return as_column(c).cast("date")


def _name(names: Sequence[str], position: Column, padded: bool) -> Column:
    """Look a name up by its 1-based position: far cheaper per row than formatting a date."""
    width = NAME_WIDTH if padded else 0
    name = F.element_at(F.array(*[F.lit(n.ljust(width)) for n in names]), position)
    # element_at counts as never null here, and would give the last name for a null position.
    return F.when(position.isNotNull(), name)


def day_name(c: Column | str, padded: bool = False) -> Column:
    return _name(WEEKDAYS, F.weekday(day(c)) + 1, padded)


def month_name(c: Column | str, padded: bool = False) -> Column:
    return _name(MONTHS, F.month(day(c)), padded)


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(day(c))


def weekend_flag(c: Column | str) -> Column:
    """1 on Saturday and Sunday, else 0; null stays null."""
    return (F.weekday(day(c)) >= 5).cast("int")


def quarter_label(c: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day(c)).cast("string"))


def format_day(c: Column | str) -> Column:
    return F.date_format(day(c), "yyyy-MM-dd")


def parse_day(c: Column | str) -> Column:
    """Text ``YYYY-MM-DD`` to date; other text fails."""
    return F.to_date(as_column(c), "yyyy-MM-dd")


def with_calendar(df: DataFrame, date: str) -> DataFrame:
    """Add the five derived calendar columns of the metrics table."""
    return df.withColumns({
        "day_of_week": day_name(date),
        "month": month_name(date),
        "week_number": iso_week(date),
        "is_weekend": weekend_flag(date),
        "quarter": quarter_label(date),
    })


def day_spine(bounds: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, for each row of ``bounds``."""
    days = F.sequence(day(start), day(end), F.expr("interval 1 day"))
    return bounds.select(*[c for c in bounds.columns if c not in (start, end)], F.explode(days).alias(name))


def fill_days(daily: DataFrame, name: str, zeros: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Give every day between the first and the last row of ``daily``, per ``by``, a row.

    ``daily`` holds one row per day (and ``by``) already; the columns in ``zeros`` are 0 on added
    days, other columns null. Each row unfolds up to the day before the next one, so the rows are
    read once and joined with nothing; the window sorts no more than one row per calendar day.
    """
    following = F.lead(name).over(W.partitionBy(*by).orderBy(name))
    last = F.coalesce(F.date_sub(following, 1), F.col(name))
    unfolded = daily.where(F.col(name).isNotNull()).withColumn("_last", last).withColumn(
        "_day", F.explode(F.sequence(name, "_last", F.expr("interval 1 day")))
    )

    def value(c: str) -> Column:
        if c == name:
            return F.col("_day")
        if c in by:
            return F.col(c)
        own = F.when(F.col("_day") == F.col(name), F.col(c))
        return own.otherwise(F.lit(0).cast(daily.schema[c].dataType)) if c in zeros else own

    return unfolded.select(*[value(c).alias(c) for c in daily.columns])
