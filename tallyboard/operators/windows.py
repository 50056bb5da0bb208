"""Dates matched with event windows that carry a factor."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.calendar import day
from tallyboard.functions.scores import first_case
from tallyboard.scratch import stage


@dataclass(frozen=True)
class EventWindow:
    """A closed range of days."""

    event: str
    start: dt.date
    end: dt.date
    factor: float


# The events of the second half of 2024.
EVENTS_2024 = (
    EventWindow("launch", dt.date(2024, 8, 15), dt.date(2024, 8, 25), 1.12),
    EventWindow("outage", dt.date(2024, 9, 10), dt.date(2024, 9, 15), 0.75),
    EventWindow("promotion", dt.date(2024, 11, 25), dt.date(2024, 12, 5), 1.08),
    EventWindow("year end", dt.date(2024, 12, 20), dt.date(2024, 12, 30), 0.88),
)
NO_FACTOR = 1.0
#: Windows of more days are cut to the days of the data before they are unfolded.
LONG_DAYS = 366


def with_listed_events(df: DataFrame, date: str, windows: Sequence[EventWindow]) -> DataFrame:
    """Add ``event`` and ``event_factor`` from windows written in code; the first listed wins.

    A list in code compiles to one CASE expression: no join and no shuffle.
    """
    inside = [(day(date).between(F.lit(w.start), F.lit(w.end)), w) for w in windows]
    return df.withColumns({
        "event": first_case([(c, w.event) for c, w in inside], None).cast("string"),
        "event_factor": first_case([(c, w.factor) for c, w in inside], NO_FACTOR),
    })


def with_event_table(
    df: DataFrame, date: str, windows: DataFrame, priority: str,
    event: str = "event", start: str = "start", end: str = "end", factor: str = "factor",
) -> DataFrame:
    """Add ``event`` and ``event_factor`` from a table of windows; the lowest ``priority`` wins.

    Windows are unfolded into days and reduced to one winner per day, each task on its own
    windows first, which leaves at most one row per calendar day. That table is written out, so
    its true size is known when the join is planned: below Spark's broadcast threshold the rows
    are not shuffled at all, and beyond it they meet by equality on the day. There is no range
    join, and no row is multiplied by overlapping windows. Open-ended windows are cut to the days of ``df``.
    """
    windows = windows.withColumns({start: day(start), end: day(end)})
    longest = windows.agg(F.max(F.date_diff(end, start))).first()[0]
    if longest is not None and longest > LONG_DAYS:
        first, last = df.agg(F.min(day(date)), F.max(day(date))).first()
        windows = windows.withColumns({start: F.greatest(start, F.lit(first)), end: F.least(end, F.lit(last))}) if first else windows.limit(0)
    days = F.explode(F.sequence(day(start), day(end), F.expr("interval 1 day")))
    unfolded = windows.where(day(start) <= day(end)).select(
        days.alias("_day"),
        F.struct(
            F.col(priority).alias("priority"), F.col(event).alias("event"), F.col(factor).cast("double").alias("factor")
        ).alias("_window"),
    )
    winners = stage(unfolded.groupBy("_day").agg(F.min("_window").alias("_window")), "event-days")
    joined = df.withColumn("_day", day(date)).join(winners, "_day", "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.col("_window.event").alias("event"),
        F.coalesce(F.col("_window.factor"), F.lit(NO_FACTOR)).alias("event_factor"),
    )
