"""Summary statistics, each in one pass over its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.calendar import as_column, day


def load_summary(df: DataFrame, date: str, metrics: Sequence[str], tier: str) -> DataFrame:
    """Row count, date range, averages to one decimal and number of tiers, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(day(date)).alias("first_date"),
        F.max(day(date)).alias("last_date"),
        *[F.round(F.avg(m), 1).alias(f"avg_{m}") for m in metrics],
        F.countDistinct(tier).alias("tiers"),
    )


def share_of_total(df: DataFrame, group: str, label: str | None = None, digits: int = 1) -> DataFrame:
    """Rows per group and their percentage of all rows, most frequent first.

    The total is a scalar over the grouped counts, so the table is read once and no window
    gathers the groups in one task.
    """
    label = label or group
    grouped = df.groupBy(as_column(group).alias(label)).agg(F.count(F.lit(1)).alias("count"))
    total = grouped.agg(F.sum("count")).scalar()
    share = F.round(F.col("count").cast("double") / total * F.lit(100), digits)
    return grouped.select(label, "count", share.alias("percentage")).orderBy(F.desc("count"), label)


def metric_summary(df: DataFrame, metrics: Sequence[str], digits: int = 1) -> DataFrame:
    """Min, max, average and sample standard deviation, one row per metric."""
    parts: list[Column] = []
    for i, m in enumerate(metrics):
        value = F.col(m).cast("double")
        parts += [
            F.min(value).alias(f"_min{i}"), F.max(value).alias(f"_max{i}"),
            F.avg(value).alias(f"_avg{i}"), F.stddev_samp(value).alias(f"_std{i}"),
        ]
    cells: list[Column] = []
    for i, m in enumerate(metrics):
        cells += [F.lit(m), *[F.round(F.col(f"_{s}{i}"), digits) for s in ("min", "max", "avg", "std")]]
    long = F.stack(F.lit(len(metrics)), *cells).alias("metric", "min", "max", "avg", "std")
    return df.agg(*parts).select(long)


def compare_segments(df: DataFrame, flag: Column | str, value: Column | str) -> DataFrame:
    """Mean where the flag is 1, mean where it is 0, and the difference in percent.

    A side without rows gives null, and so does a zero mean on the flag-0 side.
    """
    f, v = as_column(flag), as_column(value)
    sides = df.agg(F.avg(F.when(f == 1, v)).alias("flagged_avg"), F.avg(F.when(f == 0, v)).alias("other_avg"))
    ratio = F.col("flagged_avg") / F.nullif(F.col("other_avg"), F.lit(0.0))
    return sides.select("flagged_avg", "other_avg", ((ratio - 1) * 100).alias("difference_pct"))


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a given order."""
    return df.orderBy(*order).limit(n)
