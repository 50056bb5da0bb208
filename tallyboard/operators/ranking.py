"""Numbering rows in a total order without pulling a table, or one hot group, into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyboard.scratch import stage

_POSITION = "_position"
_PART = "_part"
# monotonically_increasing_id keeps the partition above bit 33 and the row in it below.
_ROW_BITS = 33


Stage = Callable[[DataFrame, str], DataFrame]


def _number(df: DataFrame, order: Sequence[str], name: str, start: Column, place: Stage = stage) -> DataFrame:
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = place(ranged.withColumn(_POSITION, F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn(_PART, F.shiftright(_POSITION, _ROW_BITS))
    # One row per range partition, so the window below and the broadcast stay small.
    earlier = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_rows")).select(
        _PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    row = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), _PART).select(
        *df.columns, _PART, (row + F.col("_offset") + start).cast("bigint").alias(name)
    )


def number_rows(df: DataFrame, order: Sequence[str], name: str = "id", start: int = 1, place: Stage = stage) -> DataFrame:
    """Contiguous numbers from ``start`` in the order of ``order``, which must be unique per row.

    Rows are range-partitioned and sorted once; a row's number is its place in its partition plus
    the size of the partitions before. The placed rows are written out first, as range bounds are
    sampled and a second sampling could move rows; ``place`` says where to.
    """
    return _number(df, order, name, F.lit(start), place).drop(_PART)


#: A group of more rows is spread over tasks; a smaller one is sorted and numbered by one.
GROUP_ROWS = 1_000_000
#: Up to so many large groups, their first numbers are sent to all tasks.
SENT_GROUPS = 100_000


def _same(groups: Sequence[str], other: str) -> Column:
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"{other}{g}"))
    return same


def rank_in_groups(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rank", place: Stage = stage) -> DataFrame:
    """0-based rank of each row in its group, like ``row_number() - 1`` over a partitioned window.

    ``groups`` plus ``order`` must be unique per row. Groups are counted first, with a partial count per task. Those of up to
    ``GROUP_ROWS`` rows are shuffled once and numbered by a window. Larger ones, of which there are few, are dealt by
    ranges of their order and numbered through: where each range partition's first row stands, and where each group starts, is one
    short row a partition and group, which goes to all tasks, so nothing is shuffled after the range sort.
    """
    rows = place(df, "ranked")
    within = W.partitionBy(*groups).orderBy(*order)
    large = place(rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > GROUP_ROWS).select(*[F.col(g).alias(f"_large_{g}") for g in groups]), "large-groups")
    number = large.count()
    if not number:
        return rows.withColumn(name, (F.row_number().over(within) - 1).cast("bigint"))
    large = F.broadcast(large) if number <= SENT_GROUPS else large
    few = rows.join(large, _same(groups, "_large_"), "left_anti").withColumn(name, (F.row_number().over(within) - 1).cast("bigint"))
    numbered = _number(rows.join(large, _same(groups, "_large_"), "left_semi"), [*groups, *order], "_number", F.lit(0), place)
    starts = numbered.groupBy(*groups).agg(F.min("_number").alias("_start")).select(*[F.col(g).alias(f"_start_{g}") for g in groups], "_start")
    starts = F.broadcast(starts) if number <= SENT_GROUPS else starts
    many = numbered.join(starts, _same(groups, "_start_")).select(*df.columns, (F.col("_number") - F.col("_start")).cast("bigint").alias(name))
    return few.unionByName(many)
