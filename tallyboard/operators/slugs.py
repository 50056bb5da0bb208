"""Unique slugs for a batch of titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.text import slugify
from tallyboard.operators.ranking import rank_in_groups
from tallyboard.scratch import stage

# The number at the end of a generated slug has no leading zeros. 18 digits always fit a bigint, and no
# table has as many rows of one base, so a longer number is never in the way of a generated slug.
_NUMBER = "^[1-9][0-9]{0,17}$"
#: Up to so many rows, telling bases with claims from others costs more than it saves.
FEW_ROWS = 1_000_000


def _claims(slugs: DataFrame, slug: str, itself: bool) -> DataFrame:
    """What a slug claims: number N of its base if it reads base-N, and number 0 of ``itself``."""
    text = F.col(slug)
    tail = F.substring_index(text, "-", -1)
    generated = F.when(
        text.contains("-") & tail.rlike(_NUMBER),
        F.struct(
            text.substr(F.lit(1), F.length(text) - F.length(tail) - 1).alias("base"),
            tail.cast("bigint").alias("_claimed"),
        ),
    )
    whole = F.struct(text.alias("base"), F.lit(0).cast("bigint").alias("_claimed"))
    pairs = F.array_compact(F.array(*([whole] if itself else []), generated))
    return slugs.where(text.isNotNull()).select(F.explode(pairs).alias("claim")).select("claim.*")


def _numbered(named: DataFrame, claims: DataFrame, order: list[str]) -> DataFrame:
    """``order``, ``base`` and the free number of each row, by two rankings of rows and claims."""
    merged = claims.withColumn("_kind", F.lit(0)).unionByName(named.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    ranked = rank_in_groups(merged, ["base", "_kind"], ["_claimed", *order], "_rank")
    place = F.when(F.col("_kind") == 0, F.col("_claimed") - F.col("_rank")).otherwise(F.col("_rank"))
    placed = rank_in_groups(
        ranked.withColumn("_place", place), ["base"], ["_place", "_kind", "_claimed", *order], "_number"
    )
    return placed.where(F.col("_kind") == 1).select(*order, "base", "_number")


def unique_slugs(
    rows: DataFrame, title: str, order: Sequence[str], taken: DataFrame, taken_slug: str = "slug"
) -> DataFrame:
    """Columns ``order``, ``base`` and ``slug`` for every row of ``rows``.

    The rows of a base take base, base-1, base-2 ... in the order of ``order`` (unique per row),
    skipping slugs in ``taken``. A number is also skipped when it spells the base of another row
    of the batch, so that two rows can never end up with one slug.

    Let b0 < b1 < ... be the claimed numbers of a base. Below bj lie bj - j free ones, so the
    row with rank k passes bj exactly when bj - j <= k. Sorting claims by bj - j among the rows
    by k, claims first, therefore puts every row at the place that is its number. Two distributed
    rankings do this; no base, however frequent, is gathered in one task. In a large table, rows of bases
    without any claim are ranked once only: their rank is their number.
    """
    order = list(order)
    named = stage(rows.select(*order, slugify(title).alias("base")), "bases")
    bases = named.select("base").distinct()
    claims = _claims(taken, taken_slug, itself=True).unionByName(_claims(bases, "base", itself=False))
    claims = claims.distinct().join(bases, "base", "left_semi")
    if named.count() <= FEW_ROWS:
        numbered = _numbered(named, claims, order)
    else:
        claims = stage(claims, "claims")
        contested = claims.select("base").distinct()
        plain = rank_in_groups(named.join(contested, "base", "left_anti"), ["base"], order, "_number")
        rivals = named.join(contested, "base", "left_semi")
        numbered = plain.select(*order, "base", "_number").unionByName(_numbered(rivals, claims, order))
    number = F.col("_number")
    suffix = F.when(number > 0, F.concat(F.lit("-"), number.cast("string"))).otherwise("")
    return numbered.select(*order, "base", F.concat("base", suffix).alias("slug"))
