"""Matching incoming rows with rows that exist already."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(df: DataFrame, key: str, other: str) -> DataFrame:
    """Distinct keys under the name ``other``; repeats collapse before the shuffle."""
    return df.select(F.col(key).alias(other)).where(F.col(other).isNotNull()).distinct()


def new_rows(incoming: DataFrame, current: DataFrame, key: str, current_key: str | None = None) -> DataFrame:
    """Incoming rows whose key is not in ``current``; null keys match nothing, so they stay."""
    return incoming.join(_keys(current, current_key or key, key), key, "left_anti")


def present_rows(members: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None) -> DataFrame:
    """Rows whose key is listed."""
    return members.join(_keys(listed, listed_key or key, key), key, "left_semi")


def first_match(df: DataFrame, column: str, value: object, position: Sequence[str]) -> DataFrame:
    """The first row, by ``position``, whose ``column`` equals ``value``; no row if none does."""
    return df.where(F.col(column) == F.lit(value)).orderBy(*position).limit(1)


def first_ids(df: DataFrame, name: str, id_column: str, position: str) -> DataFrame:
    """Id of the first row of every name."""
    return df.groupBy(name).agg(F.min_by(id_column, position).alias(id_column))


def last_ids(df: DataFrame, name: str, id_column: str, position: str) -> DataFrame:
    """Id of the last row of every name: what a name-to-id listing keeps when names repeat."""
    return df.groupBy(name).agg(F.max_by(id_column, position).alias(id_column))


def lookup_first(wanted: DataFrame, df: DataFrame, name: str, id_column: str, position: str) -> DataFrame:
    """``wanted`` with the id of the first row of the same name, null where there is none."""
    return wanted.join(first_ids(df, name, id_column, position), name, "left")


def classify(
    incoming: DataFrame, existing: DataFrame, key: str, id_column: str, position: str | None = None,
    within: tuple[str, object] | None = None,
) -> DataFrame:
    """Incoming rows with ``action`` (update or create) and the id of the row to update.

    ``existing`` is reduced to one row per key first (the last by ``position``), so incoming rows
    are never multiplied; adaptive execution splits a hot key on the incoming side. With ``within``, a column
    and a value, only keys whose last row has that value there are known: a name that moved to another
    dataset is created anew.
    """
    place = position or id_column
    kept = [F.max_by(id_column, place).alias("existing_id")]
    if within:
        kept.append(F.max_by(within[0], place).alias("_within"))
    known = existing.where(F.col(key).isNotNull()).groupBy(key).agg(*kept)
    if within:
        known = known.where(F.col("_within") == F.lit(within[1]))
    known = known.select(key, "existing_id", F.lit(True).alias("_known"))
    joined = incoming.join(known, key, "left")
    action = F.when(F.col("_known"), "update").otherwise("create")
    return joined.select(*[incoming[c] for c in incoming.columns], "existing_id", action.alias("action"))


def without_members(text: Column | str, gone: Callable[[Column], Column], path: str = "$.meta.chartId") -> Column:
    """A JSON object as text, without the entries whose value has a whole number at ``path`` that is ``gone``.

    Other entries stay as they are, whatever their type; keys come out in order. Text that is no object is null.
    """
    entries = F.try_parse_json(text).try_cast("map<string, variant>")

    def stays(_key: Column, value: Column) -> Column:
        return ~F.coalesce(gone(F.try_variant_get(value, path, "bigint")), F.lit(False))

    return F.to_json(F.map_filter(entries, stays))


_HELD, _GONE = "_held_members", "_gone_members"


def without_listed_members(
    df: DataFrame, key: Sequence[str], text: str, gone: DataFrame, gone_id: str, path: str = "$.meta.chartId"
) -> DataFrame:
    """``df`` with JSON objects in ``text`` as :func:`without_members` leaves them, where the ids to remove are rows of a table.

    ``key`` is unique per row. Only keys and ids of entries meet the table, once each; texts are not exploded, and are only joined
    with the few rows that hold a listed id. A null id is in no list.
    """
    ids = F.transform(F.map_values(F.try_parse_json(text).try_cast("map<string, variant>")), lambda v: F.try_variant_get(v, path, "bigint"))
    held = df.select(*key, F.explode(F.array_distinct(F.array_compact(ids))).alias(_HELD))
    listed = present_rows(held, gone.select(F.col(gone_id).cast("bigint").alias(_HELD)), _HELD)
    found = listed.groupBy(*key).agg(F.collect_list(_HELD).alias(_GONE))
    joined = df.join(found, list(key), "left")
    kept = without_members(text, lambda c: F.array_contains(F.coalesce(_GONE, F.array().cast("array<bigint>")), c), path)
    return joined.select(*[kept.alias(c) if c == text else F.col(c) for c in df.columns])
