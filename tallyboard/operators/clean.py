"""Cleaning steps: fill, complete, convert, conform, check keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.scratch import stage

from tallyboard.functions.calendar import as_column


def select_in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace null and NaN by a default per column; names the frame lacks are ignored."""
    known = {c: v for c, v in defaults.items() if c in df.columns}
    return df.fillna(known) if known else df


def add_missing(df: DataFrame, defaults: Mapping[str, tuple[Any, str]]) -> DataFrame:
    """Add columns the frame lacks; ``defaults`` maps name to (value, type)."""
    missing = {c: F.lit(v).cast(t) for c, (v, t) in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def to_whole(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Convert columns to int, dropping fractions toward zero."""
    kinds = dict(df.dtypes)
    return df.withColumns({
        c: (F.col(c).cast("double") if kinds[c] == "string" else F.col(c)).cast("int") for c in columns
    })


def to_day(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Convert text ``YYYY-MM-DD`` or timestamps to date."""
    return df.withColumns({c: F.col(c).cast("date") for c in columns})


def _kind(t: str | T.DataType) -> str:
    return t if isinstance(t, str) else t.simpleString()


def strict_cast(c: Column | str, kind: str | T.DataType) -> Column:
    """Cast that fails the job on a value the type cannot hold, whatever the session's ANSI mode."""
    value = as_column(c)
    cast = value.try_cast(_kind(kind))
    message = F.concat(F.lit(f"value does not fit {_kind(kind)}: "), value.cast("string"))
    return F.when(cast.isNotNull() | value.isNull(), cast).otherwise(F.raise_error(message).cast(_kind(kind)))


def conform(df: DataFrame, kinds: Mapping[str, str | T.DataType]) -> DataFrame:
    """Give columns their table types; decimals round half away from zero, overflow fails."""
    return df.withColumns({c: strict_cast(c, t) for c, t in kinds.items()})


_FITS = "_conform_fits"


def conform_or_reject(df: DataFrame, kinds: Mapping[str, str | T.DataType]) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the types, converted, and the rows with a value that does not, as they came.

    The input is evaluated once: marked rows are written, and both frames are read from there, so they complete each other even if
    the input could change.
    """
    def misfit(c: str) -> Column:
        return F.col(c).isNotNull() & F.col(c).try_cast(_kind(kinds[c])).isNull()

    wrong = F.lit(False)
    for c in kinds:
        wrong = wrong | misfit(c)
    marked = stage(df.withColumn(_FITS, ~wrong), "conformed")
    good = marked.where(_FITS).drop(_FITS).withColumns({c: F.col(c).try_cast(_kind(t)) for c, t in kinds.items()})
    return good, marked.where(~F.col(_FITS)).drop(_FITS)


def key_violations(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Keys that break NOT NULL or UNIQUE, with the rule and the number of rows.

    One partial aggregation per task comes before the shuffle, so a hot key costs nothing extra.
    """
    keys = [key] if isinstance(key, str) else list(key)
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(some_null | (F.col("rows") > 1)).select(
        *keys, F.when(some_null, "null key").otherwise("duplicate key").alias("violation"), "rows"
    )
