"""Ranges of dates and times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Bound = dt.date | dt.datetime | None


def between(df: DataFrame, column: str, start: Bound, end: Bound) -> DataFrame:
    """Rows with ``start <= column < end``; an open end adds no filter.

    Bounds take the type of the column, so the session's time zone moves neither side of the comparison
    where the column has none.
    """
    kind = df.schema[column].dataType
    c = F.col("`" + column.replace("`", "``") + "`")

    def bound(value: dt.date | dt.datetime) -> Column:
        local = isinstance(kind, (T.DateType, T.TimestampNTZType, T.StringType))
        if not local or (isinstance(kind, T.DateType) and not isinstance(value, dt.datetime)):
            return F.lit(value)
        return F.to_timestamp_ntz(F.lit(value.isoformat(" ") if isinstance(value, dt.datetime) else f"{value} 00:00:00"))

    if start is not None:
        df = df.where(c >= bound(start))
    if end is not None:
        df = df.where(c < bound(end))
    return df
