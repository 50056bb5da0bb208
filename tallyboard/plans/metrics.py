"""Metrics of charts: text, bare names and metric objects resolved to aggregate columns."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The metric every dataset has.
COUNT_ALL = "COUNT(*)"
DEFAULT_METRICS = {"count": COUNT_ALL}

# What a bare name stands for.
AVERAGE, TOTAL, NAMED = "AVG", "SUM", "named"

_CALL = re.compile(r"\s*(\w+)\s*\((.*)\)\s*", re.DOTALL)


class MetricError(ValueError):
    """A metric that cannot be understood, or that names no metric of the dataset."""


@dataclass(frozen=True)
class Metric:
    label: str
    column: Column

    def aliased(self, name: str | None = None) -> Column:
        return self.column.alias(name or self.label)


def _closes_itself(inner: str) -> bool:
    """True if no parenthesis in ``inner`` closes one opened before it."""
    depth = 0
    for ch in inner:
        depth += (ch == "(") - (ch == ")")
        if depth < 0:
            return False
    return depth == 0


def _expression(text: str, label: str | None = None) -> Metric:
    return Metric(label or text, F.count(F.lit(1)) if text == COUNT_ALL else F.expr(text))


def from_text(text: str) -> Metric:
    """``agg(column)``: function in upper case, ``*`` always counts rows.

    A longer expression, such as a ratio of two aggregates, is taken as it is written.
    """
    call = _CALL.fullmatch(text)
    if call and _closes_itself(call[2]):
        function, argument = call[1].upper(), call[2].strip()
        return _expression(COUNT_ALL if argument == "*" else f"{function}({argument})")
    return _expression(text.strip())


def from_name(name: str, bare: str, named: Mapping[str, str]) -> Metric:
    """A bare name: an average, a total, or a named metric of the dataset."""
    if bare in (AVERAGE, TOTAL):
        return _expression(f"{bare}({name})")
    if name not in named:
        raise MetricError(f"no metric named {name!r}; known: {', '.join(sorted(named)) or 'none'}")
    return Metric(name, from_text(named[name]).column)


def from_object(spec: Mapping[str, Any]) -> Metric:
    """A metric object: SQL text with a label, or an aggregate over a column."""
    sql, label = spec.get("sqlExpression"), spec.get("label")
    if sql:
        metric = from_text(sql)
        return Metric(label or metric.label, metric.column)
    if not spec.get("aggregate"):
        raise MetricError(f"metric object without sqlExpression or aggregate: {dict(spec)}")
    column = spec.get("column")
    if isinstance(column, Mapping):
        column = column.get("column_name")
    metric = from_text(f"{spec['aggregate']}({column or '*'})")
    return Metric(label or metric.label, metric.column)


def resolve(spec: str | Mapping[str, Any], bare: str = NAMED, named: Mapping[str, str] = DEFAULT_METRICS) -> Metric:
    """Any way of writing a metric. Unknown columns and functions fail when the frame is built."""
    if isinstance(spec, Mapping):
        return from_object(spec)
    if "(" in spec and ")" in spec:
        return from_text(spec)
    return from_name(spec.strip(), bare, named)
