"""Chart specs answered with lazily built DataFrames."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.functions.calendar import day, day_name, month_name
from tallyboard.functions.ranges import between
from tallyboard.plans import metrics as M

# Words looked for in lower-cased column names.
DATE_WORDS = ("date", "time", "timestamp")
NOT_CATEGORY_WORDS = ("id", "amount", "count")
NUMERIC_WORDS = ("amount", "value", "price", "score", "count", "number")

# Labels, default metrics and row limits of chart queries.
WEEKDAY_LABEL = "Day of Week"
MONTH_LABEL = "Month"
DAY_LABEL = "day"
DEFAULT_METRIC = "count"
LINE_METRIC = "AVG(nps_score)"
BAR_METRIC = "nps_score"
SERIES_LIMIT = 10000
BUBBLE_LIMIT = 100
BIG_NUMBER, LINE, BARS, BUBBLE = "big_number_total", "line", ("dist_bar", "bar"), "bubble"
# A time range that keeps all rows, and the operator of a time range in a filter object.
NO_FILTER = "No filter"
TEMPORAL_RANGE = "TEMPORAL_RANGE"


class ChartError(ValueError):
    """A spec that cannot be answered over its dataset."""


def select_column(columns: Sequence[str], kind: str) -> str | None:
    """The first column whose name looks like a date, a category or a number."""
    def hit(name: str, words: Sequence[str]) -> bool:
        return any(w in name.lower() for w in words)

    tests: dict[str, Callable[[str], bool]] = {
        "date": lambda c: hit(c, DATE_WORDS),
        "category": lambda c: not hit(c, NOT_CATEGORY_WORDS),
        "numeric": lambda c: hit(c, NUMERIC_WORDS),
    }
    return next(filter(tests[kind], columns), None) if kind in tests else None


@dataclass(frozen=True)
class Dataset:
    """A table with its named metrics (name to SQL text)."""

    df: DataFrame
    metrics: Mapping[str, str] = field(default_factory=lambda: dict(M.DEFAULT_METRICS))
    date_column: str | None = None

    def date(self) -> str:
        found = self.date_column or select_column(self.df.columns, "date")
        if found is None:
            raise ChartError(f"no date column among {', '.join(self.df.columns)}")
        return found


TimeRange = tuple[dt.date | dt.datetime | None, dt.date | dt.datetime | None]


@dataclass(frozen=True)
class Filter:
    """One condition on a column, as a spec's filter object says it."""

    column: str
    operator: str
    value: Any = None

    @classmethod
    def from_dict(cls, spec: Any) -> Filter:
        """``col, op, val`` or ``subject, operator, comparator``."""
        if not isinstance(spec, Mapping):
            raise ChartError(f"a filter is an object, not {spec!r}")
        column, operator = spec.get("col", spec.get("subject")), spec.get("op", spec.get("operator"))
        if not isinstance(column, str) or not isinstance(operator, str):
            raise ChartError(f"filter without column or operator: {dict(spec)}")
        value = spec.get("val", spec.get("comparator"))
        return cls(column, operator, time_range(value) if operator == TEMPORAL_RANGE else value)


def time_range(value: Any) -> TimeRange | None:
    """A pair of bounds, either open, or text ``start : end``; nothing or "No filter" keeps all rows."""
    if value is None or value == NO_FILTER:
        return None
    if isinstance(value, str):
        ends = [e.strip() for e in re.split(r"\s+:\s*|\s*:\s+", f" {value} ")]
        try:
            value = [dt.datetime.fromisoformat(e) if e else None for e in ends]
        except ValueError as error:
            raise ChartError(f"time range {value!r}: {error}") from None
    if not isinstance(value, (list, tuple)) or len(value) != 2 or not all(v is None or isinstance(v, dt.date) for v in value):
        raise ChartError(f"a time range is two dates, not {value!r}")
    return tuple(value)


@dataclass(frozen=True)
class ChartSpec:
    """What to show: a metric (or several), what to split it by, and which rows count."""

    name: str
    viz_type: str
    metric: Any = None
    x_axis: str | None = None
    groupby_type: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    time_range: TimeRange | None = None
    where: str = ""
    having: str = ""
    filters: tuple[Filter, ...] = ()
    # The order in which a limit takes rows; None is what the chart type does by itself.
    order_desc: bool | None = None

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> ChartSpec:
        if not isinstance(spec, Mapping):
            raise ChartError(f"a chart spec is an object, not {spec!r}")
        missing = [k for k in ("name", "viz_type") if k not in spec]
        if missing:
            raise ChartError(f"chart spec without {' and '.join(missing)}: {dict(spec)}")
        params, filters = spec.get("custom_params") or {}, spec.get("filters", spec.get("adhoc_filters")) or ()
        kinds = {
            "name": (spec["name"], str), "viz_type": (spec["viz_type"], str), "x_axis": (spec.get("x_axis"), (str, type(None))),
            "groupby_type": (spec.get("groupby_type"), (str, type(None))), "custom_params": (params, Mapping),
            "where": (spec.get("where", ""), str), "having": (spec.get("having", ""), str),
            "filters": (filters, (list, tuple)), "order_desc": (spec.get("order_desc"), (bool, type(None))),
        }
        for key, (value, kind) in kinds.items():
            if not isinstance(value, kind):
                raise ChartError(f"{key} of chart {spec['name']!r} cannot be {value!r}")
        return cls(
            spec["name"], spec["viz_type"], spec.get("metric"), spec.get("x_axis"), spec.get("groupby_type"), params,
            time_range(spec.get("time_range")), spec.get("where", ""), spec.get("having", ""),
            tuple(Filter.from_dict(f) for f in filters), spec.get("order_desc"),
        )


@dataclass(frozen=True)
class Key:
    """What a chart is split by. ``origin`` tells keys of one name apart: a column, or what is derived from which one."""

    name: str
    column: Column
    origin: str

    @classmethod
    def of(cls, name: str) -> Key:
        return cls(name, F.col(quoted(name)), f"column {name}")


@dataclass(frozen=True)
class Query:
    """A chart query in the terms of a DataFrame: rows, keys, aggregates, order, limit."""

    keys: tuple[Key, ...]
    metrics: tuple[M.Metric, ...]
    order: str = "keys"
    descending: bool = False
    limit: int | None = None

    def __post_init__(self) -> None:
        names = [k.name for k in self.keys] + [m.label for m in self.metrics]
        twice = {n for n in names if names.count(n) > 1}
        if twice:
            raise ChartError(f"two columns of one chart are called {', '.join(sorted(twice))}")


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


# --- filters ---------------------------------------------------------------------------------


def in_time_range(df: DataFrame, column: str, bounds: Any) -> DataFrame:
    """Rows with ``start <= column < end``; no bounds, "No filter" or an open end adds no filter."""
    return between(df, column, *(time_range(bounds) or (None, None)))


def where_text(df: DataFrame, text: str) -> DataFrame:
    return df.where(text) if text.strip() else df


def equals(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.where(F.col(quoted(column)) == F.lit(value))


def with_expression(df: DataFrame, sql: str, label: str) -> DataFrame:
    """Add a computed, labelled column."""
    return df.withColumn(label, F.expr(sql))


def filtered(df: DataFrame, condition: Filter) -> DataFrame:
    """Rows that meet a filter object."""
    if condition.column not in df.columns:
        raise ChartError(f"no column {condition.column!r} to filter by")
    if condition.operator == TEMPORAL_RANGE:
        return in_time_range(df, condition.column, condition.value)
    c, value, operator = F.col(quoted(condition.column)), condition.value, condition.operator.upper()
    if operator in ("IN", "NOT IN"):
        if not isinstance(value, (list, tuple)):
            raise ChartError(f"{condition.operator} takes a list, not {value!r}")
        return df.where(c.isin(*value) if operator == "IN" else ~c.isin(*value))
    if operator in ("IS NULL", "IS NOT NULL"):
        return df.where(c.isNull() if operator == "IS NULL" else c.isNotNull())
    compared = {
        "==": lambda: c == value, "=": lambda: c == value, "!=": lambda: c != value, "<>": lambda: c != value, "<": lambda: c < value,
        "<=": lambda: c <= value, ">": lambda: c > value, ">=": lambda: c >= value, "LIKE": lambda: c.like(value),
    }
    if operator not in compared:
        raise ChartError(f"no filter operator {condition.operator!r}")
    return df.where(compared[operator]())


def source_rows(data: Dataset, spec: ChartSpec) -> DataFrame:
    df = in_time_range(data.df, data.date(), spec.time_range) if time_range(spec.time_range) else data.df
    return where_text(reduce(filtered, spec.filters, df), spec.where)


# --- one query per chart type ------------------------------------------------------------------


def _resolve_all(metric: Any, bare: str, data: Dataset) -> tuple[M.Metric, ...]:
    several = metric if isinstance(metric, (list, tuple)) else [metric]
    wrong = [m for m in several if not isinstance(m, (str, Mapping))]
    if wrong:
        raise ChartError(f"a metric is text or an object, not {wrong[0]!r}")
    return tuple(M.resolve(m, bare, data.metrics) for m in several)


def _limit(spec: ChartSpec, default: int | None) -> int | None:
    """The row limit of a spec; None there means all rows."""
    limit = spec.params.get("row_limit", default)
    if limit is not None and (not isinstance(limit, int) or isinstance(limit, bool) or limit < 0):
        raise ChartError(f"row_limit cannot be {limit!r}")
    return limit


def _descending(spec: ChartSpec, default: bool) -> bool:
    return default if spec.order_desc is None else spec.order_desc


def big_number(data: Dataset, spec: ChartSpec) -> Query:
    return Query((), _resolve_all(spec.metric or DEFAULT_METRIC, M.NAMED, data))


def _day_key(data: Dataset) -> Key:
    return Key(DAY_LABEL, day(data.date()), f"day of {data.date()}")


def line(data: Dataset, spec: ChartSpec) -> Query:
    padded = not spec.params.get("trim", False)
    x = spec.x_axis
    # Weekday and month are always derived from the date, even where a column has that name.
    if x == "day_of_week":
        key = Key(WEEKDAY_LABEL, day_name(data.date(), padded), f"weekday of {data.date()}, padded {padded}")
    elif x == "month":
        key = Key(MONTH_LABEL, month_name(data.date(), padded), f"month of {data.date()}, padded {padded}")
    elif (x or "date") in data.df.columns:
        key = Key.of(x or "date")
    else:
        key = _day_key(data)
    metrics = _resolve_all(spec.metric or LINE_METRIC, M.AVERAGE, data)
    return Query((key,), metrics, descending=_descending(spec, False), limit=_limit(spec, SERIES_LIMIT))


def bar(data: Dataset, spec: ChartSpec) -> Query:
    """A bar chart is the daily total of its metric; any group-by is ignored."""
    metrics = _resolve_all(spec.metric or BAR_METRIC, M.TOTAL, data)
    return Query((_day_key(data),), metrics, descending=_descending(spec, False), limit=_limit(spec, SERIES_LIMIT))


def bubble(data: Dataset, spec: ChartSpec) -> Query:
    columns, p = data.df.columns, spec.params
    wanted = [
        p.get("x") or select_column(columns, "numeric"),
        p.get("y") or select_column(columns, "numeric"),
        p.get("series") or select_column(columns, "category"),
    ]
    keys = tuple(Key.of(c) for c in dict.fromkeys(wanted) if c)
    size = p.get("size", spec.metric or DEFAULT_METRIC)
    return Query(keys, _resolve_all(size, M.NAMED, data), "metric", _descending(spec, True), _limit(spec, BUBBLE_LIMIT))


def generic(data: Dataset, spec: ChartSpec) -> Query:
    kind = spec.groupby_type
    picked = (data.date_column if kind == "date" else None) or select_column(data.df.columns, kind or "")
    by = spec.params.get("groupby") or ([picked] if picked else [])
    metrics = _resolve_all(spec.params.get("metrics") or spec.metric or DEFAULT_METRIC, M.NAMED, data)
    return Query(tuple(Key.of(c) for c in by), metrics, "metric", _descending(spec, True), _limit(spec, None))


def plan_query(data: Dataset, spec: ChartSpec) -> Query:
    """The query of a spec by its chart type; unknown types are generic."""
    builders = {BIG_NUMBER: big_number, LINE: line, BUBBLE: bubble, **dict.fromkeys(BARS, bar)}
    return builders.get(spec.viz_type, generic)(data, spec)


def _aggregate(rows: DataFrame, keys: Sequence[Key], aggregates: Sequence[Column]) -> DataFrame:
    if not keys:
        return rows.agg(*aggregates)
    return rows.groupBy(*[k.column.alias(k.name) for k in keys]).agg(*aggregates)


def _limited(df: DataFrame, q: Query) -> DataFrame:
    """The first rows by x value, or by first metric and then all keys, so that a limit is stable.

    Without a limit nothing is sorted: a chart needs no global order, and sorting would shuffle
    every group once more.
    """
    if not q.keys or q.limit is None:
        return df
    ordered = F.desc_nulls_last if q.descending else F.asc_nulls_last
    if q.order == "metric":
        names = [ordered(quoted(q.metrics[0].label)), *[F.asc_nulls_last(quoted(k.name)) for k in q.keys]]
    else:
        names = [ordered(quoted(k.name)) for k in q.keys]
    return df.orderBy(*names).limit(q.limit)


def chart(data: Dataset, spec: ChartSpec | Mapping[str, Any]) -> DataFrame:
    """The rows of a chart: its keys and one column per metric."""
    spec = spec if isinstance(spec, ChartSpec) else ChartSpec.from_dict(spec)
    q = plan_query(data, spec)
    grouped = _aggregate(source_rows(data, spec), q.keys, [m.aliased() for m in q.metrics])
    return _limited(where_text(grouped, spec.having), q)


# --- many charts over one dataset --------------------------------------------------------------


@dataclass(frozen=True)
class Rejected:
    name: str | None
    reason: str


def _same_rows(spec: ChartSpec) -> tuple:
    """Charts with equal values read the same rows."""
    filters = tuple((f.column, f.operator, repr(f.value)) for f in spec.filters)
    return repr(spec.time_range), spec.where.strip(), filters


def _cell(chart: str, label: str, c: Column, kind: T.DataType) -> list[Column]:
    """Chart, metric, value and text of a metric column."""
    number = c.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
    text = F.lit(None).cast("string") if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else c.cast("string")
    return [F.lit(chart), F.lit(label), number, text]


def _x_value(keys: Sequence[Column]) -> Column:
    """The key as text; several keys are a JSON array, which tells nulls and separators inside a key apart."""
    xs = [k.cast("string") for k in keys] or [F.lit(None).cast("string")]
    return xs[0] if len(xs) == 1 else F.to_json(F.array(*xs))


def _long(df: DataFrame, keys: Sequence[str], cells: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Long rows from columns; ``cells`` holds chart, metric label, column."""
    args = [part for name, label, column in cells for part in _cell(name, label, F.col(quoted(column)), df.schema[column].dataType)]
    stacked = F.stack(F.lit(len(cells)), *args).alias("chart", "metric", "value", "text")
    return df.select(_x_value([F.col(quoted(k)) for k in keys]).alias("x"), stacked).select("chart", "x", "metric", "value", "text")


def _alone(data: Dataset, spec: ChartSpec, q: Query) -> DataFrame:
    return _long(chart(data, spec), [k.name for k in q.keys], [(spec.name, m.label, m.label) for m in q.metrics])


_SET, _EMPTY, _OF, _NTH = "_batch_set", "_batch_empty", "_batch_chart", "_batch_nth"
#: A rank that no row of a chart without a limit reaches: each of its rows is ranked nearly alone.
_BEYOND = 1000
#: The setting that says up to which rank tasks drop rows before a shuffle.
_EARLY_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
#: Shares of a chart with a larger limit, each of which keeps as many rows as the limit.
_SHARES = 64


#: Metrics that a hash table of groups can hold.
_HASHED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _key_name(j: int) -> str:
    return f"_batch_key_{j}"


def _shared_aggregate(rows: DataFrame, keys: Mapping[str, Key], sets: Sequence[tuple[str, ...]], aggregates: Sequence[Column]) -> DataFrame:
    """All aggregates for each set of keys, with the number of the set, from one reading of the rows.

    Without keys there is a row even where there are no rows to read. It is made from an empty frame, which costs no
    reading, and marked, as it only counts if no other row of its set is there.
    """
    names = {origin: _key_name(j) for j, origin in enumerate(keys)}
    keyed = rows.withColumns({names[o]: k.column for o, k in keys.items()})
    columns = [F.col(n) for n in names.values()]
    if len(sets) == 1:
        found = keyed.groupBy(*columns).agg(*aggregates).withColumn(_SET, F.lit(0))
    else:
        grouped = keyed.groupingSets([[F.col(names[o]) for o in s] for s in sets], *columns).agg(F.grouping_id(*columns).alias("_batch_id"), *aggregates)
        # Bits of the id are set for keys that a set does without, the first key's being the highest.
        ids = [sum(1 << (len(names) - 1 - j) for j, o in enumerate(names) if o not in s) for s in sets]
        number = F.coalesce(*[F.when(F.col("_batch_id") == g, F.lit(k)) for k, g in enumerate(ids)])
        found = grouped.withColumn(_SET, number).drop("_batch_id")
    found = found.withColumn(_EMPTY, F.lit(False))
    if () not in sets:
        return found
    nothing = keyed.where(F.lit(False))
    kinds = {f.name: f.dataType for f in keyed.schema}
    nothing = nothing.agg(*aggregates).withColumns({n: F.lit(None).cast(kinds[n]) for n in names.values()} | {_SET: F.lit(list(sets).index(())), _EMPTY: F.lit(True)})
    return found.unionByName(nothing)


def _first_rows(rows: DataFrame, share: Sequence[Column], order: Sequence[Column], limits: Mapping[int, int]) -> DataFrame:
    """The first rows of each chart and share, by the chart's limit; rows of charts without one stay."""
    nth = F.row_number().over(Window.partitionBy(_OF, *share).orderBy(*order))
    rows = rows.withColumn(_NTH, nth).where(F.col(_NTH) <= max(_BEYOND, *limits.values()))
    return rows.where(F.coalesce(*[F.when(F.col(_OF) == i, F.col(_NTH) <= n) for i, n in limits.items()], F.lit(True))).drop(_NTH)


def _fused(data: Dataset, members: Sequence[tuple[ChartSpec, Query]]) -> DataFrame:
    """Charts over the same rows as one plan: one aggregate over all their keys, one ranking for all their limits."""
    keys = {k.origin: k for _, q in members for k in q.keys}
    sets = list(dict.fromkeys(tuple(sorted(k.origin for k in q.keys)) for _, q in members))
    numbered = [(i, m) for i, (_, q) in enumerate(members) for m in q.metrics]
    wide = _shared_aggregate(source_rows(data, members[0][0]), keys, sets, [m.aliased(f"_batch_metric_{j}") for j, (_, m) in enumerate(numbered)])
    key_of = {origin: F.col(_key_name(j)) for j, origin in enumerate(keys)}
    own = [[j for j, (k, _) in enumerate(numbered) if k == i] for i in range(len(members))]
    charts_of = [[i for i, (_, q) in enumerate(members) if tuple(sorted(k.origin for k in q.keys)) == s] for s in sets]
    chosen = F.coalesce(*[F.when(F.col(_SET) == k, F.array(*map(F.lit, found))) for k, found in enumerate(charts_of)])
    rows = wide.withColumn(_OF, F.explode(chosen))

    def only(i: int, c: Column) -> Column:
        return F.when(F.col(_OF) == i, c)

    # One order for all: in the rows of a chart, the other charts' terms are null.
    order, limits = [F.asc(_EMPTY)], {}
    for i, (_, q) in enumerate(members):
        limit = q.limit if q.keys else 1
        if limit is None:
            continue
        limits[i] = limit
        down = F.desc_nulls_last if q.descending else F.asc_nulls_last
        by = [key_of[k.origin] for k in q.keys]
        if q.order == "metric":
            order += [down(only(i, F.col(f"_batch_metric_{own[i][0]}"))), *[F.asc_nulls_last(only(i, c)) for c in by]]
        else:
            order += [down(only(i, c)) for c in by]
    if limits:
        spread = F.xxhash64(*key_of.values()) if keys else F.lit(0).cast("long")
        alone = F.when(~F.col(_OF).isin(*limits), spread)
        # Up to a set limit Spark lets tasks drop rows before the shuffle; a larger one is first taken from shares of a chart.
        if max(limits.values()) > int(rows.sparkSession.conf.get(_EARLY_LIMIT)):
            rows = _first_rows(rows, [F.coalesce(alone, F.pmod(spread, F.lit(_SHARES)))], order, limits)
        rows = _first_rows(rows, [alone], order, limits)
    x = F.coalesce(*[only(i, _x_value([key_of[k.origin] for k in q.keys])) for i, (_, q) in enumerate(members)])
    kinds = {f.name: f.dataType for f in wide.schema}

    def cells(i: int) -> Column:
        made = []
        for j in own[i]:
            parts = _cell(members[i][0].name, numbered[j][1].label, F.col(f"_batch_metric_{j}"), kinds[f"_batch_metric_{j}"])
            made.append(F.struct(*[p.alias(n) for p, n in zip(parts, ("chart", "metric", "value", "text"), strict=True)]))
        return F.array(*made)

    filled = rows.select(x.alias("x"), F.explode(F.coalesce(*[only(i, cells(i)) for i in range(len(members))])).alias("cell"))
    return filled.select("cell.chart", "x", "cell.metric", "cell.value", "cell.text")


def chart_batch(
    data: Dataset, specs: Sequence[ChartSpec | Mapping[str, Any]]
) -> tuple[DataFrame | None, list[Rejected]]:
    """All charts in long form, and the specs that cannot be answered.

    The long form has columns chart, x, metric, value and text. ``x`` is the key, or a JSON array of several
    keys. ``text`` holds whole numbers and decimals digit for digit, and what is no number.

    Charts over the same rows (equal filters) are one plan: one aggregate over the sets of all their keys reads the table
    once, however many charts there are and whatever they are split by, and one ranking takes each chart's limit in its own order.
    Charts with a metric that is no number or time, such as the least of a text, are a plan of their own: Spark sorts rows for
    them, and would sort those of all others. Charts with a condition on their groups stand alone. Bad specs are found while plans are built; no job runs for them.
    """
    rejected: list[Rejected] = []
    fused: dict[Any, list[tuple[ChartSpec, Query]]] = {}
    for i, raw in enumerate(specs):
        name = raw.name if isinstance(raw, ChartSpec) else raw.get("name") if isinstance(raw, Mapping) else None
        try:
            spec = raw if isinstance(raw, ChartSpec) else ChartSpec.from_dict(raw)
            q = plan_query(data, spec)
            kinds = {f.name: f.dataType for f in chart(data, spec).schema}
            hashed = all(isinstance(kinds[m.label], _HASHED) for m in q.metrics)
            fused.setdefault(i if spec.having.strip() else (hashed, *_same_rows(spec)), []).append((spec, q))
        except (ChartError, M.MetricError, AnalysisException, TypeError, ValueError) as error:
            rejected.append(Rejected(name, str(error).splitlines()[0]))
    parts = [_alone(data, *members[0]) if len(members) == 1 else _fused(data, members) for members in fused.values()]
    return (reduce(DataFrame.unionByName, parts) if parts else None), rejected
