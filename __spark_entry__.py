"""

``entry`` is the flagship chart; ``queries`` and ``oracle_sql`` share their keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.functions import calendar as cal
from tallyboard.functions import scores, text
from tallyboard.operators import clean, datasets, ranking, reconcile, slugs, stats, upsert, windows
from tallyboard.plans import charts, load, metrics
from tallyboard.plans.charts import ChartSpec, Dataset, chart
from tallyboard.scratch import new_folder
from tallyboard.sources import csv, json_rows, tables

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _bind(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name together with its SQL."""
    def register(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        _SQL[query.__name__] = sql
        return query
    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Sums and averages of doubles depend on the order of rows in their last bits."""
    return df.withColumn(column, F.round(charts.quoted(column), digits))


# --- big numbers and ways to write a metric -----------------------------------------------------


@_bind('SELECT count(*) AS "count" FROM orders')
def big_number_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chart(Dataset(_table(spark, sf_dir, "orders")), {"name": "Total Records", "viz_type": "big_number_total"})


@_bind('SELECT round(avg(o_totalprice), 2) AS "Average Price" FROM orders')
def big_number_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = {
        "expressionType": "SQL", "sqlExpression": "ROUND(AVG(o_totalprice), 2)",
        "label": "Average Price", "hasCustomLabel": True,
    }
    spec = {"name": "Average", "viz_type": "big_number_total", "metric": metric}
    return chart(Dataset(_table(spark, sf_dir, "orders")), spec)


@_bind("SELECT count(*) AS named, count(*) AS written, count(*) AS simple, count(*) AS sql FROM events")
def count_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    spellings = {
        "named": "count_all_records",
        "written": "count( * )",
        "simple": {"expressionType": "SIMPLE", "aggregate": "COUNT", "column": None, "sqlExpression": None},
        "sql": {"expressionType": "SQL", "sqlExpression": "COUNT(*)", "label": "COUNT(*)"},
    }
    named = {"count_all_records": "COUNT(*)"}
    resolved = [metrics.resolve(m, named=named).aliased(label) for label, m in spellings.items()]
    return _table(spark, sf_dir, "events").agg(*resolved)


# --- series ---------------------------------------------------------------------------------------


@_bind("""
SELECT CAST(ts AS DATE) AS day, round(avg(value), 2) AS "AVG(value)"
FROM events GROUP BY 1 ORDER BY 1 LIMIT 10000
""")
def series_daily_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = Dataset(_table(spark, sf_dir, "events"), date_column="ts")
    return _rounded(chart(data, {"name": "Trend", "viz_type": "line", "metric": "value"}), "AVG(value)")


@_bind("""
SELECT rpad(strftime(o_orderdate, '%A'), 9, ' ') AS "Day of Week",
       round(avg(o_totalprice), 2) AS "AVG(o_totalprice)"
FROM orders GROUP BY 1
""")
def series_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"name": "By weekday", "viz_type": "line", "metric": "AVG(o_totalprice)", "x_axis": "day_of_week"}
    return _rounded(chart(Dataset(_table(spark, sf_dir, "orders")), spec), "AVG(o_totalprice)")


@_bind("""
SELECT rpad(strftime(o_orderdate, '%B'), 9, ' ') AS "Month", max(o_totalprice) AS "MAX(o_totalprice)"
FROM orders GROUP BY 1
""")
def series_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"name": "By month", "viz_type": "line", "metric": "max(o_totalprice)", "x_axis": "month"}
    return chart(Dataset(_table(spark, sf_dir, "orders")), spec)


@_bind("""
SELECT c_mktsegment, round(avg(c_acctbal), 2) AS "AVG(c_acctbal)"
FROM customer GROUP BY 1 ORDER BY 1 LIMIT 10000
""")
def series_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"name": "By segment", "viz_type": "line", "metric": "AVG(c_acctbal)", "x_axis": "c_mktsegment"}
    return _rounded(chart(Dataset(_table(spark, sf_dir, "customer")), spec), "AVG(c_acctbal)")


@_bind("""
SELECT CAST(l_shipdate AS DATE) AS day, round(sum(l_extendedprice), 2) AS "SUM(l_extendedprice)"
FROM lineitem GROUP BY 1 ORDER BY 1 LIMIT 10000
""")
def bar_daily_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"name": "Daily", "viz_type": "dist_bar", "metric": "l_extendedprice", "groupby_type": "category"}
    return _rounded(chart(Dataset(_table(spark, sf_dir, "lineitem")), spec), "SUM(l_extendedprice)")


# --- bubble and generic charts --------------------------------------------------------------------


@_bind("""
SELECT p_size, p_brand, p_type, count(*) AS "count" FROM part
GROUP BY 1, 2, 3 ORDER BY "count" DESC, 1, 2, 3 LIMIT 100
""")
def bubble_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {
        "name": "Parts", "viz_type": "bubble", "metric": "count",
        "custom_params": {"x": "p_size", "y": "p_brand", "series": "p_type", "size": "count"},
    }
    return chart(Dataset(_table(spark, sf_dir, "part")), spec)


@_bind("""
SELECT o_totalprice, o_orderstatus, count(*) AS "COUNT(*)" FROM orders
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 25
""")
def bubble_default_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x and y both default to the first numeric-looking column."""
    spec = {
        "name": "Prices", "viz_type": "bubble", "metric": "COUNT(*)",
        "custom_params": {"series": "o_orderstatus", "row_limit": 25},
    }
    return chart(Dataset(_table(spark, sf_dir, "orders")), spec)


@_bind("""
SELECT l_returnflag, count(*) AS "COUNT(*)", round(sum(l_extendedprice), 2) AS revenue,
       max(l_quantity) AS "MAX(l_quantity)"
FROM lineitem GROUP BY 1
""")
def generic_multi_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ChartSpec(
        "Flags", "table", params={"groupby": ["l_returnflag"]},
        metric=["COUNT(*)", {"sqlExpression": "SUM(l_extendedprice)", "label": "revenue"}, "MAX(l_quantity)"],
    )
    return _rounded(chart(Dataset(_table(spark, sf_dir, "lineitem")), spec), "revenue")


@_bind('SELECT quality, count(*) AS "count" FROM labels GROUP BY 1')
def generic_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped by the first column that looks like a category."""
    spec = {"name": "Quality", "viz_type": "pie", "groupby_type": "category"}
    return chart(Dataset(_table(spark, sf_dir, "labels")), spec)


@_bind("""
SELECT l_shipdate, count(*) AS "COUNT(*)" FROM lineitem GROUP BY 1
""")
def generic_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"name": "Shipped", "viz_type": "echarts_timeseries", "metric": "COUNT(*)", "groupby_type": "date"}
    return chart(Dataset(_table(spark, sf_dir, "lineitem")), spec)


@_bind("""
WITH o AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS day FROM orders),
weekday AS (
  SELECT rpad(strftime(o_orderdate, '%A'), 9, ' ') AS x, round(avg(o_totalprice), 2) AS mean,
         max(o_totalprice) AS highest, count(*) AS n
  FROM o GROUP BY 1),
daily AS (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS x, round(sum(o_totalprice), 2) AS total
  FROM o GROUP BY 1 ORDER BY 1 LIMIT 10000),
shift AS (SELECT day AS x, round(sum(o_totalprice), 2) AS total FROM o GROUP BY 1),
both_ AS (SELECT to_json([day, o_orderpriority])::VARCHAR AS x, count(*) AS n, max(o_orderkey) AS k FROM o GROUP BY day, o_orderpriority)
SELECT 'Mean' AS chart, x, 'AVG(o_totalprice)' AS metric, mean AS value, CAST(NULL AS VARCHAR) AS text FROM weekday
UNION ALL SELECT 'Highest', x, 'MAX(o_totalprice)', highest, NULL FROM weekday
UNION ALL SELECT 'Rows', x, 'COUNT(*)', CAST(n AS DOUBLE), CAST(n AS VARCHAR) FROM weekday
UNION ALL SELECT 'Daily', x, 'SUM(o_totalprice)', total, NULL FROM daily
UNION ALL SELECT 'By shift', x, 'SUM(o_totalprice)', total, NULL FROM shift
UNION ALL SELECT 'Both', x, 'COUNT(*)', CAST(n AS DOUBLE), CAST(n AS VARCHAR) FROM both_
UNION ALL SELECT 'Last', x, 'MAX(o_orderkey)', CAST(k AS DOUBLE), CAST(k AS VARCHAR) FROM both_
UNION ALL SELECT 'Total', NULL, 'count', CAST(count(*) AS DOUBLE), CAST(count(*) AS VARCHAR) FROM o
UNION ALL SELECT 'First', NULL, 'MIN(o_orderstatus)', NULL, min(o_orderstatus) FROM o
""")
def chart_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real column called day stands beside the day of a bar chart; keys may be null, and two together."""
    weekday = {"viz_type": "line", "x_axis": "day_of_week"}
    both = {"viz_type": "table", "custom_params": {"groupby": ["day", "o_orderpriority"]}}
    specs = [
        {"name": "Mean", "metric": "AVG(o_totalprice)", **weekday},
        {"name": "Highest", "metric": "MAX(o_totalprice)", **weekday},
        {"name": "Rows", "metric": "COUNT(*)", **weekday},
        {"name": "Daily", "viz_type": "bar", "metric": "o_totalprice"},
        {"name": "By shift", "viz_type": "line", "metric": "SUM(o_totalprice)", "x_axis": "day"},
        {"name": "Both", "metric": "COUNT(*)", **both},
        {"name": "Last", "metric": "MAX(o_orderkey)", **both},
        {"name": "Total", "viz_type": "big_number_total"},
        {"name": "First", "viz_type": "big_number_total", "metric": "MIN(o_orderstatus)"},
        {"name": "Broken", "viz_type": "bar", "metric": "count"},
        {"name": "Number for a metric", "viz_type": "bar", "metric": 5},
        {"viz_type": "line"},
    ]
    shift = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    long, _rejected = charts.chart_batch(Dataset(_table(spark, sf_dir, "orders").withColumn("day", shift)), specs)
    return _rounded(long, "value")


# --- filters ----------------------------------------------------------------------------------------


@_bind("""
SELECT event_type, count(*) AS "COUNT(*)", round(sum(value), 2) AS "SUM(value)" FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1
""")
def temporal_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ChartSpec(
        "Ten days", "table", metric=["COUNT(*)", "SUM(value)"], params={"groupby": ["event_type"]},
        time_range=(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)),
    )
    return _rounded(chart(Dataset(_table(spark, sf_dir, "events"), date_column="ts"), spec), "SUM(value)")


@_bind("""
SELECT o_custkey, count(*) AS "COUNT(*)", max(o_totalprice) AS "MAX(o_totalprice)" FROM orders
WHERE o_orderstatus <> 'P' AND o_totalprice > 1000 GROUP BY 1 HAVING count(*) > 5
""")
def where_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ChartSpec(
        "Frequent", "table", metric=["COUNT(*)", "MAX(o_totalprice)"], params={"groupby": ["o_custkey"]},
        where="o_orderstatus <> 'P' AND o_totalprice > 1000", having="`COUNT(*)` > 5",
    )
    return chart(Dataset(_table(spark, sf_dir, "orders")), spec)


@_bind("""
SELECT CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS "SUM(o_totalprice)"
FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 30
""")
def series_desc_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last days of a daily series."""
    spec = {"name": "Latest", "viz_type": "bar", "metric": "o_totalprice", "order_desc": True, "custom_params": {"row_limit": 30}}
    return _rounded(chart(Dataset(_table(spark, sf_dir, "orders")), spec), "SUM(o_totalprice)")


@_bind("""
SELECT event_type, count(*) AS "COUNT(*)", max(value) AS "MAX(value)" FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' AND event_type IN ('click', 'view', 'error') AND value > 10
GROUP BY 1
""")
def filter_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {
        "name": "Filtered", "viz_type": "table", "metric": ["COUNT(*)", "MAX(value)"], "time_range": "No filter",
        "custom_params": {"groupby": ["event_type"]},
        "filters": [
            {"col": "ts", "op": "TEMPORAL_RANGE", "val": "2024-01-10 : 2024-01-20"},
            {"col": "ts", "op": "TEMPORAL_RANGE", "val": "No filter"},
            {"clause": "WHERE", "subject": "event_type", "operator": "IN", "comparator": ["click", "view", "error"], "expressionType": "SIMPLE"},
            {"col": "value", "op": ">", "val": 10},
        ],
    }
    return chart(Dataset(_table(spark, sf_dir, "events"), date_column="ts"), spec)


@_bind("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def equality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = charts.equals(_table(spark, sf_dir, "orders"), "o_orderpriority", "1-URGENT")
    return clean.select_in_order(urgent, ["o_orderkey", "o_totalprice"])


@_bind("""
SELECT upper(l_returnflag || l_linestatus) AS "Flag", round(sum(l_quantity), 2) AS "SUM(l_quantity)"
FROM lineitem GROUP BY 1
""")
def computed_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    labelled = charts.with_expression(items, "UPPER(CONCAT(l_returnflag, l_linestatus))", "Flag")
    spec = {"name": "Flags", "viz_type": "line", "metric": "SUM(l_quantity)", "x_axis": "Flag"}
    return _rounded(chart(Dataset(labelled), spec), "SUM(l_quantity)")


# --- calendar, scores, event windows --------------------------------------------------------------


@_bind("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%A') AS day_of_week,
       strftime(o_orderdate, '%B') AS month, CAST(week(o_orderdate) AS INTEGER) AS week_number,
       CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend, 'Q' || quarter(o_orderdate) AS quarter,
       strftime(o_orderdate, '%Y-%m-%d') AS day_text, CAST(o_orderdate AS DATE) AS parsed
FROM orders
""")
def calendar_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _table(spark, sf_dir, "orders").select("o_orderkey", cal.day("o_orderdate").alias("day"))
    full = cal.with_calendar(dated, "day").withColumn("day_text", cal.format_day("day"))
    return full.withColumn("parsed", cal.parse_day("day_text"))


@_bind("""
WITH weekly AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS day, count(*) AS orders, max(o_totalprice) AS highest
  FROM orders GROUP BY 1),
days AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM weekly)
SELECT CAST(days.day AS DATE) AS day, coalesce(orders, 0) AS orders, highest
FROM days LEFT JOIN weekly ON weekly.day = CAST(days.day AS DATE)
""")
def calendar_spine_gapfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a week stand on its Monday; the other days are filled in."""
    monday = F.date_trunc("week", "o_orderdate").cast("date")
    weekly = _table(spark, sf_dir, "orders").groupBy(monday.alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("highest")
    )
    return cal.fill_days(weekly, "day", ["orders"])


@_bind("""
WITH daily AS (
  SELECT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS day, count(*) AS orders, max(o_totalprice) AS highest
  FROM orders GROUP BY ALL),
days AS (
  SELECT o_orderpriority, o_orderstatus, unnest(s) AS day FROM (
    SELECT o_orderpriority, o_orderstatus, generate_series(min(day), max(day), INTERVAL 1 DAY) AS s FROM daily GROUP BY 1, 2))
SELECT o_orderpriority, o_orderstatus, CAST(days.day AS DATE) AS day, coalesce(orders, 0) AS orders, highest
FROM (SELECT o_orderpriority, o_orderstatus, CAST(day AS DATE) AS day FROM days) AS days
LEFT JOIN daily USING (o_orderpriority, o_orderstatus, day)
""")
def gapfill_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["o_orderpriority", "o_orderstatus"]
    daily = _table(spark, sf_dir, "orders").groupBy(*by, cal.day("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("highest")
    )
    return cal.fill_days(daily, "day", ["orders"], by)


@_bind("""
SELECT o_orderpriority, CAST(unnest(s) AS DATE) AS day FROM (
  SELECT o_orderpriority, generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY) AS s FROM orders GROUP BY 1)
""")
def calendar_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day between the first and the last order of each priority."""
    bounds = _table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return cal.day_spine(bounds, "first", "last")


@_bind("""
SELECT o_orderkey, round(
  CASE WHEN isodow(o_orderdate) >= 6 THEN CAST(0.95 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END
  * (1 + (month(o_orderdate) - 7) / CAST(5 AS DOUBLE) * CAST(0.15 AS DOUBLE))
  * CASE WHEN month(o_orderdate) IN (11, 12) THEN CAST(0.92 AS DOUBLE)
         WHEN month(o_orderdate) IN (7, 8) THEN CAST(1.05 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END, 6) AS factor
FROM orders
""")
def calendar_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    factor = F.round(scores.calendar_factor("o_orderdate"), 6)
    return _table(spark, sf_dir, "orders").select("o_orderkey", factor.alias("factor"))


@_bind("""
WITH d AS (SELECT o_orderkey, make_date(2024, month(o_orderdate), least(day(o_orderdate), 28)) AS d FROM orders)
SELECT o_orderkey, round(
  CASE WHEN isodow(d) >= 6 THEN CAST(0.95 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END
  * (1 + (month(d) - 7) / CAST(5 AS DOUBLE) * CAST(0.15 AS DOUBLE))
  * CASE WHEN month(d) IN (11, 12) THEN CAST(0.92 AS DOUBLE)
         WHEN month(d) IN (7, 8) THEN CAST(1.05 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END
  * CASE WHEN d BETWEEN DATE '2024-08-15' AND DATE '2024-08-25' THEN CAST(1.12 AS DOUBLE)
         WHEN d BETWEEN DATE '2024-09-10' AND DATE '2024-09-15' THEN CAST(0.75 AS DOUBLE)
         WHEN d BETWEEN DATE '2024-11-25' AND DATE '2024-12-05' THEN CAST(1.08 AS DOUBLE)
         WHEN d BETWEEN DATE '2024-12-20' AND DATE '2024-12-30' THEN CAST(0.88 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END, 6) AS factor
FROM d
""")
def calendar_event_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar factor times the factor of the year's events; orders are put into that year."""
    moved = F.make_date(F.lit(2024), F.month("o_orderdate"), F.least(F.dayofmonth("o_orderdate"), F.lit(28)))
    dated = _table(spark, sf_dir, "orders").select("o_orderkey", moved.alias("d"))
    matched = windows.with_listed_events(dated, "d", windows.EVENTS_2024)
    return matched.select("o_orderkey", F.round(scores.calendar_factor("d", F.col("event_factor")), 6).alias("factor"))


@_bind("""
SELECT event_id,
       CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' THEN 'launch'
            WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-15' THEN 'outage'
            WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-25' AND DATE '2024-01-25' THEN 'one day' END AS event,
       CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' THEN CAST(1.12 AS DOUBLE)
            WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-15' THEN CAST(0.75 AS DOUBLE)
            WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-25' AND DATE '2024-01-25' THEN CAST(1.08 AS DOUBLE)
            ELSE CAST(1 AS DOUBLE) END AS event_factor
FROM events
""")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = [
        windows.EventWindow("launch", dt.date(2024, 1, 5), dt.date(2024, 1, 10), 1.12),
        windows.EventWindow("outage", dt.date(2024, 1, 9), dt.date(2024, 1, 15), 0.75),
        windows.EventWindow("one day", dt.date(2024, 1, 25), dt.date(2024, 1, 25), 1.08),
    ]
    return windows.with_listed_events(_table(spark, sf_dir, "events").select("event_id", "ts"), "ts", listed).drop("ts")


@_bind("""
WITH w AS (
  SELECT o_orderkey AS priority, o_orderpriority AS event, CAST(o_orderdate AS DATE) AS first_day,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 - 1 AS INTEGER) AS last_day, o_totalprice / 400000 AS factor
  FROM orders),
winner AS (
  SELECT d.day, arg_min(w.event, w.priority) AS event, arg_min(w.factor, w.priority) AS factor
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem) d
  JOIN w ON d.day BETWEEN w.first_day AND w.last_day GROUP BY 1)
SELECT event, count(*) AS items, round(sum(l_extendedprice), 2) AS revenue,
       round(min(coalesce(factor, 1)), 6) AS lowest_factor, round(max(coalesce(factor, 1)), 6) AS highest_factor
FROM lineitem LEFT JOIN winner ON CAST(l_shipdate AS DATE) = winner.day
GROUP BY 1
""")
def event_window_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows in a table: none to five days from each order on, overlaps won by the lower order key."""
    length = (F.col("o_orderkey") % 6 - 1).cast("int")
    opened = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("priority"), F.col("o_orderpriority").alias("event"),
        cal.day("o_orderdate").alias("start"), F.date_add(cal.day("o_orderdate"), length).alias("end"),
        (F.col("o_totalprice") / 400000).alias("factor"),
    )
    items = _table(spark, sf_dir, "lineitem").select("l_shipdate", "l_extendedprice")
    return windows.with_event_table(items, "l_shipdate", opened, "priority").groupBy("event").agg(
        F.count(F.lit(1)).alias("items"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.round(F.min("event_factor"), 6).alias("lowest_factor"),
        F.round(F.max("event_factor"), 6).alias("highest_factor"),
    )


@_bind("""
WITH t AS (
  SELECT CASE WHEN c_acctbal >= 8000 THEN 'Excellent' WHEN c_acctbal >= 5000 THEN 'Good'
              WHEN c_acctbal >= 2000 THEN 'Average' ELSE 'Needs Improvement' END AS performance_tier
  FROM customer)
SELECT performance_tier, count(*) AS "count",
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM t) * 100, 1) AS percentage
FROM t GROUP BY 1 ORDER BY 2 DESC, 1
""")
def tier_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = ((8000, "Excellent"), (5000, "Good"), (2000, "Average"))
    tiered = _table(spark, sf_dir, "customer").select(scores.tier("c_acctbal", levels).alias("performance_tier"))
    return stats.share_of_total(tiered, "performance_tier")


@_bind("""
SELECT l_orderkey, l_linenumber, round(
    greatest(5, least(45, l_quantity)) * CAST(0.3 AS DOUBLE)
  + CAST(trunc(l_extendedprice / 1000) AS INTEGER) * CAST(0.3 AS DOUBLE)
  + (8 - l_linenumber) * CAST(12.5 AS DOUBLE) * CAST(0.2 AS DOUBLE)
  + l_tax * 100 * CAST(0.2 AS DOUBLE), 4) AS score
FROM lineitem
""")
def composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = [
        (scores.clamp("l_quantity", 5.0, 45.0), 0.3),
        (scores.truncate(F.col("l_extendedprice") / 1000), 0.3),
        ((F.lit(8) - F.col("l_linenumber")) * F.lit(12.5), 0.2),
        (F.col("l_tax") * 100, 0.2),
    ]
    score = scores.round_away(scores.weighted_sum(terms), 4)
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", score.alias("score"))


@_bind("""
SELECT p_partkey, round(p_partkey * CAST(0.125 AS DOUBLE), 2) AS away,
       round_even(p_partkey * CAST(0.125 AS DOUBLE), 2) AS even FROM part
""")
def rounding_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighths are exact in binary, so every second odd one is a true tie at two decimals."""
    eighths = F.col("p_partkey") * F.lit(0.125)
    return _table(spark, sf_dir, "part").select(
        "p_partkey", scores.round_away(eighths, 2).alias("away"), scores.round_even(eighths, 2).alias("even")
    )


# --- statistics -------------------------------------------------------------------------------------


@_bind("""
SELECT count(*) AS total_records, CAST(min(o_orderdate) AS DATE) AS first_date,
       CAST(max(o_orderdate) AS DATE) AS last_date, round(avg(o_totalprice), 1) AS avg_o_totalprice,
       round(avg(o_custkey), 1) AS avg_o_custkey, count(DISTINCT o_orderpriority) AS tiers
FROM orders
""")
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return stats.load_summary(orders, "o_orderdate", ["o_totalprice", "o_custkey"], "o_orderpriority")


@_bind("""
SELECT metric, round(min(value), 1) AS "min", round(max(value), 1) AS "max", round(avg(value), 1) AS avg,
       round(stddev_samp(value), 1) AS std
FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME metric VALUE value)
GROUP BY 1
""")
def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.metric_summary(
        _table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )


@_bind("""
WITH m AS (
  SELECT avg(o_totalprice) FILTER (isodow(o_orderdate) >= 6) AS a,
         avg(o_totalprice) FILTER (isodow(o_orderdate) < 6) AS b FROM orders)
SELECT round(a, 2) AS flagged_avg, round(b, 2) AS other_avg, round((a / b - 1) * 100, 4) AS difference_pct FROM m
""")
def segment_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = stats.compare_segments(
        _table(spark, sf_dir, "orders"), cal.weekend_flag("o_orderdate"), "o_totalprice"
    )
    return _rounded(_rounded(_rounded(sides, "flagged_avg"), "other_avg"), "difference_pct", 4)


@_bind("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def sample_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return stats.head(orders, 5, ["o_orderkey"])


# --- cleaning -----------------------------------------------------------------------------------------


@_bind("""
SELECT CAST(ts AS DATE) AS date, CAST(trunc(coalesce(nullif(value, 6.55), 0)) AS INTEGER) AS score,
       coalesce(nullif(event_type, 'error'), 'none') AS kind, CAST(0 AS DOUBLE) AS response_rate,
       'Unknown' AS quarter, user_id
FROM events
""")
def prepare_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _table(spark, sf_dir, "events").select(
        F.col("ts").alias("date"), F.nullif("value", F.lit(6.55)).alias("score"),
        F.nullif("event_type", F.lit("error")).alias("kind"), "user_id",
    )
    filled = clean.fill_defaults(raw, {"score": 0, "kind": "none", "not_there": 1})
    typed = clean.to_whole(clean.to_day(filled, ["date"]), ["score"])
    complete = clean.add_missing(typed, {"response_rate": (0, "double"), "quarter": ("Unknown", "string")})
    return clean.select_in_order(complete, ["date", "score", "kind", "response_rate", "quarter", "user_id"])


# One raw survey row per order date, made from whole numbers only.
_SURVEY_SQL = """
raw AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(sum(o_custkey) % 101 AS INTEGER) AS nps,
         CAST(sum(o_orderkey) % 101 AS INTEGER) AS csat, CAST(1 + count(*) % 7 AS INTEGER) AS ces,
         30 + CAST(sum(o_custkey) % 66 AS INTEGER) AS rate, CAST(count(*) AS INTEGER) AS n
  FROM orders GROUP BY 1),
scored AS (
  SELECT *, round_even(coalesce(nullif(nps, 0), 0) * CAST(0.3 AS DOUBLE) + csat * CAST(0.3 AS DOUBLE)
    + (8 - ces) * CAST(12.5 AS DOUBLE) * CAST(0.2 AS DOUBLE) + rate * CAST(0.2 AS DOUBLE), 1) AS score FROM raw),
prepared AS (
  SELECT date, nps AS nps_score, csat AS csat_score, CAST(ces AS DECIMAL(3, 2)) AS ces_score,
         CAST(rate AS DECIMAL(5, 2)) AS response_rate, n AS responses_count,
         CAST(score AS DECIMAL(5, 2)) AS cx_composite_score, CAST(0 AS DECIMAL(3, 2)) AS value_score,
         'Unknown' AS day_of_week, CAST(week(date) AS INTEGER) AS week_number, 0 AS is_weekend,
         CASE WHEN score >= 80 THEN 'Excellent' WHEN score >= 75 THEN 'Good' WHEN score >= 70 THEN 'Average'
              ELSE 'Needs Improvement' END AS performance_tier
  FROM scored)
"""
_SURVEY_COLUMNS = [
    "date", "nps_score", "csat_score", "ces_score", "response_rate", "responses_count", "cx_composite_score",
    "value_score", "day_of_week", "week_number", "is_weekend", "performance_tier",
]


def _raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _table(spark, sf_dir, "orders").groupBy(cal.day("o_orderdate").alias("date")).agg(
        F.sum("o_custkey").alias("c"), F.sum("o_orderkey").alias("k"), F.count(F.lit(1)).alias("n")
    )
    return daily.select(
        "date", F.nullif((F.col("c") % 101).cast("double"), F.lit(0.0)).alias("nps_score"),
        (F.col("k") % 101).cast("double").alias("csat_score"), (F.col("n") % 7 + 1).cast("double").alias("ces_score"),
        (F.col("c") % 66 + 30).cast("double").alias("response_rate"),
        F.col("n").cast("double").alias("responses_count"),
    )


@_bind(f"WITH {_SURVEY_SQL} SELECT * FROM prepared")
def survey_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw survey rows without score, tier and calendar columns, made ready for the typed table."""
    ready = clean.conform(load.prepare(_raw_survey(spark, sf_dir)), load.SURVEY_TABLE)
    return ready.select(*_SURVEY_COLUMNS)


@_bind(f"""
WITH {_SURVEY_SQL}
SELECT row_number() OVER (ORDER BY date) AS id, *, TIMESTAMP '2024-01-01 06:00:00' AS created_at,
       TIMESTAMP '2024-01-02 06:00:00' AS updated_at
FROM prepared
""")
def load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job twice: CSV, clean, conform, upsert; the second load updates every row."""
    source, target = new_folder(spark, "survey-csv"), new_folder(spark, "survey-table")
    csv.write_csv(_raw_survey(spark, sf_dir), source)
    load.load(spark, source, target, dt.datetime(2024, 1, 1, 6))
    load.load(spark, source, target, dt.datetime(2024, 1, 2, 6))
    return tables.read_table(spark, target).select("id", *_SURVEY_COLUMNS, "created_at", "updated_at")


@_bind(f"""
WITH {_SURVEY_SQL}
SELECT performance_tier, count(*) AS "count",
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM prepared) * 100, 1) AS percentage
FROM prepared GROUP BY 1
""")
def load_job_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distribution a load reports."""
    raw = _raw_survey(spark, sf_dir).withColumn("seq", F.lit(1))
    return load.load_frame(raw, new_folder(spark, "survey-table"), dt.datetime(2024, 1, 1), "seq").tiers


@_bind("""
SELECT c_custkey, TRY_CAST(c_acctbal AS DECIMAL(5, 2)) AS balance,
       CASE WHEN TRY_CAST(c_acctbal AS DECIMAL(5, 2)) IS NULL THEN 'rejected' ELSE 'loaded' END AS outcome
FROM customer
""")
def decimal_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    balances = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    good, wrong = clean.conform_or_reject(balances, {"balance": T.DecimalType(5, 2)})
    return good.withColumn("outcome", F.lit("loaded")).unionByName(
        wrong.select("c_custkey", F.lit(None).cast("decimal(5,2)").alias("balance"), F.lit("rejected").alias("outcome"))
    )


@_bind("""
SELECT nullif(user_id, 8) AS user_id,
       CASE WHEN nullif(user_id, 8) IS NULL THEN 'null key' ELSE 'duplicate key' END AS violation,
       count(*) AS "rows"
FROM events GROUP BY 1 HAVING count(*) > 1 OR nullif(user_id, 8) IS NULL
""")
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _table(spark, sf_dir, "events").select(F.nullif("user_id", F.lit(8)).alias("user_id"))
    return clean.key_violations(keyed, "user_id")


# --- upsert -------------------------------------------------------------------------------------------

_SPLIT = dt.datetime(2024, 1, 11)
_USERS_SQL = """
latest AS (
  SELECT user_id * 24 + hour(ts) AS user_id, event_id, event_type, value, ts < TIMESTAMP '2024-01-11' AS early,
         row_number() OVER (PARTITION BY user_id, hour(ts), ts < TIMESTAMP '2024-01-11' ORDER BY event_id DESC) AS nth
  FROM events),
target AS (SELECT user_id, event_id, event_type, value FROM latest WHERE early AND nth = 1),
batch AS (
  SELECT user_id, event_id, nullif(event_type, 'click') AS event_type, value FROM latest WHERE NOT early AND nth = 1)
"""


def _users(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Last event per user and hour of the day, before and after a day; some keys are on one side only."""
    events = _table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id") * 24 + F.hour("ts"))
    columns = ["user_id", "event_id", "event_type", "value"]
    early = upsert.last_rows(events.where(F.col("ts") < F.lit(_SPLIT)), ["user_id"], ["event_id"])
    late = upsert.last_rows(events.where(F.col("ts") >= F.lit(_SPLIT)), ["user_id"], ["event_id"])
    late = late.withColumn("event_type", F.nullif("event_type", F.lit("click")))
    return early.select(*columns), late.select(*columns)


@_bind("""
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
""")
def last_row_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return upsert.last_rows(events, ["user_id"], ["event_id"])


@_bind(f"""
WITH {_USERS_SQL}
SELECT coalesce(b.user_id, t.user_id) AS user_id,
       CASE WHEN b.user_id IS NOT NULL THEN b.event_id ELSE t.event_id END AS event_id,
       CASE WHEN b.user_id IS NOT NULL THEN b.event_type ELSE t.event_type END AS event_type,
       CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE t.value END AS value,
       CASE WHEN t.user_id IS NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-11' END AS created_at,
       CASE WHEN b.user_id IS NULL THEN TIMESTAMP '2024-01-11' ELSE TIMESTAMP '2024-02-01' END AS updated_at,
       CASE WHEN b.user_id IS NULL THEN 'kept' WHEN t.user_id IS NULL THEN 'inserted' ELSE 'updated' END AS status
FROM target t FULL JOIN batch b ON t.user_id = b.user_id
""")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _users(spark, sf_dir)
    first = F.lit(_SPLIT).cast("timestamp_ntz")
    stamped = target.withColumns({"created_at": first, "updated_at": first})
    return upsert.merge_rows(stamped, batch, ["user_id"], dt.datetime(2024, 2, 1))


@_bind(f"""
WITH {_USERS_SQL}, m AS (SELECT t.user_id AS t, b.user_id AS b FROM target t FULL JOIN batch b ON t.user_id = b.user_id)
SELECT count(*) FILTER (t IS NULL) AS inserted, count(*) FILTER (t IS NOT NULL AND b IS NOT NULL) AS updated,
       count(*) FILTER (b IS NULL) AS kept, count(b) AS processed_records, count(*) AS total_records
FROM m
""")
def upsert_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _users(spark, sf_dir)
    return upsert.merge_report(upsert.merge_rows(target, batch, ["user_id"]))


@_bind("""
WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders
           WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1),
b AS (SELECT CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_orderstatus) AS orders FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-06-15' GROUP BY 1),
ids AS (
  SELECT day, row_number() OVER (ORDER BY day) AS id FROM a
  UNION ALL
  SELECT day, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY day) FROM b WHERE day NOT IN (SELECT day FROM a))
SELECT day, coalesce(b.orders, a.orders) AS orders, id,
       CASE WHEN a.day IS NULL THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS created_at,
       CASE WHEN b.day IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS updated_at
FROM a FULL JOIN b USING (day) JOIN ids USING (day)
""")
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches written into a table by month: shared days are replaced, ids are kept."""
    path = new_folder(spark, "daily-orders")
    orders = _table(spark, sf_dir, "orders").withColumn("day", cal.day("o_orderdate"))
    early = orders.where(F.col("day") < F.lit(dt.date(1999, 1, 1)))
    late = orders.where(F.col("day") >= F.lit(dt.date(1998, 6, 15)))
    counted, states = F.count(F.lit(1)), F.countDistinct("o_orderstatus")
    for moment, rows, figure in ((dt.datetime(2024, 1, 1), early, counted), (dt.datetime(2024, 1, 2), late, states)):
        batch = rows.groupBy("day").agg(figure.alias("orders"))
        upsert.upsert_table(spark, path, batch, ["day"], ["orders"], moment)
    return tables.read_table(spark, path)


@_bind("""
SELECT p_name, p_partkey, 5000000 + row_number() OVER (ORDER BY p_name, p_partkey) AS id FROM part
""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").select("p_name", "p_partkey")
    return upsert.assign_ids(parts, ["p_name", "p_partkey"], highest=5000000)


@_bind("""
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS rank FROM orders
""")
def group_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return ranking.rank_in_groups(orders, ["o_custkey"], ["o_orderkey"])


# --- sources and sinks --------------------------------------------------------------------------------


@_bind("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    path = new_folder(spark, "customer-csv")
    csv.write_csv(customer, path)
    return csv.read_csv(spark, path, customer.schema)


@_bind("""
SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(l_discount AS DECIMAL(3, 2)) AS discount
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-02-10' AND l_shipdate < TIMESTAMP '1998-03-05'
""")
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "lineitem-table")
    schema = T.StructType([
        T.StructField("day", T.DateType()), T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()), T.StructField("quantity", T.IntegerType()),
        T.StructField("discount", T.DecimalType(3, 2)),
    ])
    items = _table(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_shipdate": "day", "l_quantity": "quantity", "l_discount": "discount"}
    )
    tables.create_table(items, path, schema, ["day"])
    return tables.read_table(spark, path, "day", dt.date(1996, 2, 10), dt.date(1998, 3, 5))


@_bind("""
SELECT CAST(to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_size': p_size,
                     'p_type': nullif(p_type, 'ECONOMY')}) AS VARCHAR) AS row
FROM part
""")
def json_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").withColumn("p_type", F.nullif("p_type", F.lit("ECONOMY")))
    return json_rows.to_json_rows(part.select("p_partkey", "p_name", "p_size", "p_type"))


# --- matching -----------------------------------------------------------------------------------------


def _orders_1995(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = (dt.datetime(1995, 1, 1), dt.datetime(1996, 1, 1))
    return charts.in_time_range(_table(spark, sf_dir, "orders"), "o_orderdate", span)


@_bind("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01')
""")
def new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return reconcile.new_rows(customer, _orders_1995(spark, sf_dir), "c_custkey", "o_custkey")


@_bind("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01')
""")
def present_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return reconcile.present_rows(customer, _orders_1995(spark, sf_dir), "c_custkey", "o_custkey")


@_bind("SELECT p_partkey, p_name FROM part WHERE p_name = 'red widget' ORDER BY p_partkey LIMIT 1")
def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return reconcile.first_match(part, "p_name", "red widget", ["p_partkey"])


@_bind("""
SELECT l.l_orderkey, l.l_partkey, p.p_name, m.first_partkey
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN (SELECT p_name, min(p_partkey) AS first_partkey FROM part GROUP BY 1) m ON m.p_name = p.p_name
""")
def first_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first part of the same name for the part of every line item."""
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    items = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    named = items.join(part, items.l_partkey == part.p_partkey).drop("p_partkey")
    catalogue = part.select("p_name", F.col("p_partkey").alias("first_partkey"), F.col("p_partkey").alias("place"))
    return reconcile.lookup_first(named, catalogue, "p_name", "first_partkey", "place")


@_bind("""
WITH o AS (SELECT *, o_custkey * 8 + isodow(o_orderdate) AS custkey FROM orders),
known AS (SELECT custkey, max(o_orderkey) AS existing_id FROM o WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT o_orderkey, custkey, existing_id, CASE WHEN existing_id IS NULL THEN 'create' ELSE 'update' END AS action
FROM o LEFT JOIN known USING (custkey) WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def create_or_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by weekday: some are known from before 1998, some are new."""
    named = F.col("o_custkey") * 8 + F.weekday("o_orderdate") + 1
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", named.alias("custkey"), "o_orderdate")
    incoming = orders.where(F.col("o_orderdate") >= F.lit(dt.datetime(1998, 1, 1))).drop("o_orderdate")
    existing = orders.where(F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1)))
    return reconcile.classify(incoming, existing, "custkey", "o_orderkey")


@_bind("""
WITH o AS (SELECT *, o_custkey * 8 + isodow(o_orderdate) AS custkey FROM orders),
known AS (
  SELECT custkey, max(o_orderkey) AS existing_id, arg_max(o_orderpriority, o_orderkey) AS dataset FROM o
  WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT o_orderkey, custkey, existing_id, CASE WHEN existing_id IS NULL THEN 'create' ELSE 'update' END AS action
FROM o LEFT JOIN (FROM known WHERE dataset = '2-HIGH') USING (custkey) WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def create_or_update_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but only names whose last row is of one dataset are known."""
    named = F.col("o_custkey") * 8 + F.weekday("o_orderdate") + 1
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", named.alias("custkey"), "o_orderdate", "o_orderpriority")
    split = F.lit(dt.datetime(1998, 1, 1))
    incoming = orders.where(F.col("o_orderdate") >= split).select("o_orderkey", "custkey")
    return reconcile.classify(
        incoming, orders.where(F.col("o_orderdate") < split), "custkey", "o_orderkey", within=("o_orderpriority", "2-HIGH")
    )


@_bind("""
SELECT l_orderkey, string_agg('"CHART-' || l_linenumber || '":{"meta":{"chartId":' || l_partkey || '},"type":"CHART"},', ''
         ORDER BY l_linenumber) FILTER (WHERE l_partkey % 7 <> 0) AS charts, count(*) AS before
FROM (SELECT DISTINCT l_orderkey, l_linenumber, max(l_partkey) OVER (PARTITION BY l_orderkey, l_linenumber) AS l_partkey FROM lineitem)
GROUP BY 1
""")
def removed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position maps made from the lines of each order, without every seventh part."""
    maps = _position_maps(spark, sf_dir)
    return _entries(maps.withColumn("position", reconcile.without_members("position", lambda part: part % 7 == 0)))


def _position_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(
        F.concat(F.lit("CHART-"), F.col("l_linenumber").cast("string")).alias("key"),
        F.struct(F.struct(F.col("l_partkey").alias("chartId")).alias("meta"), F.lit("CHART").alias("type")).alias("value"),
    )
    lines = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("l_partkey"))
    return lines.groupBy("l_orderkey").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("position"), F.count(F.lit(1)).alias("before"))


def _entries(maps: DataFrame) -> DataFrame:
    """What is left of each map, as text that SQL can put together as well."""
    inside = F.regexp_replace("position", r"^\{|\}$", "")
    return maps.select("l_orderkey", F.when(inside != "", F.concat(inside, F.lit(","))).alias("charts"), "before")


@_bind("""
SELECT l_orderkey, string_agg('"CHART-' || l_linenumber || '":{"meta":{"chartId":' || l_partkey || '},"type":"CHART"},', ''
         ORDER BY l_linenumber) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 20)) AS charts, count(*) AS before
FROM (SELECT DISTINCT l_orderkey, l_linenumber, max(l_partkey) OVER (PARTITION BY l_orderkey, l_linenumber) AS l_partkey FROM lineitem)
GROUP BY 1
""")
def removed_listed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same maps without the parts that a table lists."""
    small = _table(spark, sf_dir, "part").where("p_size < 20").select("p_partkey")
    return _entries(reconcile.without_listed_members(_position_maps(spark, sf_dir), ["l_orderkey"], "position", small, "p_partkey"))


# --- text ---------------------------------------------------------------------------------------------

_SLUG = "regexp_replace(translate(lower({}), ' _', '--'), '[^a-z0-9-]', '', 'g')"


@_bind(f"SELECT p_partkey, {_SLUG.format("p_name || '_' || p_brand || ' (' || p_type || ')'")} AS slug FROM part")
def slugified(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat("p_name", F.lit("_"), "p_brand", F.lit(" ("), "p_type", F.lit(")"))
    return _table(spark, sf_dir, "part").select("p_partkey", text.slugify(title).alias("slug"))


@_bind(f"""
WITH named AS (
  SELECT p_partkey, p_brand, {_SLUG.format("p_name || CASE WHEN p_size % 25 = 0 THEN ' ' || (p_size // 25) ELSE '' END")} AS base FROM part),
taken AS (
  SELECT base AS slug FROM named WHERE p_brand = 'Brand#1'
  UNION SELECT base || '-2' FROM named WHERE p_brand = 'Brand#2'
  UNION SELECT base || '-3' FROM named WHERE p_brand = 'Brand#3'),
claimed AS (
  SELECT slug AS base, 0 AS n FROM taken UNION
  SELECT regexp_extract(slug, '^(.*)-([1-9][0-9]*)$', 1), CAST(regexp_extract(slug, '^(.*)-([1-9][0-9]*)$', 2) AS BIGINT)
  FROM (SELECT slug FROM taken UNION SELECT base FROM named) WHERE regexp_matches(slug, '^(.*)-([1-9][0-9]*)$')),
candidate AS (SELECT base, unnest(range(0, count(*) + 8)) AS n FROM named GROUP BY base),
free AS (
  SELECT base, n, row_number() OVER (PARTITION BY base ORDER BY n) AS k
  FROM candidate ANTI JOIN claimed USING (base, n)),
ranked AS (SELECT p_partkey, base, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS k FROM named)
SELECT p_partkey, base, CASE WHEN n = 0 THEN base ELSE base || '-' || n END AS slug
FROM ranked JOIN free USING (base, k)
""")
def unique_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some titles end in a number, and so spell a slug that another title would get."""
    numbered = F.when(F.col("p_size") % 25 == 0, F.concat(F.lit(" "), F.floor(F.col("p_size") / 25).cast("string"))).otherwise("")
    part = _table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", numbered).alias("p_name"), "p_brand")
    suffix = F.when(F.col("p_brand") == "Brand#1", "").when(F.col("p_brand") == "Brand#2", "-2").when(
        F.col("p_brand") == "Brand#3", "-3"
    )
    taken = part.select(F.concat(text.slugify("p_name"), suffix).alias("slug")).where("slug IS NOT NULL").distinct()
    return slugs.unique_slugs(part, "p_name", ["p_partkey"], taken)


@_bind("""
WITH e AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)
SELECT event_id,
       CASE WHEN event_type = 'click' THEN user_id WHEN value > 10 THEN k END AS id,
       CASE WHEN event_type IN ('click', 'view') THEN user_id WHEN value > 10 THEN k END AS nested_id,
       CASE WHEN event_type = 'view' THEN 'query' ELSE 'table' END AS source_type
FROM e
""")
def json_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart JSON made from events: marked text, a nested object, no source, malformed text, no id."""
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    params = (
        F.when(kind == "click", F.concat(F.lit('{"datasource": "'), user, F.lit('__table"}')))
        .when(kind == "view", F.concat(F.lit('{"datasource": {"id": '), user, F.lit(', "type": "query"}}')))
        .when(kind == "error", F.lit('{"datasource": "1__table"'))
        .when(kind == "signup", F.lit('{"datasource": "x__table"}'))
        .otherwise(F.col("props"))
    )
    context = F.when(
        F.col("value") > 10,
        F.concat(F.lit('{"datasource": {"type": "table", "id": '), F.get_json_object("props", "$.k"), F.lit("}}")),
    ).otherwise(F.lit("{}"))
    made = _table(spark, sf_dir, "events").select("event_id", params.alias("p"), context.alias("q"))
    plain = datasets.with_dataset_id(made, "p", "q", id_column="id")
    full = datasets.with_dataset_id(plain, "p", "q", True, "nested_id", "source_type")
    return full.select("event_id", "id", "nested_id", "source_type")


# --- driver contract ----------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: a metric by weekday."""
    return series_weekday(spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data subpackage and its pipeline, if they are installed."""
    try:
        import corpus_pipeline
        from tallyboard.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "tallyboard.llm"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, {**llm.SQL, **sql}


def base_queries() -> dict[str, Query]:
    """The reference's own operators."""
    return dict(_QUERIES)


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, sql in _SQL.items()} | _training_data()[1]
