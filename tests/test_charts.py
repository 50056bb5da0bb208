import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyboard.plans import charts, metrics
from tallyboard.plans.charts import ChartSpec, Dataset, chart

D = dt.date
ROWS = [
    (1, D(2024, 1, 1), 40, "Good", 1.0), (2, D(2024, 1, 1), 60, "Good", 2.0), (3, D(2024, 1, 2), 30, "Bad", None),
    (4, D(2024, 2, 5), 10, None, 4.0), (5, None, 5, "Good", 5.0),
]


@pytest.fixture(scope="module")
def data(spark):
    return Dataset(spark.createDataFrame(ROWS, "id int, date date, nps_score int, tier string, value double"))


def rows(df):
    return [tuple(r) for r in df.collect()]


def line(**kw):
    return {"name": "n", "viz_type": "line", **kw}


def test_select_column():
    cols = ["id", "date", "nps_score", "paid", "tier", "responses_count"]
    assert charts.select_column(cols, "date") == "date"
    assert charts.select_column(cols, "category") == "date"
    assert charts.select_column(cols[2:], "category") == "nps_score"
    assert charts.select_column(["paid", "ACCOUNT"], "category") is None
    assert charts.select_column(cols, "numeric") == "nps_score"
    assert charts.select_column(cols, "other") is None


@pytest.mark.parametrize("spec, label", [
    ("avg( nps_score )", "AVG(nps_score)"), ("COUNT(*)", "COUNT(*)"), ("sum(*)", "COUNT(*)"),
    ("Sum(abs(nps_score))", "SUM(abs(nps_score))"), ("SUM(value) / COUNT(*)", "SUM(value) / COUNT(*)"),
    ({"sqlExpression": "AVG(nps_score)", "label": "Average NPS"}, "Average NPS"),
    ({"aggregate": "COUNT", "column": None, "label": None}, "COUNT(*)"),
    ({"aggregate": "max", "column": {"column_name": "value"}}, "MAX(value)"), ("count", "count"),
])
def test_metric_labels(data, spec, label):
    assert metrics.resolve(spec).label == label
    assert data.df.agg(metrics.resolve(spec).aliased()).columns == [label]


def test_bare_names():
    assert metrics.resolve("x", metrics.AVERAGE).label == "AVG(x)"
    assert metrics.resolve("x", metrics.TOTAL).label == "SUM(x)"
    with pytest.raises(metrics.MetricError, match="known: count"):
        metrics.resolve("x")
    with pytest.raises(metrics.MetricError):
        metrics.resolve({"label": "nothing"})


def test_four_spellings_of_count(data):
    named = {"count_all_records": "COUNT(*)"}
    spellings = [
        "count_all_records", "COUNT(*)", {"aggregate": "COUNT", "column": None, "expressionType": "SIMPLE"},
        {"expressionType": "SQL", "sqlExpression": "COUNT(*)", "label": "COUNT(*)"},
    ]
    got = data.df.agg(*[metrics.resolve(s, named=named).aliased(str(i)) for i, s in enumerate(spellings)])
    assert rows(got) == [(5, 5, 5, 5)]
    assert rows(data.df.where("false").agg(metrics.resolve("count").aliased())) == [(0,)]


def test_big_number(data):
    assert rows(chart(data, {"name": "n", "viz_type": "big_number_total"})) == [(5,)]
    jan = ChartSpec("n", "big_number_total", "SUM(nps_score)", time_range=(D(2024, 1, 1), D(2024, 1, 2)))
    assert rows(chart(data, jan)) == [(100,)]
    since = ChartSpec("n", "big_number_total", time_range=(D(2024, 1, 2), None))
    assert rows(chart(data, since)) == [(2,)]


def test_line_on_a_date_column_groups_by_it(data):
    got = chart(data, line(metric="nps_score"))
    assert got.columns == ["date", "AVG(nps_score)"]
    assert rows(got) == [(D(2024, 1, 1), 50.0), (D(2024, 1, 2), 30.0), (D(2024, 2, 5), 10.0), (None, 5.0)]


def test_line_by_day_weekday_month(data):
    daily = Dataset(data.df.withColumnRenamed("date", "made_time"))
    assert chart(daily, line(metric="COUNT(*)")).columns == ["day", "COUNT(*)"]
    assert rows(chart(daily, line(metric="COUNT(*)", custom_params={"row_limit": 1}))) == [(D(2024, 1, 1), 2)]
    assert rows(chart(data, line(metric="COUNT(*)", x_axis="day_of_week"))) == [
        ("Monday   ", 3), ("Tuesday  ", 1), (None, 1)
    ]
    assert rows(chart(data, line(metric="COUNT(*)", x_axis="month", custom_params={"trim": True}))) == [
        ("February", 1), ("January", 3), (None, 1)
    ]


def test_keyword_axis_wins_over_a_column(data):
    named = Dataset(data.df.withColumnRenamed("tier", "month"))
    assert chart(named, line(metric="COUNT(*)", x_axis="month")).columns == ["Month", "COUNT(*)"]


def test_metric_object_in_a_line_chart(data):
    spec = line(metric={"sqlExpression": "MAX(nps_score)", "label": "top"}, x_axis="tier")
    assert rows(chart(data, spec)) == [("Bad", 30), ("Good", 60), (None, 10)]


def test_bar_is_a_daily_sum(data):
    spec = {"name": "n", "viz_type": "dist_bar", "groupby_type": "category"}
    assert rows(chart(data, spec)) == [
        (D(2024, 1, 1), 100), (D(2024, 1, 2), 30), (D(2024, 2, 5), 10), (None, 5)
    ]
    with pytest.raises(AnalysisException):
        chart(data, {**spec, "metric": "count"})


def test_bubble(data):
    spec = {"name": "n", "viz_type": "bubble", "custom_params": {"series": "tier", "row_limit": 2}}
    assert rows(chart(data, spec)) == [(5, "Good", 1), (10, None, 1)]
    assert chart(data, {"name": "n", "viz_type": "bubble"}).columns == ["nps_score", "date", "count"]


def test_generic(data):
    spec = ChartSpec("n", "pie", ["COUNT(*)", "MAX(value)"], params={"groupby": ["tier"]})
    assert set(rows(chart(data, spec))) == {("Good", 3, 5.0), ("Bad", 1, None), (None, 1, 4.0)}
    assert chart(data, ChartSpec("n", "pie", groupby_type="date")).columns == ["date", "count"]
    assert rows(chart(data, ChartSpec("n", "pie"))) == [(5,)]


def test_where_and_having(data):
    spec = ChartSpec("n", "pie", params={"groupby": ["tier"]}, where="nps_score > 5", having="count > 1")
    assert rows(chart(data, spec)) == [("Good", 2)]


def test_no_date_column(spark):
    plain = Dataset(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(charts.ChartError, match="no date column"):
        chart(plain, line(metric="COUNT(*)"))


def test_batch_keeps_good_charts(data):
    specs = [
        {"name": "total", "viz_type": "big_number_total"},
        {"name": "last", "viz_type": "big_number_total", "metric": "MAX(date)"},
        line(name="a", metric="COUNT(*)", x_axis="tier"), line(name="b", metric="nps_score", x_axis="tier"),
        line(name="c", metric="COUNT(*)", x_axis="tier", custom_params={"row_limit": 1}),
        {"name": "no type"}, line(name="bad column", metric="nope"), line(name="bad function", metric="NOPE(value)"),
        {"name": "bad name", "viz_type": "pie", "metric": "nope"}, ChartSpec("bad filter", "pie", where="((("),
    ]
    long, rejected = charts.chart_batch(data, specs)
    assert [r.name for r in rejected] == ["no type", "bad column", "bad function", "bad name", "bad filter"]
    got = sorted(rows(long), key=str)
    assert got == sorted([
        ("total", None, "count", 5.0, "5"), ("last", None, "MAX(date)", None, "2024-02-05"),
        ("a", "Bad", "COUNT(*)", 1.0, "1"), ("a", "Good", "COUNT(*)", 3.0, "3"), ("a", None, "COUNT(*)", 1.0, "1"),
        ("b", "Bad", "AVG(nps_score)", 30.0, None), ("b", "Good", "AVG(nps_score)", 35.0, None),
        ("b", None, "AVG(nps_score)", 10.0, None), ("c", "Bad", "COUNT(*)", 1.0, "1"),
    ], key=str)
    # One exchange to aggregate all keys, one to rank; the third row is that of an empty table.
    plan = long._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange SinglePartition") == 1
    assert charts.chart_batch(data, [{"name": "x"}])[0] is None


def test_keys_of_one_name_are_not_mixed(spark):
    """A real column called day, the day of a date, and derived names beside columns of that name."""
    df = spark.createDataFrame(
        [("early", dt.date(2024, 1, 1), "x", 1), ("late", dt.date(2024, 1, 1), "x", 2), ("early", dt.date(2024, 1, 2), "y", 4)],
        "day string, date date, Month string, v int",
    )
    daily = {"name": "daily", "viz_type": "bar", "metric": "v"}
    by_shift = {"name": "by shift", "viz_type": "line", "metric": "SUM(v)", "x_axis": "day"}
    column = {"name": "column", "viz_type": "line", "metric": "SUM(v)", "x_axis": "Month"}
    derived = {"name": "derived", "viz_type": "line", "metric": "SUM(v)", "x_axis": "month"}
    want = {
        ("daily", "2024-01-01", "3"), ("daily", "2024-01-02", "4"), ("by shift", "early", "5"), ("by shift", "late", "2"),
        ("column", "x", "3"), ("column", "y", "4"), ("derived", "January  ", "7"),
    }
    for specs in ([daily, by_shift, column, derived], [derived, column, by_shift, daily]):
        long, rejected = charts.chart_batch(Dataset(df), specs)
        assert rejected == [] and {(r.chart, r.x, r.text) for r in long.collect()} == want


def test_batch_keeps_digits_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", None, 9007199254740993, Decimal("0.12345678901234567890")), (None, "a", 1, Decimal("1")), ("a | b", "c", 1, None), ("a", "b | c", 1, None)],
        "p string, q string, v bigint, d decimal(30,20)",
    )
    spec = {"name": "both", "viz_type": "table", "metric": ["SUM(v)", "MAX(d)"], "custom_params": {"groupby": ["p", "q"]}}
    long, _ = charts.chart_batch(Dataset(df), [spec, {**spec, "name": "again", "metric": "SUM(v)"}])
    got = {(r.chart, r.x, r.metric): r.text for r in long.collect()}
    assert got["both", '["a",null]', "SUM(v)"] == "9007199254740993"
    assert got["both", '["a",null]', "MAX(d)"] == "0.12345678901234567890"
    assert len({x for c, x, _ in got if c == "again"}) == 4


def test_bad_specs_are_rejected_one_by_one(data):
    bad = [
        line(name="number", metric=5), line(name="range", time_range=["2024"]), line(name="range text", time_range="soon"),
        {"name": "labels", "viz_type": "table", "metric": ["COUNT(*)", "count(*)"]},
        {"name": "key", "viz_type": "table", "metric": [{"sqlExpression": "COUNT(*)", "label": "tier"}], "custom_params": {"groupby": ["tier"]}},
        {"name": "params", "viz_type": "bar", "custom_params": [1]}, {"name": 7, "viz_type": "bar"}, "text",
        line(name="limit", custom_params={"row_limit": "many"}), line(name="filter", filters=[{"col": "nope", "op": "==", "val": 1}]),
        line(name="operator", filters=[{"col": "tier", "op": "~", "val": 1}]), line(name="order", order_desc="yes"),
    ]
    good = line(name="good", metric="COUNT(*)", x_axis="tier", time_range="No filter")
    long, rejected = charts.chart_batch(data, [*bad[:6], good, *bad[6:]])
    assert len(rejected) == len(bad) and all(r.reason for r in rejected)
    assert {r.chart for r in long.collect()} == {"good"}


def test_order_and_limits(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(k), k % 3, 1) for k in range(40)], "date date, g int, v int")
    data = Dataset(df)
    bar = {"name": "b", "viz_type": "bar", "metric": "v", "custom_params": {"row_limit": 2}}
    assert [r.day.day for r in chart(data, {**bar, "order_desc": True}).collect()] == [9, 8]
    assert [r.day.day for r in chart(data, bar).collect()] == [1, 2]
    assert "Limit" not in plan(chart(data, {**bar, "custom_params": {"row_limit": None}}))
    table = {"name": "t", "viz_type": "table", "metric": "COUNT(*)", "custom_params": {"groupby": ["g"], "row_limit": 1}}
    assert [r.g for r in chart(data, table).collect()] == [0]
    assert [r.g for r in chart(data, {**table, "order_desc": False}).collect()] == [1]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_time_range_stays_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    times = [dt.datetime(2024, 1, 9, 22), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11, 23), dt.datetime(2024, 1, 12)]
    df = spark.createDataFrame([(t, t.date()) for t in times], "`my ts` timestamp_ntz, d date")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for bounds in ((dt.date(2024, 1, 10), dt.date(2024, 1, 12)), (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12)), "2024-01-10 : 2024-01-12"):
            assert charts.in_time_range(df, "my ts", bounds).count() == 2
            assert charts.in_time_range(df, "d", bounds).count() == 2
        assert charts.in_time_range(df, "d", "No filter").count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_filter_objects(data):
    def kept(*filters):
        return chart(data, {"name": "f", "viz_type": "big_number_total", "filters": list(filters)}).first()[0]

    every = kept()
    assert kept({"col": "date", "op": "TEMPORAL_RANGE", "val": "No filter"}) == every
    assert kept({"subject": "tier", "operator": "IS NULL"}) + kept({"col": "tier", "op": "IS NOT NULL"}) == every
    assert kept({"col": "tier", "op": "IN", "val": ["Good"]}) + kept({"col": "tier", "op": "NOT IN", "val": ["Good"]}) == kept({"col": "tier", "op": "IS NOT NULL"})
    assert kept({"col": "tier", "op": "LIKE", "val": "G%"}) == kept({"col": "tier", "op": "==", "val": "Good"})


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


BATCH = [
    {"name": "all", "viz_type": "big_number_total"},
    {"name": "some", "viz_type": "big_number_total", "metric": "COUNT(DISTINCT g)"},
    {"name": "days", "viz_type": "bar", "metric": "v"},
    {"name": "late", "viz_type": "bar", "metric": "v", "order_desc": True, "custom_params": {"row_limit": 3}},
    {"name": "groups", "viz_type": "line", "metric": "AVG(v)", "x_axis": "g"},
    {"name": "first", "viz_type": "bubble", "metric": "SUM(v)", "custom_params": {"x": "g", "y": "v", "series": "h", "row_limit": 4}},
    {"name": "last", "viz_type": "bubble", "metric": "COUNT(*)", "order_desc": False, "custom_params": {"x": "h", "y": "v", "series": "g", "row_limit": 5}},
    {"name": "table", "viz_type": "table", "custom_params": {"groupby": ["g"], "metrics": ["MAX(v)", "COUNT(DISTINCT h)"]}},
    {"name": "none", "viz_type": "line", "metric": "AVG(v)", "x_axis": "h", "custom_params": {"row_limit": 0}},
    {"name": "condition", "viz_type": "table", "metric": "COUNT(*)", "having": "`count(1)` > 20", "custom_params": {"groupby": ["g"]}},
]


@pytest.mark.parametrize(("rows", "early"), [(0, 10000), (1, 10000), (200, 10000), (200, 2)])
def test_batch_equals_its_charts(spark, rows, early):
    """Rows, groups with nulls, ties, limits in both orders, and no rows at all."""
    before = spark.conf.get(charts._EARLY_LIMIT)
    spark.conf.set(charts._EARLY_LIMIT, early)
    df = spark.range(rows).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("date"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), (F.col("id") % 3).alias("h"), (F.col("id") % 7).alias("v"),
    )
    specs = [s for s in BATCH if s["name"] != "condition"]
    long, rejected = charts.chart_batch(Dataset(df), specs)
    assert rejected == []
    want = [row for s in specs for row in plain(charts._alone(Dataset(df), ChartSpec.from_dict(s), charts.plan_query(Dataset(df), ChartSpec.from_dict(s))))]
    got = plain(long)
    spark.conf.set(charts._EARLY_LIMIT, before)
    assert got == sorted(want, key=repr)


def test_batch_reads_its_table_once(spark, tmp_path):
    spark.range(50).selectExpr("date_add(date'2024-01-01', cast(id % 9 as int)) date", "id % 5 g", "id % 3 h", "id % 7 v").write.parquet(f"{tmp_path}/t")
    data = Dataset(spark.read.parquet(f"{tmp_path}/t"))
    long, rejected = charts.chart_batch(data, [s for s in BATCH if not s.get("having")])
    assert rejected == []
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand [" in plan and "WindowGroupLimit" in plan
    # A limit beyond the setting is first taken from shares of a chart, so that no task gets all its groups.
    more = [*BATCH[:3], {**BATCH[3], "custom_params": {"row_limit": 20_000}}]
    plan = charts.chart_batch(data, more)[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number()") == 2 and re.search(r"pmod\(xxhash64", plan)
    # Two bubbles over the same keys: one aggregate.
    pair = [s for s in BATCH if s["viz_type"] == "bubble"]
    plan = charts.chart_batch(data, pair)[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("HashAggregate(") == 2 and "Expand" not in plan and "WindowGroupLimit" in plan
