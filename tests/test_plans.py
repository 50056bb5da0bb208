"""Shape of the plans: what would not survive a table a thousand times larger."""

import re

import pytest

import __spark_entry__ as binding
from tallyboard import scratch

SF_DIR = "/root/testdata/sf0.001"
# Numbering joins one row per range partition, or sorts the keys of a small batch; a gap fill sorts one row per day.
STAGING = {
    "decimal_conform", "event_window_table", "group_ranks", "load_job", "load_job_tiers", "surrogate_keys", "unique_slugs", "upsert_table",
}
SMALL_WINDOWS = {"load_job", "load_job_tiers", "upsert_table", "surrogate_keys", "group_ranks", "unique_slugs", "calendar_spine_gapfill"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check(plan, small_windows):
    for node in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD["):
        assert node not in plan
    if not small_windows:
        assert not re.search(r"Window \[[^\n]*\n(?:[^\n]*(?:Sort|WindowGroupLimit)[^\n]*\n)*[^\n]*Exchange SinglePartition", plan)


@pytest.mark.parametrize("name", sorted(binding.base_queries()))
def test_no_python_no_cross_join_no_global_window(spark, name, monkeypatch):
    """In the plan of the result and of every table staged on the way."""
    staged = []

    def seen(df, path, write=scratch._staged):
        staged.append(plan_of(df))
        return write(df, path)

    monkeypatch.setattr(scratch, "_staged", seen)
    check(plan_of(binding.base_queries()[name](spark, SF_DIR)), name in SMALL_WINDOWS)
    for plan in staged:
        check(plan, name in SMALL_WINDOWS)
    assert bool(staged) == (name in STAGING)


@pytest.mark.parametrize("name, columns", [
    ("series_weekday", {"o_totalprice", "o_orderdate"}), ("bar_daily_sum", {"l_shipdate", "l_extendedprice"}),
    ("big_number_count", set()), ("bubble_top100", {"p_size", "p_brand", "p_type"}),
    ("where_having", {"o_custkey", "o_totalprice", "o_orderstatus"}),
])
def test_scans_read_only_what_they_need(spark, name, columns):
    schema = re.search(r"ReadSchema: struct<(.*?)>\n", plan_of(binding.base_queries()[name](spark, SF_DIR)))[1]
    assert set(re.findall(r"(\w+):", schema)) == columns


@pytest.mark.parametrize("name, pushed", [
    ("temporal_range", "GreaterThanOrEqual(ts,2024-01-10T00:00"), ("where_having", "GreaterThan(o_totalprice,1000.0)"),
    ("equality_filter", "EqualTo(o_orderpriority,1-URGENT)"), ("first_match", "EqualTo(p_name,red widget)"),
    ("new_rows", "GreaterThanOrEqual(o_orderdate,1995-01-01T00:00"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    df = binding.base_queries()[name](spark, SF_DIR)
    formatted = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert pushed in formatted


@pytest.mark.parametrize("name", ["bubble_top100", "series_weekday", "sample_head", "first_match"])
def test_limits_are_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan_of(binding.base_queries()[name](spark, SF_DIR))
