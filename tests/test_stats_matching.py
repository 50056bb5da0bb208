import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyboard.operators import datasets, reconcile, stats, windows


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(dt.date(2024, 1, 6), 10.0, 1, "a"), (dt.date(2024, 1, 8), 20.0, 0, "b"), (dt.date(2024, 1, 9), 30.0, 0, "b"),
         (None, None, None, None)],
        "date date, x double, flag int, tier string",
    )


def test_load_summary(table):
    assert rows(stats.load_summary(table, "date", ["x"], "tier")) == [
        (4, dt.date(2024, 1, 6), dt.date(2024, 1, 9), 20.0, 2)
    ]
    assert rows(stats.load_summary(table.where("false"), "date", ["x"], "tier")) == [(0, None, None, None, 0)]


def test_share_of_total(table):
    shares = rows(stats.share_of_total(table, "tier"))
    assert shares == [("b", 2, 50.0), (None, 1, 25.0), ("a", 1, 25.0)]
    assert sum(s[2] for s in shares) == 100
    assert rows(stats.share_of_total(table.where("false"), "tier")) == []


def test_share_reads_its_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select((F.col("id") % 7).alias("g")).write.parquet(path)
    shares = stats.share_of_total(spark.read.parquet(path), "g")
    assert shares.count() == 7
    shares.collect()
    final = shares._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final or final.count("FileScan") == 1


def test_metric_summary(table):
    assert rows(stats.metric_summary(table, ["x", "flag"])) == [
        ("x", 10.0, 30.0, 20.0, 10.0), ("flag", 0.0, 1.0, 0.3, 0.6)
    ]
    one = table.where("flag = 1")
    assert rows(stats.metric_summary(one, ["x"])) == [("x", 10.0, 10.0, 10.0, None)]


def test_compare_segments(table):
    assert rows(stats.compare_segments(table, "flag", "x")) == [(10.0, 25.0, pytest.approx(-60.0))]
    assert rows(stats.compare_segments(table.where("flag = 1"), "flag", "x")) == [(10.0, None, None)]


def test_head(table):
    assert rows(stats.head(table.select("x"), 2, ["x"])) == [(None,), (10.0,)]


@pytest.fixture(scope="module")
def listing(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, name string")


def test_new_and_present(spark, listing):
    have = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    assert sorted(r["id"] for r in reconcile.new_rows(listing, have, "name").collect()) == [2, 4]
    assert sorted(r["id"] for r in reconcile.present_rows(listing, have, "name").collect()) == [1, 3]
    assert reconcile.new_rows(listing, have.where("false"), "name").count() == 4


def test_first_match(spark, listing):
    assert rows(reconcile.first_match(listing, "name", "a", ["id"])) == [(1, "a")]
    assert rows(reconcile.first_match(listing, "name", "zz", ["id"])) == []
    wanted = spark.createDataFrame([("a",), ("a",), ("zz",), (None,)], "name string")
    known = listing.withColumn("place", F.col("id"))
    assert sorted(rows(reconcile.lookup_first(wanted, known, "name", "id", "place")), key=str) == [
        ("a", 1), ("a", 1), ("zz", None), (None, None)
    ]


def test_classify_uses_the_last_of_a_name(spark, listing):
    incoming = spark.createDataFrame([("a", 10), ("a", 11), ("c", 12), (None, 13)], "name string, n int")
    assert sorted(rows(reconcile.classify(incoming, listing, "name", "id")), key=lambda r: r[1]) == [
        ("a", 10, 3, "update"), ("a", 11, 3, "update"), ("c", 12, None, "create"), (None, 13, None, "create")
    ]


DAYS = ["2024-08-14", "2024-08-15", "2024-08-25", "2024-08-26", "2024-12-01", "2024-12-30", None]


def test_event_windows_are_closed(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d string").select(F.to_timestamp_ntz("d").alias("d"))
    got = rows(windows.with_listed_events(df, "d", windows.EVENTS_2024).select("event", "event_factor"))
    assert got == [(None, 1.0), ("launch", 1.12), ("launch", 1.12), (None, 1.0), ("promotion", 1.08),
                   ("year end", 0.88), (None, 1.0)]


def test_window_table_equals_the_list(spark):
    listed = [
        windows.EventWindow("one", dt.date(2024, 1, 3), dt.date(2024, 1, 6), 2.0),
        windows.EventWindow("two", dt.date(2024, 1, 1), dt.date(2024, 1, 9), 3.0),
        windows.EventWindow("none", dt.date(2024, 1, 20), dt.date(2024, 1, 10), 4.0),
    ]
    made = spark.createDataFrame(
        [(i, w.event, w.start, w.end, w.factor) for i, w in enumerate(listed)],
        "rank int, event string, start date, end date, factor double",
    )
    days = spark.sql("SELECT explode(sequence(date'2023-12-30', date'2024-01-25')) AS d").union(
        spark.sql("SELECT CAST(NULL AS date)")
    )
    want = windows.with_listed_events(days, "d", listed)
    got = windows.with_event_table(days, "d", made, "rank")
    assert got.columns == want.columns and got.count() == 28
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


CHARTS = [
    ('{"datasource": "7__table"}', '{"datasource": {"id": 9}}', 7, 7, "table"),
    ('{"bad', '{"datasource": {"id": 9, "type": "query"}}', 9, 9, "query"),
    ('{"datasource": {"id": 4, "type": "view"}}', '{"datasource": {"id": 9}}', 9, 4, "view"),
    ('{"datasource": "x__table"}', '{"datasource": {"id": 3}}', 3, 3, "table"),
    ('{"datasource": "5"}', '{"datasource": "5"}', None, None, "table"),
    (None, None, None, None, "table"),
    ("", "[1, 2", None, None, "table"),
    ('{"datasource": " 8 __table"}', None, 8, 8, "table"),
]


def test_dataset_ids(spark):
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(CHARTS)], "i int, p string, q string")
    plain = {r["i"]: r["dataset_id"] for r in datasets.with_dataset_id(df, "p", "q").collect()}
    assert [plain[i] for i in range(len(CHARTS))] == [c[2] for c in CHARTS]
    full = datasets.with_dataset_id(df, "p", "q", True, type_column="kind")
    assert full.columns == ["i", "p", "q", "dataset_id", "kind"]
    got = {r["i"]: (r["dataset_id"], r["kind"]) for r in full.collect()}
    assert [got[i] for i in range(len(CHARTS))] == [c[3:] for c in CHARTS]


def test_dataset_ids_of_any_length(spark):
    texts = ["9223372036854775807__table", "9223372036854775808__table", "-9223372036854775808__table", "0012__table", "x9__table"]
    df = spark.createDataFrame([(k, f'{{"datasource": "{t}"}}', f'{{"datasource": {{"id": {k}{"0" * 17}}}}}') for k, t in enumerate(texts, 1)], "i int, p string, q string")
    got = {r["i"]: r["dataset_id"] for r in datasets.with_dataset_id(df, "p", "q").collect()}
    assert got == {1: 2**63 - 1, 2: 2 * 10**17, 3: -(2**63), 4: 12, 5: 5 * 10**17}


def test_open_ended_windows_are_cut_to_the_data(spark):
    df = spark.createDataFrame([(k, dt.date(2024, 1, 1) + dt.timedelta(k)) for k in range(5)], "i int, d date")
    events = spark.createDataFrame(
        [(1, "open", dt.date(2024, 1, 3), dt.date(9999, 12, 31), 2.0), (2, "since ever", dt.date(1, 1, 1), dt.date(2024, 1, 4), 3.0)],
        "p int, event string, start date, end date, factor double",
    )
    got = {r.i: r.event for r in windows.with_event_table(df, "d", events, "p").collect()}
    assert got == {0: "since ever", 1: "since ever", 2: "open", 3: "open", 4: "open"}
    assert windows.with_event_table(df.limit(0), "d", events, "p").collect() == []


def test_members_leave_a_json_map(spark):
    text = '{"V": "v2", "N": null, "A": {"meta": {"chartId": 3, "w": 1.5}}, "B": {"meta": {"chartId": 4}}, "C": {"meta": {}}, "D": [3], "E": {"meta": {"chartId": "x"}}}'
    df = spark.createDataFrame([(1, text), (2, "{}"), (3, "broken {"), (4, "[1]"), (5, None), (6, '{"A": {"meta": {"chartId": 3}}}')], "i int, p string")
    got = {r.i: r.p for r in df.select("i", reconcile.without_members("p", lambda c: c.isin(3, 9)).alias("p")).collect()}
    assert json.loads(got.pop(1)) == {k: v for k, v in json.loads(text).items() if k != "A"}
    assert got == {2: "{}", 3: None, 4: None, 5: None, 6: "{}"}


def test_names_of_one_dataset(spark):
    existing = spark.createDataFrame([("a", 1, 7), ("a", 2, 8), ("b", 3, 7), (None, 4, 7)], "name string, id int, dataset int")
    incoming = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "name string")
    got = {r.name: (r.action, r.existing_id) for r in reconcile.classify(incoming, existing, "name", "id", within=("dataset", 7)).collect()}
    assert got == {"a": ("create", None), "b": ("update", 3), "c": ("create", None), None: ("create", None)}


def test_members_listed_in_a_table(spark):
    """As without_members with the same ids: objects of other shapes, malformed and null text, null and repeated ids."""
    texts = [
        '{"CHART-1": {"meta": {"chartId": 3}}, "CHART-2": {"meta": {"chartId": 4}}, "ROW": {"type": "ROW"}}', '{"x": {"meta": {"chartId": "9"}}, "y": 5}',
        "{}", "[1]", "{broken", None, '{"only": {"meta": {"chartId": 3}}}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, p string")
    gone = spark.createDataFrame([(3,), (9,), (3,), (None,), (77,)], "id int")
    want = {r.i: r.p for r in df.select("i", reconcile.without_members("p", lambda c: c.isin(3, 9)).alias("p")).collect()}
    got = reconcile.without_listed_members(df, ["i"], "p", gone, "id")
    assert got.columns == ["i", "p"] and {r.i: r.p for r in got.collect()} == want
    assert reconcile.without_listed_members(df, ["i"], "p", gone.where("false"), "id").count() == len(texts)
