import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.operators import upsert
from tallyboard.scratch import new_folder
from tallyboard.sources import tables

T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
SCHEMA = "k int, seq int, a string, b double"


def keyed(df, *columns):
    return {r["k"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_last_row_wins(spark):
    df = spark.createDataFrame([(1, 1, "x", 1.0), (1, 3, None, 3.0), (1, 2, "z", 2.0), (2, 1, "y", 1.0)], SCHEMA)
    assert keyed(upsert.last_rows(df, ["k"], ["seq"]), "a", "b") == {1: (None, 3.0), 2: ("y", 1.0)}


def test_merge_takes_nulls_and_keeps_created(spark):
    target = spark.createDataFrame(
        [(1, "old", 1.0, T1, T1), (2, "old", 2.0, T1, T1)],
        "k int, a string, b double, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    batch = spark.createDataFrame([(2, None, 9.0), (3, "new", 3.0)], "k int, a string, b double")
    merged = upsert.merge_rows(target, batch, ["k"], T2)
    assert keyed(merged, "a", "b", "created_at", "updated_at", "status") == {
        1: ("old", 1.0, T1, T1, "kept"), 2: (None, 9.0, T1, T2, "updated"), 3: ("new", 3.0, T2, T2, "inserted"),
    }
    assert tuple(upsert.merge_report(merged).first()) == (1, 1, 1, 2, 3)
    again = upsert.merge_rows(merged.drop("status"), batch, ["k"], T3)
    assert keyed(again, "a", "b", "created_at") == keyed(merged, "a", "b", "created_at")


def test_columns_only_the_target_has(spark):
    target = spark.createDataFrame([(1, "x", 5.0)], "k int, a string, extra double")
    batch = spark.createDataFrame([(1, "y"), (2, "z")], "k int, a string")
    assert keyed(upsert.merge_rows(target, batch, ["k"]), "a", "extra") == {1: ("y", 5.0), 2: ("z", None)}


def test_empty_sides(spark):
    rows = spark.createDataFrame([(1, "x")], "k int, a string")
    none = rows.where("false")
    assert keyed(upsert.merge_rows(none, rows, ["k"]), "status") == {1: ("inserted",)}
    assert keyed(upsert.merge_rows(rows, none, ["k"]), "status") == {1: ("kept",)}


def test_table_against_a_dictionary(spark):
    """Several random batches, hash-bucketed, against rows applied one at a time."""
    rng = random.Random(7)
    path, want, ids = new_folder(spark, "t"), {}, {}
    for moment in (T1, T2, T3):
        rows = [
            (None if rng.random() < 0.05 else rng.randrange(40), i, rng.choice("xyz"), rng.random())
            for i in range(rng.randrange(1, 60))
        ]
        fresh = sorted({k for k, *_ in rows if k is not None} - set(want))
        ids.update({k: len(ids) + n for n, k in enumerate(fresh, 1)})
        seen, before = set(), len(want)
        for k, seq, a, b in rows:
            if k is not None:
                want[k] = (seq, a, b, want[k][3] if k in want else moment, moment)
                seen.add(k)
        batch = spark.createDataFrame(rows, SCHEMA).repartition(5)
        report = upsert.upsert_table(spark, path, batch, ["k"], ["seq"], moment, buckets=4, null_keys="skip")
        assert tuple(report.first()) == (
            len(fresh), len(seen) - len(fresh), len(want) - len(seen), len(seen), len(want), sum(k is None for k, *_ in rows)
        )
        assert before + len(fresh) == len(want)
        table = tables.read_table(spark, path)
        assert table.count() == len(want)
        assert keyed(table, "seq", "a", "b", "created_at", "updated_at") == want
        assert keyed(table, "id") == {k: (v,) for k, v in ids.items()}


def part_files(spark, path):
    return {name: part.folder for name, part in tables.current(spark, path).parts.items()}


def test_only_touched_months_are_rewritten(spark):
    path = new_folder(spark, "months")
    first = spark.createDataFrame([(dt.date(2024, m, 5), m) for m in (1, 2, 3)], "day date, n int")
    upsert.upsert_table(spark, path, first, ["day"], ["n"], T1, pack_rows=1)
    files = part_files(spark, path)
    second = spark.createDataFrame([(dt.date(2024, 2, 6), 20), (dt.date(2024, 2, 5), 21)], "day date, n int")
    report = upsert.upsert_table(spark, path, second, ["day"], ["n"], T2)
    assert tuple(report.first()) == (1, 1, 2, 2, 4, 0)
    now = part_files(spark, path)
    assert {p for p in now if now[p] != files[p]} == {"202402"}
    assert sorted(tuple(r) for r in tables.read_table(spark, path).select("day", "n", "id").collect()) == [
        (dt.date(2024, 1, 5), 1, 1), (dt.date(2024, 2, 5), 21, 2), (dt.date(2024, 2, 6), 20, 4),
        (dt.date(2024, 3, 5), 3, 3),
    ]
    some = tables.read_table(spark, path, "day", dt.date(2024, 2, 1), dt.date(2024, 2, 6))
    assert [r["n"] for r in some.collect()] == [21]
    assert len(some.inputFiles()) == 1 and now["202402"] in some.inputFiles()[0]


def test_null_keys_stop_the_job_or_are_counted(spark):
    path = new_folder(spark, "nulls")
    batch = spark.createDataFrame([(None, 1, "x", 1.0), (None, 2, "y", 1.0)], SCHEMA)
    with pytest.raises(ValueError, match="without a key"):
        upsert.upsert_table(spark, path, batch, ["k"], ["seq"], T1)
    skipped = upsert.upsert_table(spark, path, batch, ["k"], ["seq"], T1, null_keys="skip")
    assert tuple(skipped.first()) == (0, 0, 0, 0, 0, 2)
    assert tables.open_table(spark, path) is None


def test_key_types_and_layout_are_the_tables(spark):
    """Int keys, then the same keys as bigint; a batch that names another layout is refused."""
    path = new_folder(spark, "kinds")
    rows = [(k, 1, "a", 0.0) for k in range(20)]
    upsert.upsert_table(spark, path, spark.createDataFrame(rows, SCHEMA), ["k"], ["seq"], T1, buckets=4)
    wide = spark.createDataFrame(rows, SCHEMA.replace("k int", "k bigint"))
    assert tuple(upsert.upsert_table(spark, path, wide, ["k"], ["seq"], T2).first()) == (0, 20, 0, 20, 20, 0)
    assert tables.read_table(spark, path).count() == 20
    for wrong in ({"buckets": 8}, {"grain": "month"}):
        with pytest.raises(tables.TableError, match="4 buckets"):
            upsert.upsert_table(spark, path, wide, ["k"], ["seq"], T2, **wrong)
    with pytest.raises(tables.TableError, match="kept by k"):
        upsert.upsert_table(spark, path, wide, ["a"], ["seq"], T2)
    with pytest.raises(tables.TableError, match="no column more"):
        upsert.upsert_table(spark, path, wide.withColumn("more", F.lit(1)), ["k"], ["seq"], T2)
    with pytest.raises(ValueError, match="no column more"):
        upsert.merge_rows(wide, wide.withColumn("more", F.lit(1)), ["k"])


def test_created_empty_then_loaded_keeps_types(spark):
    path = new_folder(spark, "typed")
    schema = T.StructType.fromDDL("k int, v decimal(3,2)")
    tables.create_table(spark.createDataFrame([], "k int, v double"), path, schema, ["k"], buckets=2)
    assert tables.read_table(spark, path).collect() == []
    batch = spark.createDataFrame([(1, 2.345, 1)], "k int, v double, seq int")
    upsert.upsert_table(spark, path, batch, ["k"], ["seq"], T1, stored=["k", "v"])
    assert dict(tables.read_table(spark, path).dtypes) == {
        "k": "int", "v": "decimal(3,2)", "id": "bigint", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
    }
    full = new_folder(spark, "full")
    tables.create_table(batch, full, schema, ["k"])
    report = upsert.upsert_table(spark, full, batch.replace(1, 2, ["k"]), ["k"], ["seq"], T1, stored=["k", "v"])
    assert tuple(report.first()) == (1, 0, 1, 1, 2, 0)
    with pytest.raises(tables.TableError, match="without a key"):
        tables.create_table(spark.createDataFrame([(None, 1.0)], "k int, v double"), new_folder(spark, "null"), schema, ["k"])


def test_a_job_that_stops_before_the_switch_changes_nothing(spark, monkeypatch):
    path = new_folder(spark, "stopped")
    first = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 2, 3)], "day date, n int")
    upsert.upsert_table(spark, path, first, ["day"], ["n"], T1)
    before = sorted(map(tuple, tables.read_table(spark, path).collect()))
    batch = spark.createDataFrame([(dt.date(2024, 1, 2), 9), (dt.date(2024, 1, 4), 9)], "day date, n int")

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "switch", stopped)
        with pytest.raises(RuntimeError, match="stopped"):
            upsert.upsert_table(spark, path, batch, ["day"], ["n"], T2)
    assert sorted(map(tuple, tables.read_table(spark, path).collect())) == before
    assert tuple(upsert.upsert_table(spark, path, batch, ["day"], ["n"], T2).first()) == (1, 1, 2, 2, 4, 0)
    # Two writers from one version: the second is told, and its rows are not lost without a word.
    made = tables.current(spark, path)
    stale = dataclasses.replace(made, version=made.version + 1)
    tables.switch(spark, path, stale)
    with pytest.raises(tables.TableError, match="another job"):
        tables.switch(spark, path, stale)
    tables.drop_unused(spark, path, keep=1)
    assert tables.read_table(spark, path).count() == 4


def test_year_grain_and_date_inside_the_key(spark):
    path = new_folder(spark, "years")
    rows = [("a", dt.date(2023, 5, 1), 1), ("b", dt.date(2023, 6, 1), 2), ("a", dt.date(2024, 1, 1), 3)]
    batch = spark.createDataFrame(rows, "shop string, day date, n int")
    upsert.upsert_table(spark, path, batch, ["shop", "day"], ["n"], T1, grain="year", pack_rows=1)
    assert set(part_files(spark, path)) == {"2023", "2024"}
    late = tables.read_table(spark, path, "day", dt.date(2024, 1, 1))
    assert [r.n for r in late.collect()] == [3] and len(late.inputFiles()) == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    events = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq")
    )
    last = upsert.last_rows(events, ["k"], ["seq"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")
    assert last.where("k = 7").first()["seq"] == 59997
