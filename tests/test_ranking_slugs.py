import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyboard.functions.text import slugify
from tallyboard.operators import ranking, slugs
from tallyboard.operators.ranking import number_rows, rank_in_groups
from tallyboard.operators.slugs import unique_slugs


def test_numbers_have_no_gaps(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    got = number_rows(df, ["k"], "n", start=11).collect()
    assert [r["n"] for r in sorted(got, key=lambda r: r["k"])] == list(range(11, 5011))
    assert number_rows(df.where("false"), ["k"]).count() == 0


@pytest.mark.parametrize(("most", "sent"), [(10**6, 10**5), (500, 10**5), (500, 0), (10, 10**5), (0, 10**5)])
def test_rank_equals_window_with_a_hot_group_and_nulls(spark, monkeypatch, most, sent):
    monkeypatch.setattr(ranking, "GROUP_ROWS", most)
    monkeypatch.setattr(ranking, "SENT_GROUPS", sent)
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        (F.col("id") % 97).cast("string")
    )
    df = spark.range(9000).select(group.alias("g"), (F.col("id") * 7919 % 9001).alias("o"))
    want = df.withColumn("rank", F.row_number().over(W.partitionBy("g").orderBy("o")) - 1)
    got = rank_in_groups(df, ["g"], ["o"])
    assert got.exceptAll(want).count() == 0 and got.count() == 9000


def test_hot_group_is_split_over_tasks(spark, monkeypatch):
    """No task numbers the whole of a group that holds every row, and no row is shuffled after the range sort."""
    monkeypatch.setattr(ranking, "GROUP_ROWS", 100)
    df = spark.range(20000).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
    ranked = rank_in_groups(df, ["g"], ["o"]).withColumn("task", F.spark_partition_id())
    assert ranked.where("rank <> o").count() == 0
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
    many = plan.split("Union")[1].split("LeftAnti")[1]
    assert "SortMergeJoin" not in many and "rangepartitioning" not in many


def test_slug_rules(spark):
    titles = ["Auto Dashboard", "a_b  c", "Ünï & Co. (2024)", "", "A-B", None]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert [r[0] for r in df.select(slugify("t")).collect()] == [
        "auto-dashboard", "a-b--c", "n--co-2024", "", "a-b", None
    ]


def plain_slug(title):
    return re.sub(r"[^a-z0-9-]", "", title.lower().replace(" ", "-").replace("_", "-"))


def one_by_one(titles, taken):
    """Rows in order; other rows' bases count as taken for generated suffixes."""
    bases = {plain_slug(t) for t in titles}
    used, out = set(taken), []
    for t in titles:
        base = plain_slug(t)
        slug, n = base, 0
        while slug in used or (n and slug in bases):
            n += 1
            slug = f"{base}-{n}"
        used.add(slug)
        out.append(slug)
    return out


WORDS = st.sampled_from(["a", "A", "a-1", "a 2", "a-1-1", "b", "b_3", "!", "a-01", "c-0", "c"])
TAKEN = st.sampled_from(["a", "a-1", "a-2", "a-3", "a-5", "b", "b-1", "", "-1", "c-0", "c-1", "a-01", "x", "b-2"])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(st.lists(WORDS, min_size=1, max_size=25), st.lists(TAKEN, max_size=8, unique=True))
def test_slugs_match_one_by_one(spark, titles, taken):
    rows = spark.createDataFrame(list(enumerate(titles)), "i int, title string")
    held = spark.createDataFrame([(s,) for s in taken], "slug string")
    got = {r["i"]: r["slug"] for r in unique_slugs(rows, "title", ["i"], held).collect()}
    assert [got[i] for i in range(len(titles))] == one_by_one(titles, taken)
    assert len(set(got.values()) | set(taken)) == len(titles) + len(taken)


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_slugs_of_a_skewed_batch(spark, monkeypatch, few):
    """Both plans: with bases that have claims split off, and all together."""
    monkeypatch.setattr(slugs, "FEW_ROWS", few)
    rng = random.Random(3)
    titles = [("Hot Title" if rng.random() < 0.4 else f"Title {rng.randrange(60)}") for _ in range(3000)]
    taken = ["hot-title", "hot-title-1", "hot-title-7", "hot-title-8", "hot-title-2000", "title-3", "title-3-1"]
    rows = spark.createDataFrame(list(enumerate(titles)), "n int, title string").repartition(7)
    held = spark.createDataFrame([(s,) for s in taken], "slug string")
    got = {r["n"]: r["slug"] for r in unique_slugs(rows, "title", ["n"], held).collect()}
    assert [got[i] for i in range(len(titles))] == one_by_one(titles, taken)
