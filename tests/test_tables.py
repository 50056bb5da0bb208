import dataclasses
import datetime as dt
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tallyboard.operators import upsert
from tallyboard.scratch import new_folder
from tallyboard.sources import tables

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
SMALL = {"buckets": 3, "bucket_rows": 50, "pack_rows": 1}


def numbers(spark, start, end, step=1):
    return spark.range(start, end, step).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))


def folders(spark, path):
    return {name: part.folder for name, part in tables.current(spark, path).parts.items()}


def check_places(spark, path):
    """Every row lies in the folder of its partition, and the manifest counts it."""
    made = tables.current(spark, path)
    for name, part in made.parts.items():
        rows = spark.read.schema(made.types()).parquet(f"{path}/{part.folder}").groupBy(made.part_of().alias("p")).count().collect()
        assert {str(r.p): r["count"] for r in rows}.get(name, 0) == part.rows
        assert {str(r.p) for r in rows} <= {n for n, p in made.parts.items() if p.folder == part.folder}


def test_a_growing_table_splits_its_buckets(spark):
    path = new_folder(spark, "growing")
    upsert.upsert_table(spark, path, numbers(spark, 0, 100), ["k"], ["v"], T1, **SMALL)
    assert tables.current(spark, path).buckets == 3
    # Twenty times as many rows: no bucket has been touched that the batch or a split does not need.
    upsert.upsert_table(spark, path, numbers(spark, 100, 2000), ["k"], ["v"], T2)
    made = tables.current(spark, path)
    assert made.buckets == 40 and made.base == 3 and max(p.rows for p in made.parts.values()) < 150
    check_places(spark, path)
    before = folders(spark, path)
    one = spark.createDataFrame([(5, 99)], "k long, v long")
    assert tuple(upsert.upsert_table(spark, path, one, ["k"], ["v"], T2).first()) == (0, 1, 1999, 1, 2000, 0)
    after = folders(spark, path)
    assert sum(before[p] != after[p] for p in after) == 1
    table = tables.read_table(spark, path)
    assert sorted((r.k, r.v, r.id) for r in table.collect()) == [(k, 99 if k == 5 else k % 7, k + 1) for k in range(2000)]


def test_small_steps_split_few_buckets(spark):
    path, want = new_folder(spark, "steps"), {}
    rng = random.Random(3)
    sizes = []
    for step in range(5):
        ks = rng.sample(range(10**6), 40) + rng.sample(sorted(want), min(len(want), 5))
        rows = [(k, step * 10**7 + k) for k in ks]
        before = folders(spark, path) if step else {}
        upsert.upsert_table(spark, path, spark.createDataFrame(rows, "k long, v long"), ["k"], ["v"], T1, buckets=2, bucket_rows=20, pack_rows=1)
        want.update(rows)
        check_places(spark, path)
        sizes.append(tables.current(spark, path).buckets)
        assert not before or set(folders(spark, path)) >= set(before)
        assert {r.k: r.v for r in tables.read_table(spark, path).collect()} == want
    assert sizes == sorted(sizes) and sizes[-1] == -(-len(want) // 20)


def test_split_names_the_buckets_rows_come_from():
    """By definition: the old buckets of hashes whose bucket changes."""
    made = tables.Manifest(("k",), tables.BUCKET, 3, "{}", base=3)

    def bucket(h, m):
        whole = m._whole_round(m.buckets)
        r = h % (2 * whole)
        return r if r < m.buckets else r - whole

    for n in (4, 5, 6, 7, 11, 24, 25):
        grown = dataclasses.replace(made, buckets=n)
        moved = {str(bucket(h, made)) for h in range(10_000) if bucket(h, made) != bucket(h, grown)}
        assert made.split(grown) == moved and {bucket(h, grown) for h in range(10_000)} == set(range(n))
        for h in range(200):
            later = dataclasses.replace(grown, buckets=n + 1)
            assert bucket(h, later) in (bucket(h, grown), n)


def test_small_partitions_share_a_pack(spark):
    path = new_folder(spark, "packs")
    days = spark.range(0, 1500).select(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("day"), F.col("id").alias("n"))
    upsert.upsert_table(spark, path, days, ["day"], ["n"], T1, pack_rows=400)
    made = tables.current(spark, path)
    assert len(made.parts) == 50 and len(set(folders(spark, path).values())) == 4
    check_places(spark, path)
    some = tables.read_table(spark, path, "day", dt.date(2020, 3, 1), dt.date(2020, 4, 1))
    assert some.count() == 31 and len({f.split("/")[-2] for f in some.inputFiles()}) == 1
    before = folders(spark, path)
    upsert.upsert_table(spark, path, days.where("n = 3"), ["day"], ["n"], T2)
    after = folders(spark, path)
    assert {p for p in after if after[p] != before[p]} == {p for p in before if before[p] == before["202001"]}
    assert tables.read_table(spark, path).count() == 1500


def test_months_one_after_the_other_do_not_pile_up(spark):
    path = new_folder(spark, "months")
    for m in range(1, 7):
        batch = spark.createDataFrame([(dt.date(2024, m, d), d) for d in range(1, 11)], "day date, n int")
        upsert.upsert_table(spark, path, batch, ["day"], ["n"], T1, pack_rows=40)
    assert len(set(folders(spark, path).values())) == 3
    check_places(spark, path)


def test_an_input_that_changes_while_it_is_written(spark):
    path = new_folder(spark, "changing")
    made = tables.layout(numbers(spark, 0, 1).schema, ["k"], **SMALL)
    rows = numbers(spark, 0, 10).withColumn("part", F.lit(0))
    with pytest.raises(tables.TableError, match="10 rows came to be written and 11"):
        tables.write_parts(rows, path, made, {"0": 11})


class FakeStore:
    """Files in memory; ``rename`` and ``write`` replace or refuse, as told."""

    def __init__(self, replaces: bool, before_write=None):
        self.held, self.replaces, self.before_write = {}, replaces, before_write

    def exists(self, path):
        return path in self.held

    def write(self, path, text):
        if self.before_write and "/." not in path:
            self.before_write, act = None, self.before_write
            act()
        if path in self.held and not self.replaces:
            raise Py4JJavaError("there", _Thrown())
        self.held[path] = text

    def rename(self, path, to):
        if self.before_write:
            self.before_write, act = None, self.before_write
            act()
        if to in self.held and not self.replaces:
            return False
        self.held[to] = self.held.pop(path)
        return True

    def delete(self, path):
        del self.held[path]


class _Thrown:
    _target_id, _gateway_client = "o0", None


@pytest.mark.parametrize("way", [tables.RENAME, tables.CREATE])
def test_two_writers_on_a_store_that_refuses(way):
    store = FakeStore(False)
    store.before_write = lambda: store.held.__setitem__("m/1.json", "theirs")
    assert not tables.put_if_absent(store, way, "m/1.json", "ours")
    assert store.held == {"m/1.json": "theirs"}
    assert tables.put_if_absent(store, way, "m/2.json", "ours") and not tables.put_if_absent(store, way, "m/2.json", "again")
    assert store.held == {"m/1.json": "theirs", "m/2.json": "ours"}


def test_a_store_whose_rename_replaces_is_refused(spark):
    """There both writers would win, so no table is switched on it unless a setting vouches for the store."""
    store = FakeStore(True)
    store.before_write = lambda: store.held.__setitem__("m/1.json", "theirs")
    assert tables.put_if_absent(store, tables.RENAME, "m/1.json", "ours") and store.held["m/1.json"] == "ours"
    with pytest.raises(tables.TableError, match="s3a is not known"):
        tables.committer(spark, "s3a")
    spark.conf.set("spark.tallyboard.commit.s3a", "create")
    try:
        assert tables.committer(spark, "s3a") == tables.CREATE
    finally:
        spark.conf.unset("spark.tallyboard.commit.s3a")
    assert [tables.committer(spark, s) for s in ("file", "hdfs", "abfss", "gs")] == ["link", "rename", "rename", "create"]


def test_local_files_are_linked_and_never_replaced(spark):
    path = new_folder(spark, "linked")
    made = dataclasses.replace(tables.layout(numbers(spark, 0, 1).schema, ["k"]), version=1)
    tables.switch(spark, path, made)
    store = tables.Store(spark, path)
    store.write(f"{path}/aside", "other")
    with pytest.raises(Py4JJavaError):
        store.link(f"{path}/aside", f"{path}/_manifests/0000000001.json")
    with pytest.raises(tables.TableError, match="another job"):
        tables.switch(spark, path, made)
    assert tables.current(spark, path) == made
    left = [s.getPath().getName() for s in store.files.listStatus(store.at(f"{path}/_manifests"))]
    assert left == ["0000000001.json"]
