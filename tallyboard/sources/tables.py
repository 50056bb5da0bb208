"""Typed parquet tables, partitioned by a function of their key, switched by a manifest.

A table is a folder with data in ``data/<version>/pack=<number>/`` and one small JSON manifest for each version. The
manifest names the folder of every partition and its rows, the key, the types, the layout and the
highest id. Neighbouring partitions share a folder, a pack, up to a number of rows, so a small month is no file of its
own; a pack is what a change rewrites. A change writes new folders first and then creates the next manifest, which fails if
another writer was first. Nothing is moved or overwritten: a job that stops at any point leaves the table as
it was, and a reader sees one version or the next.

Without a date in the key, partitions are hash buckets that grow by linear hashing: with more rows than
``bucket_rows`` for each, buckets split in two, one after the other. Where a row belongs follows from the number of buckets alone.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.functions.ranges import between
from tallyboard.operators.clean import conform

MONTH, YEAR, BUCKET = "month", "year", "bucket"
BUCKETS = 64
#: Rows of a bucket on average before buckets split, and of a pack of several partitions.
BUCKET_ROWS, PACK_ROWS = 4_000_000, 1_000_000
#: The partition of a row, whose value is its name in the manifest, and the folder column.
PART, PACK = "part", "pack"
_MANIFESTS = "_manifests"
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


class TableError(ValueError):
    """A table that does not fit what is asked of it, or that another writer has changed meanwhile."""


@dataclass(frozen=True)
class Part:
    folder: str
    rows: int


@dataclass(frozen=True)
class Manifest:
    """One version of a table. ``base`` is the number of buckets it began with."""

    key: tuple[str, ...]
    grain: str
    buckets: int
    schema: str
    version: int = 0
    highest: int = 0
    parts: Mapping[str, Part] = field(default_factory=dict)
    base: int = 0
    bucket_rows: int = BUCKET_ROWS
    pack_rows: int = PACK_ROWS

    def types(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def rows(self) -> int:
        return sum(p.rows for p in self.parts.values())

    def part_of(self) -> Column:
        """The partition of a row, from its key in the table's types."""
        if self.grain == BUCKET:
            whole = self._whole_round(self.buckets)
            bucket = F.pmod(F.xxhash64(*self.key), F.lit(2 * whole))
            return F.when(bucket < self.buckets, bucket).otherwise(bucket - whole).cast("int")
        date = _date_of(self.types(), self.key)
        month = F.year(date) * 100 + F.month(date) if self.grain == MONTH else F.year(date)
        return month.cast("int")

    def _whole_round(self, buckets: int) -> int:
        """The number of buckets when the last round of splits before ``buckets`` was over."""
        whole = self.base or self.buckets
        while 2 * whole <= buckets:
            whole *= 2
        return whole

    def grown(self, rows: int) -> Manifest:
        """With so many buckets that ``rows`` rows are at most ``bucket_rows`` for each; never with fewer than now."""
        if self.grain != BUCKET:
            return self
        return replace(self, base=self.base or self.buckets, buckets=max(self.buckets, -(-rows // self.bucket_rows)))

    def split(self, grown: Manifest) -> set[str]:
        """The buckets from which rows move when the table gets the buckets of ``grown``."""
        found = set()
        for bucket in range(self.buckets, grown.buckets):
            while bucket >= self.buckets:
                bucket -= grown._whole_round(bucket)
            found.add(str(bucket))
        return found

    def packs(self, rows: Mapping[str, int]) -> dict[str, int]:
        """The pack of each partition: neighbours together, as long as they have at most ``pack_rows`` rows."""
        found, pack, held = {}, 0, 0
        for name in sorted(rows, key=int):
            if held and held + rows[name] > self.pack_rows:
                pack, held = pack + 1, 0
            found[name] = pack
            held += rows[name]
        return found

    def with_neighbours(self, names: Iterable[str]) -> list[str]:
        """These partitions and those that are written anew with them.

        These are the ones of the same packs and, before a new partition, the pack in front of it while that is less than half full:
        a table that gets a month at a time does not end up with a folder for each.
        """
        known, held = sorted(map(int, self.parts)), Counter()
        for p in self.parts.values():
            held[p.folder] += p.rows
        folders = set()
        for name in names:
            if name in self.parts:
                folders.add(self.parts[name].folder)
            elif at := bisect_left(known, int(name)):
                before = self.parts[str(known[at - 1])].folder
                folders |= {before} if 2 * held[before] < self.pack_rows else set()
        return [n for n, p in self.parts.items() if p.folder in folders]

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> Manifest:
        held = json.loads(text)
        parts = {k: Part(**v) for k, v in held.pop("parts").items()}
        return cls(**held | {"key": tuple(held["key"]), "parts": parts})


def _date_of(schema: T.StructType, key: Sequence[str]) -> str | None:
    return next((k for k in key if isinstance(schema[k].dataType, _DATES)), None)


def layout(
    schema: T.StructType, key: Sequence[str], grain: str | None = None, buckets: int | None = None,
    bucket_rows: int = BUCKET_ROWS, pack_rows: int = PACK_ROWS,
) -> Manifest:
    """The manifest of a new table: by month of the first date in the key (or by year), else by hash bucket.

    ``buckets`` is the number to begin with. ``pack_rows`` is about what a small change rewrites: 1 gives each partition its own folder.
    """
    grain = grain or (MONTH if _date_of(schema, key) else BUCKET)
    if grain not in (MONTH, YEAR, BUCKET) or (grain != BUCKET and not _date_of(schema, key)):
        raise TableError(f"no table by {grain} with the key {', '.join(key)}")
    if min(buckets or 1, bucket_rows, pack_rows) < 1:
        raise TableError("buckets, bucket_rows and pack_rows are at least 1")
    return Manifest(tuple(key), grain, buckets or BUCKETS, schema.json(), base=buckets or BUCKETS, bucket_rows=bucket_rows, pack_rows=pack_rows)


# --- manifests ----------------------------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _manifest_name(version: int) -> str:
    return f"{version:010d}.json"


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest version, or None where there is no table."""
    files, at = _files(spark, path)
    folder = at(f"{path}/{_MANIFESTS}")
    if not files.exists(folder):
        return None
    names = sorted(s.getPath().getName() for s in files.listStatus(folder))
    names = [n for n in names if n.endswith(".json")]
    if not names:
        return None
    stream = files.open(at(f"{path}/{_MANIFESTS}/{names[-1]}"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest.of(text)


#: How a store makes a file only if it is not there yet, by scheme; see :func:`committer`.
LINK, RENAME, CREATE = "link", "rename", "create"
_COMMITS = {"file": LINK, "hdfs": RENAME, "abfs": RENAME, "abfss": RENAME, "gs": CREATE}
#: Setting that names the way for another scheme, as in ``spark.tallyboard.commit.s3a=create``.
COMMIT_SETTING = "spark.tallyboard.commit."


def committer(spark: SparkSession, scheme: str) -> str:
    """How manifests are created on a store.

    ``link``: a hard link to a file written aside, which the system refuses if the name is taken. ``rename``: the same with a
    rename that never replaces. ``create``: the store refuses to create an object that is there, and shows it when it is whole.
    A store without any of these would let two writers both win, so it is refused unless a setting vouches for it.
    """
    way = spark.conf.get(COMMIT_SETTING + scheme, None) or _COMMITS.get(scheme)
    if way not in (LINK, RENAME, CREATE):
        raise TableError(f"{scheme} is not known to create a file only if it is absent; if it does, set {COMMIT_SETTING}{scheme} to {LINK}, {RENAME} or {CREATE}")
    return way


class Store:
    """What a commit needs of a Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.files, self.at = _files(spark, path)
        self.jvm = spark.sparkContext._jvm

    def scheme(self, path: str) -> str:
        """The scheme that holds ``path``, behind mount tables."""
        return (self.files.resolvePath(self.at(path)).toUri().getScheme() or "file").lower()

    def exists(self, path: str) -> bool:
        return self.files.exists(self.at(path))

    def write(self, path: str, text: str) -> None:
        """Create a file; an error if the store finds it there."""
        stream = self.files.create(self.at(path), False)
        try:
            self.jvm.org.apache.commons.io.IOUtils.write(text, stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, path: str, to: str) -> bool:
        return self.files.rename(self.at(path), self.at(to))

    def link(self, path: str, to: str) -> None:
        local = lambda p: self.jvm.java.io.File(self.at(p).toUri().getPath()).toPath()
        self.jvm.java.nio.file.Files.createLink(local(to), local(path))

    def delete(self, path: str) -> None:
        self.files.delete(self.at(path), False)


def put_if_absent(store: Store, way: str, name: str, text: str) -> bool:
    """Create the file ``name``; False if it is there. No reader meets half of it."""
    if store.exists(name):
        return False
    if way == CREATE:
        try:
            store.write(name, text)
        except Py4JJavaError:
            if store.exists(name):  # another writer was first
                return False
            raise
        return True
    folder, _, last = name.rpartition("/")
    aside = f"{folder}/.{last}-{uuid.uuid4().hex}"
    store.write(aside, text)
    try:
        if way == RENAME:
            return bool(store.rename(aside, name))
        store.link(aside, name)
        return True
    except Py4JJavaError:
        if store.exists(name):
            return False
        raise
    finally:
        if store.exists(aside):
            store.delete(aside)


def switch(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make ``manifest`` the newest version; fails if that version is there already."""
    store = Store(spark, path)
    folder = f"{path}/{_MANIFESTS}"
    store.files.mkdirs(store.at(folder))
    way = committer(spark, store.scheme(folder))
    if not put_if_absent(store, way, f"{folder}/{_manifest_name(manifest.version)}", manifest.text()):
        raise TableError(f"version {manifest.version} of {path} was written by another job; run this one again")


def drop_unused(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` versions and the data that only older ones use. No job may be running."""
    files, at = _files(spark, path)
    folder = at(f"{path}/{_MANIFESTS}")
    names = sorted(s.getPath().getName() for s in files.listStatus(folder) if s.getPath().getName().endswith(".json"))
    used: set[str] = set()
    for name in names[-keep:]:
        stream = files.open(at(f"{path}/{_MANIFESTS}/{name}"))
        used |= {p.folder for p in Manifest.of(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")).parts.values()}
        stream.close()
    if files.exists(at(f"{path}/data")):
        for version in files.listStatus(at(f"{path}/data")):
            for part in files.listStatus(version.getPath()):
                kept = f"data/{version.getPath().getName()}/{part.getPath().getName()}"
                if kept not in used:
                    files.delete(part.getPath(), True)
    for name in names[:-keep]:
        files.delete(at(f"{path}/{_MANIFESTS}/{name}"), False)


# --- reading and writing --------------------------------------------------------------------------


def read_parts(spark: SparkSession, path: str, manifest: Manifest, parts: Iterable[str] | None = None) -> DataFrame:
    """The rows of all packs that hold some of these partitions (all by default), in the types of the manifest."""
    wanted = manifest.parts if parts is None else [p for p in parts if p in manifest.parts]
    folders = dict.fromkeys(f"{path}/{manifest.parts[p].folder}" for p in wanted)
    if not folders:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in manifest.types()])
    return spark.read.schema(manifest.types()).parquet(*folders)


#: Up to so many partitions, their packs are sent to all tasks: one short row each.
SENT_PARTS = 100_000


def write_parts(df: DataFrame, path: str, manifest: Manifest, rows: Mapping[str, int], **changes) -> Manifest:
    """Write rows with their partition in column ``part`` into packs of a new version folder; gives the next manifest.

    ``rows`` is the number of rows of each partition. It is compared with what was really written, so an input that
    changes between its counting and its writing is an error and not a wrong manifest. The rebalance hint
    brings the rows of a pack together so that it is a few large files, and splits one that is much larger than others.
    """
    spark = df.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    packs = manifest.packs(rows)
    if len(set(packs.values())) < 2:
        placed = df.withColumn(PACK, F.lit(0))
    else:
        named = spark.createDataFrame([(int(n), k) for n, k in packs.items()], f"{PART} int, {PACK} int")
        placed = df.join(F.broadcast(named) if len(packs) <= SENT_PARTS else named, PART)
    written = Observation()
    placed = placed.drop(PART).observe(written, F.count(F.lit(1)).alias("rows")).hint("rebalance", PACK)
    placed.write.partitionBy(PACK).parquet(f"{path}/{folder}")
    if written.get["rows"] != sum(rows.values()):
        raise TableError(f"{written.get['rows']} rows came to be written and {sum(rows.values())} were counted; the input has changed")
    parts = dict(manifest.parts) | {name: Part(f"{folder}/{PACK}={packs[name]}", n) for name, n in rows.items()}
    return replace(manifest, version=manifest.version + 1, parts=parts, **changes)


def open_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole table, or None where there is none."""
    manifest = current(spark, path)
    return None if manifest is None else read_parts(spark, path, manifest)


def create_table(
    df: DataFrame, path: str, schema: T.StructType, key: Sequence[str], buckets: int | None = None, grain: str | None = None,
    **sizes: int,
) -> None:
    """Write ``df`` with the types of ``schema`` unless the table is there already. Without rows the types are kept too.

    One pass over the key counts the rows of each partition and finds rows without a key before anything is written; a
    second one writes. ``sizes`` are ``bucket_rows`` and ``pack_rows`` of :func:`layout`.
    """
    spark = df.sparkSession
    if current(spark, path) is not None:
        return
    typed = conform(df, {f.name: f.dataType for f in schema}).select(*schema.names)
    made = layout(T.StructType([T.StructField(f.name, f.dataType) for f in schema]), key, grain, buckets, **sizes)
    if made.grain == BUCKET:
        made = made.grown(typed.count())
    keyless = F.count_if(reduce(Column.__or__, [F.col(k).isNull() for k in key]))
    found = typed.groupBy(made.part_of().alias(PART)).agg(F.count(F.lit(1)).alias("n"), keyless.alias("keyless")).collect()
    if any(r["keyless"] for r in found):
        raise TableError(f"{sum(r['keyless'] for r in found)} rows without a key ({', '.join(key)})")
    rows = {str(r[PART]): r["n"] for r in found}
    made = write_parts(typed.withColumn(PART, made.part_of()), path, made, rows) if rows else replace(made, version=1)
    switch(spark, path, made)


def read_table(
    spark: SparkSession, path: str, key: str | None = None, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """The table, optionally only the days of ``key`` in [start, end).

    For a table by month or year, packs outside the range are not even listed for reading. Bounds take the
    column's type, so the session's time zone does not move them.
    """
    manifest = current(spark, path)
    if manifest is None:
        raise TableError(f"no table at {path}")
    parts = list(manifest.parts)
    if key and manifest.grain != BUCKET and key == _date_of(manifest.types(), manifest.key):
        number = lambda d: d.year * 100 + d.month if manifest.grain == MONTH else d.year
        known = [p for p in parts if p.isdigit()]
        parts = [p for p in known if (not start or int(p) >= number(start)) and (not end or int(p) <= number(end))]
    df = read_parts(spark, path, manifest, parts)
    return between(df, key, start, end) if key else df
