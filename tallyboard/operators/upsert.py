"""Keyed upsert: insert new keys, replace every other column of known keys, keep the rest."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.operators.clean import conform
from tallyboard.operators.ranking import number_rows
from tallyboard.scratch import Scratch
from tallyboard.sources import tables
from tallyboard.sources.tables import PART, Manifest, TableError

INSERTED, UPDATED, KEPT = "inserted", "updated", "kept"
REPORT = (INSERTED, UPDATED, KEPT, "processed_records", "total_records", "rejected")
FAIL, SKIP = "fail", "skip"


def last_rows(df: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The last row of each key by ``seq``, as when rows are applied one after the other.

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit), so a hot key
    reaches its reducer as at most one row per task.
    """
    latest_first = W.partitionBy(*key).orderBy(*[F.desc(s) for s in seq])
    return df.withColumn("_nth", F.row_number().over(latest_first)).where(F.col("_nth") == 1).drop("_nth")


def with_full_key(df: DataFrame, key: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in key:
        present = present & F.col(k).isNotNull()
    return present


def merge_rows(
    target: DataFrame, batch: DataFrame, key: Sequence[str], now: dt.datetime | None = None,
    created: str = "created_at", updated: str = "updated_at", status: str = "status",
    on_insert: Sequence[str] = (),
) -> DataFrame:
    """``target`` after the upsert of ``batch``, with a ``status`` per row.

    ``batch`` holds one row per key and no null keys (see :func:`last_rows`). A row comes from the
    batch whenever its key is there, so nulls in the batch overwrite. Columns of the target that
    the batch lacks keep their value on update and are null on insert; columns in ``on_insert``
    are taken from the batch on insert only. With ``now``, both time columns are set on insert
    and only ``updated`` moves on update. A batch column that the target lacks is an error.
    """
    unknown = [c for c in batch.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the table has no column {', '.join(unknown)}")
    stamps = (created, updated) if now is not None else ()
    old = target.select(
        *[F.col(c).alias(f"_old_{c}") for c in target.columns], F.lit(True).alias("_in_target")
    )
    new = batch.select(*[F.col(c).alias(f"_new_{c}") for c in batch.columns], F.lit(True).alias("_in_batch"))
    same = F.lit(True)
    for i, k in enumerate(key):
        match = F.col(f"_old_{k}") == F.col(f"_new_{k}")
        same = match if i == 0 else same & match
    joined = old.join(new, same, "full_outer")
    in_target, in_batch = F.col("_in_target").isNotNull(), F.col("_in_batch").isNotNull()

    def value(c: str) -> Column:
        old_value, stamp = F.col(f"_old_{c}"), F.lit(now).cast("timestamp_ntz")
        new_value = F.col(f"_new_{c}") if c in batch.columns else old_value
        if c in stamps:
            new_value = stamp
        if c in key:
            return F.coalesce(new_value, old_value)
        if c in on_insert or (c in stamps and c == created):
            return F.when(in_target, old_value).otherwise(new_value)
        return F.when(in_batch, new_value).otherwise(old_value)

    state = F.when(in_batch & in_target, UPDATED).when(in_batch, INSERTED).otherwise(KEPT)
    merged = [value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    return joined.select(*merged, state.alias(status))


def merge_report(merged: DataFrame, status: str = "status") -> DataFrame:
    """Rows inserted, updated and kept, rows of the batch, and rows in the table after it."""
    def rows(*states: str) -> Column:
        return F.count_if(F.col(status).isin(*states))

    return merged.agg(
        rows(INSERTED).alias(INSERTED), rows(UPDATED).alias(UPDATED), rows(KEPT).alias(KEPT),
        rows(INSERTED, UPDATED).alias("processed_records"), F.count(F.lit(1)).alias("total_records"),
    )


#: So many rows are numbered by one task; it sorts their keys only.
ONE_TASK = 100_000


def assign_ids(
    rows: DataFrame, order: Sequence[str], highest: int, name: str = "id", known: int | None = None, **place
) -> DataFrame:
    """Ids above ``highest`` in the order of ``order``, without gaps. ``known`` is the number of rows, if it is known."""
    if known is not None and known <= ONE_TASK:
        return rows.withColumn(name, (F.row_number().over(W.orderBy(*order)) + F.lit(highest)).cast("bigint"))
    return number_rows(rows, order, name, start=highest + 1, **place)


def _table_for(
    spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str], id_column: str | None, buckets: int | None, grain: str | None,
    sizes: Mapping[str, int],
) -> Manifest:
    """The table's newest version, or a first one made for the batch."""
    extra = {id_column: T.LongType()} if id_column else {}
    extra |= {"created_at": T.TimestampNTZType(), "updated_at": T.TimestampNTZType()}
    made = tables.current(spark, path)
    if made is None:
        fields = [T.StructField(f.name, f.dataType) for f in batch.schema]
        made = tables.layout(T.StructType(fields), key, grain, buckets, **sizes)
    elif tuple(key) != made.key or grain not in (None, made.grain) or buckets not in (None, made.base or made.buckets):
        raise TableError(f"{path} is kept by {', '.join(made.key)}, {made.grain}, {made.base or made.buckets} buckets to begin with")
    elif any(getattr(made, name) != n for name, n in sizes.items()):
        raise TableError(f"{path} has {made.bucket_rows} bucket_rows and {made.pack_rows} pack_rows")
    schema = made.types()
    unknown = [c for c in batch.columns if c not in schema.names]
    if unknown:
        raise TableError(f"{path} has no column {', '.join(unknown)}")
    for name, kind in extra.items():
        if name not in schema.names:
            schema = schema.add(name, kind)
    return replace(made, schema=schema.json())


def _rows_by_part(rows: DataFrame, made: Manifest) -> dict[str, int]:
    found = rows.groupBy(made.part_of().alias(PART)).agg(F.count(F.lit(1)).alias("rows")).collect()
    return {str(r[PART]): r["rows"] for r in found}


def upsert_table(
    spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str], seq: Sequence[str],
    now: dt.datetime, id_column: str | None = "id", stored: Sequence[str] | None = None,
    buckets: int | None = None, grain: str | None = None, null_keys: str = FAIL, **sizes: int,
) -> DataFrame:
    """Upsert ``batch`` into the table at ``path`` and return the report.

    ``seq`` orders the rows of one key, and ``stored`` names the columns that go into the table (all by
    default). A new table is partitioned by month (or year, with ``grain``) of the first date in the key, else
    by hash bucket; later batches take key, types and layout from the table, and are refused if they name
    others. Rows with a null key stop the job before anything is written, or, with
    ``null_keys="skip"``, are left out and counted as ``rejected``.

    Only packs that the batch touches are read, and of those first the keys, which give the new rows, their ids and
    the rows of each partition. Then batch and old rows are joined once and written once to a new folder, and one
    manifest switches the table: a job that stops before that changes nothing and can be run again, as can one that lost against
    another writer. A table in buckets that has become too large for them splits some; those are written anew as well.
    ``sizes`` are ``bucket_rows`` and ``pack_rows`` of a new table.
    """
    if null_keys not in (FAIL, SKIP):
        raise ValueError(f"null_keys is {FAIL!r} or {SKIP!r}, not {null_keys!r}")
    key = list(key)
    columns = list(stored or batch.columns)
    made = _table_for(spark, path, batch.select(*columns), key, id_column, buckets, grain, sizes)
    types, before = made.types(), made
    typed = conform(batch, {c: types[c].dataType for c in columns if batch.schema[c].dataType != types[c].dataType})
    with Scratch(spark) as scratch:
        # Rows without a key are one group here, so one of them arrives at most for each task.
        newest = last_rows(typed, key, seq).select(*columns).withColumn(PART, made.part_of())
        newest = scratch.stage(newest, "batch")
        whole = with_full_key(newest, key)
        # Partition names only: at most one for each month or bucket.
        touched = newest.groupBy(PART).agg(F.count_if(whole).alias("rows"), F.count_if(~whole).alias("keyless")).collect()
        rejected = 0
        if any(r["keyless"] for r in touched):
            if null_keys == FAIL:
                raise ValueError(f"rows without a key ({', '.join(key)}); null_keys='skip' leaves them out")
            rejected = batch.where(~with_full_key(batch, key)).count()
        names = [str(r[PART]) for r in touched if r["rows"]]
        processed = sum(r["rows"] for r in touched)
        inserted = 0
        if names:
            incoming = newest.where(whole).drop(PART)
            reread = made.with_neighbours(names)
            keys = incoming.select(*key)
            if reread:
                keys = keys.join(tables.read_parts(spark, path, made, reread).select(*key), key, "left_anti")
            if id_column:
                keys = assign_ids(keys, key, made.highest, id_column, processed, place=scratch.stage)
            keys = scratch.stage(keys, "new-keys")
            fresh = _rows_by_part(keys, made)
            inserted = sum(fresh.values())
            grown = made.grown(made.rows() + inserted)
            if grown.buckets == made.buckets:
                rows = {n: made.parts[n].rows for n in reread}
                rows |= {n: rows.get(n, 0) + m for n, m in fresh.items()}
            else:
                reread = made.with_neighbours([*names, *made.split(grown)])
                rows = Counter(_rows_by_part(keys, grown))
                rows.update(_rows_by_part(tables.read_parts(spark, path, made, reread).select(*key), grown))
                made = replace(grown, parts={n: p for n, p in made.parts.items() if n not in set(reread)})
            incoming = incoming.drop(id_column).join(keys, key, "left") if id_column else incoming
            if reread:
                old = tables.read_parts(spark, path, before, reread)
                result = merge_rows(old, incoming, key, now, on_insert=[id_column] if id_column else [])
            else:
                known = {c: F.col(c) for c in incoming.columns} | {c: F.lit(now).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
                result = incoming.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in types])
            result = result.select(*types.names, made.part_of().alias(PART))
            made = tables.write_parts(result, path, made, rows, highest=made.highest + inserted)
            tables.switch(spark, path, made)
    total = made.rows()
    report = (inserted, processed - inserted, total - processed, processed, total, rejected)
    return spark.createDataFrame([report], ", ".join(f"{c} bigint not null" for c in REPORT))
