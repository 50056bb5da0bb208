"""Run a bound query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    """None if rows, names, types and values agree, else what differs."""
    df = query(spark, sf_dir)
    got_types = {f.name: f.dataType.simpleString() for f in df.schema}
    relation = con.sql(sql)
    want_types = {}
    for name, kind in zip(relation.columns, relation.types, strict=True):
        kind = str(kind)
        want_types[name] = KINDS.get(kind, kind.lower().replace(" ", ""))
    if got_types != want_types:
        return f"types: spark {got_types}, sql {want_types}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(relation.columns, relation.fetchall())
    if len(got) != len(want):
        return f"rows: spark {len(got)}, sql {len(want)}"
    different = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(different)} of {len(got)} rows differ: {different[:3]}" if different else None
