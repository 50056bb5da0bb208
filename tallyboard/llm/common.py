"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract: space and U+0009 to U+000D, which is also what ``bytes.split`` cuts at.
SPACE = " \t\n\x0b\x0c\r"

_ODD = np.uint64(0x9E3779B97F4A7C15)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(quoted(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns that an operator adds itself; names compare as Spark compares them."""
    lowered = {n.lower() for n in names}
    return df.select(*[col(c) for c in df.columns if c.lower() not in lowered])


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often a lambda reads it."""
    return F.transform(F.array(value), use)[0]


#: Values of an array that are merged one by one.
_RUN = 256


def running(values: Column, merge: Callable[[Column, Column], Column], start: Column) -> Column:
    """For each place of an array, ``start`` merged with all values before it; ``merge`` is associative, ``start`` its neutral value.

    An array that grows by one element at a time costs the square of its size. So whole blocks are merged
    first, and an array only grows by blocks, or within one.
    """

    def grown(vs: Column, first: Column) -> Column:
        return F.aggregate(vs, F.array(first), lambda held, v: F.concat(held, F.array(merge(F.element_at(held, -1), v))))

    def of(vs: Column) -> Column:
        last = F.greatest(F.ceil(F.size(vs) / F.lit(_RUN)).cast("int") - 1, F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(vs, k * _RUN + 1, F.lit(_RUN)))
        before = grown(F.transform(blocks, lambda b: F.aggregate(b, start, lambda x, y: merge(x, y))), start)
        return bound(before, lambda firsts: F.flatten(F.transform(
            blocks, lambda b, k: F.slice(grown(b, F.get(firsts, k)), 1, F.size(b))
        )))

    return bound(values, of)


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def chunked(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000, max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded rows and bytes, so that a task's memory does not grow with its input."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        for v in row:
            if isinstance(v, (str, bytes)):
                weight += len(v)
            elif isinstance(v, (list, np.ndarray)):
                weight += 8 * len(v)
        if len(held) >= size or weight >= max_bytes:
            yield batch_of(held, schema)
            held, weight = [], 0
    if held:
        yield batch_of(held, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each run of ``n`` consecutive word hashes, in order of place."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(m, np.uint64)
    for k in range(n):
        total = mix(total * _ODD + words[k : k + m])
    return total


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def rolling_hashes(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of each run of ``n`` consecutive word hashes, as a polynomial: the cost does not grow with ``n``."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    if seed not in _POWERS or len(_POWERS[seed][0]) < len(words):
        base = (seed * 0x9E3779B97F4A7C15 | 5) & ~2 & (2**64 - 1)  # odd, so it has an inverse
        size = max(1 << 12, 2 * len(words))
        up = np.cumprod(np.full(size, base, np.uint64)) * np.uint64(pow(base, -1, 2**64))
        down = np.cumprod(np.full(size, pow(base, -1, 2**64), np.uint64)) * np.uint64(base)
        _POWERS[seed] = up, down
    up, down = _POWERS[seed]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words ^ np.uint64(seed)) * up[: len(words)])))
    return mix((sums[n:] - sums[:-n]) * down[:m])
