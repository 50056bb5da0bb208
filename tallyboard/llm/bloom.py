"""Bloom filters of bounded size built by tasks and sent to all tasks."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the largest filter: 64 MB. A fuller one says yes more often and never wrongly no.
MOST_BITS = 1 << 29
PROBES = 4
_PART = 1 << 20


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    step = (hashes >> np.uint64(31)) | np.uint64(1)
    return (hashes[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(size - 1)


def holds(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a filter may hold."""
    out = np.zeros(len(hashes), bool)
    for at in range(0, len(hashes), 1 << 16):
        bits = _bits(hashes[at : at + (1 << 16)], len(filled) * 8)
        out[at : at + (1 << 16)] = ((filled[(bits >> np.uint64(3)).astype(np.int64)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
    return out


def _filled(size: int, hashed: Callable[[pa.RecordBatch], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size // 8, np.uint8)
        for batch in batches:
            hashes = hashed(batch)
            for at in range(0, len(hashes), 1 << 16):
                bits = _bits(hashes[at : at + (1 << 16)], size).ravel()
                np.bitwise_or.at(held, (bits >> np.uint64(3)).astype(np.int64), (1 << (bits & np.uint64(7))).astype(np.uint8))
        for at in range(0, len(held), _PART):
            if held[at : at + _PART].any():
                yield pa.RecordBatch.from_arrays([pa.array([at // _PART], pa.int32()), pa.array([zlib.compress(held[at : at + _PART].tobytes(), 1)])], ["part", "bits"])

    return run


def _merged(key, part):
    bits = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(x), np.uint8) for x in part.column("bits").to_pylist()])
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())})


def build(rows: DataFrame, number: int, hashed: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The filter of the 64-bit hashes that ``hashed`` gives for batches of about ``number`` rows."""
    size = min(MOST_BITS, 1 << max(13, math.ceil(math.log2(max(1, 16 * number)))))
    parts = rows.coalesce(8).mapInArrow(_filled(size, hashed), "part int, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for r in parts.groupBy("part").applyInArrow(_merged, "part int, bits binary").collect():  # at most MOST_BITS in all
        piece = np.frombuffer(zlib.decompress(bytes(r.bits)), np.uint8)
        out[r.part * _PART : r.part * _PART + len(piece)] = piece
    return out
