"""Lines that many documents share, found with a once-seen and a twice-seen Bloom filter.

1. Each task sends the distinct 64-bit hashes of its line keys, with a mark on those it met in
   more than one document: 9 bytes a line, no text.
2. Hashes are dealt into segments of a bounded number of hashes. A segment passes them through two
   Bloom filters: a hash whose bits are all set in the once-seen filter enters the twice-seen one.
3. Documents are read again. Only keys that the twice-seen filter holds (suspected repeats) are
   shuffled, as text, and counted exactly. A Bloom filter has no false negatives, so no repeat is
   lost; a false suspect is found to be rare in the count.
4. Kept occurrence: the largest id. The keys to drop go back to their documents by id.

The filter is sent to every task only while it is at most ``max_filter_bytes``; beyond that the
segments give their suspects' hashes, which are joined to the lines by a shuffle.

Defined results: a null or empty text is one empty line and stays (as an empty text); a row with a null id
keeps all lines and counts for none; rows with the same id are one document for the count, and each of
them loses the same keys; a caller's column named like an added one is replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import SPACE, chunked, col, rows_of, without
from tallyboard.scratch import stage

SEGMENT_HASHES = 1 << 16
SEGMENT_BITS = 1 << 20  # 16 bits for each hash
PROBES = 4
#: Distinct hashes that a task holds before it passes them on.
HELD = 1 << 20
ADDED = ("n_lines", "n_dropped")


def line_key(line: str, min_chars: int) -> bytes | None:
    """The line without outer white space and in lower case (A-Z only); None if it is too short to count."""
    if len(line) < min_chars:
        return None
    line = line.strip(SPACE)
    return line.encode().lower() if len(line) >= min_chars else None


def keys_of(text: str | None, min_chars: int) -> set[bytes]:
    keys = {line_key(x, min_chars) for x in (text or "").split("\n")}
    keys.discard(None)
    return keys


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """The bits of each hash within its segment, one row for a hash."""
    low, high = hashes >> np.uint64(8), (hashes >> np.uint64(33)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((low[:, None] + steps * high[:, None]) % np.uint64(SEGMENT_BITS)).astype(np.int64)


def twice_seen(hashes: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The twice-seen filter of a segment, and which of its hashes entered it."""
    once, twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
    suspect = again.copy()
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        bits = bits_of(part)
        _, place, number = np.unique(part, return_inverse=True, return_counts=True)
        suspect[at : at + 4096] |= once[bits].all(axis=1) | (number[place] > 1)
        once[bits] = True
    twice[bits_of(hashes[suspect])] = True
    return twice, suspect


def _hashes(min_chars: int):
    schema = pa.schema([("hash", pa.int64()), ("again", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            seen: dict[int, bool] = {}
            for key_id, text in rows_of(batches, "id", "text"):
                if key_id is None:
                    continue
                for key in keys_of(text, min_chars):
                    h = xxhash.xxh3_64_intdigest(key)
                    seen[h] = h in seen
                if len(seen) >= HELD:
                    yield from seen.items()
                    seen = {}
            yield from seen.items()

        for batch in chunked(rows(), pa.schema([("hash", pa.uint64()), ("again", pa.bool_())]), 200_000):
            yield pa.RecordBatch.from_arrays([batch.column(0).view(pa.int64()), batch.column(1)], schema=schema)

    return run


def _suspects(min_chars: int, segments: int, sent):
    schema = pa.schema([("id", pa.int64()), ("key", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.empty((segments, SEGMENT_BITS // 8), np.uint8)
        for k, packed in sent.value.items():
            twice[k] = np.frombuffer(zlib.decompress(packed), np.uint8)

        def rows():
            for batch in batches:
                ids, keys = [], []
                for key_id, text in rows_of([batch], "id", "text"):
                    if key_id is not None:
                        found = keys_of(text, min_chars)
                        keys += found
                        ids += [key_id] * len(found)
                if not keys:
                    continue
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
                bits = bits_of(hashes)
                bytes_ = twice[(hashes % np.uint64(segments)).astype(np.int64)[:, None], bits >> 3]
                hit = ((bytes_ >> (bits & 7).astype(np.uint8)) & 1).all(axis=1)
                for k in np.flatnonzero(hit):
                    yield ids[k], keys[k].decode()

        yield from chunked(rows(), schema)

    return run


def _all_keys(min_chars: int):
    schema = pa.schema([("id", pa.int64()), ("key", pa.string()), ("hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for key_id, text in rows_of(batches, "id", "text"):
                if key_id is not None:
                    for key in keys_of(text, min_chars):
                        yield key_id, key.decode(), int(np.uint64(xxhash.xxh3_64_intdigest(key)).view(np.int64))

        yield from chunked(rows(), schema)

    return run


def _segment(with_hashes: bool):
    kinds = [("segment", pa.int64()), ("hash", pa.int64())] if with_hashes else [("segment", pa.int64()), ("bits", pa.binary())]

    def run(key, part):
        hashes = part.column("hash").to_numpy().view(np.uint64)
        twice, suspect = twice_seen(hashes, part.column("again").to_numpy().astype(bool))
        if with_hashes:
            found = np.unique(hashes[suspect]).view(np.int64)
            columns = [pa.array(np.full(len(found), key[0].as_py())), pa.array(found)]
        else:
            columns = [pa.array([key[0].as_py()]), pa.array([zlib.compress(np.packbits(twice, bitorder="little").tobytes(), 1)])]
        return pa.Table.from_arrays(columns, schema=pa.schema(kinds))

    return run


def suspected_lines(ids_and_texts: DataFrame, min_chars: int = 40, max_filter_bytes: int = 128 << 20) -> DataFrame:
    """(id, key) of every line key that may be in more than one document; columns ``id`` and ``text`` in."""
    spark = ids_and_texts.sparkSession
    hashes = stage(ids_and_texts.mapInArrow(_hashes(min_chars), "hash long, again boolean"), "line-hashes")
    segments = max(1, math.ceil(hashes.count() / SEGMENT_HASHES))
    # The remainder must be that of the unsigned hash, as the tasks compute it.
    unsigned = F.pmod(F.pmod(F.shiftrightunsigned("hash", 1), F.lit(segments)) * 2 + F.col("hash").bitwiseAND(F.lit(1)), F.lit(segments))
    grouped = hashes.withColumn("segment", unsigned).groupBy("segment")
    if segments * SEGMENT_BITS // 8 <= max_filter_bytes:
        filters = grouped.applyInArrow(_segment(False), "segment long, bits binary")
        sent = spark.sparkContext.broadcast({r.segment: bytes(r.bits) for r in filters.collect()})
        return ids_and_texts.mapInArrow(_suspects(min_chars, max(segments, 1), sent), "id long, key string")
    suspects = grouped.applyInArrow(_segment(True), "segment long, hash long").select("hash").distinct()
    lines = ids_and_texts.mapInArrow(_all_keys(min_chars), "id long, key string, hash long")
    return lines.join(suspects, "hash", "left_semi").select("id", "key")


def _drop(text_at: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers, dropped = [], [], []
            for text, keys in zip(batch.column(text_at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                numbers.append(len(lines))
                if keys:
                    gone = {k.encode() for k in keys}
                    lines = [x for x in lines if line_key(x, min_chars) not in gone]
                dropped.append(numbers[-1] - len(lines))
                texts.append("\n".join(lines))
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns[text_at] = pa.array(texts, pa.string())
            columns += [pa.array(numbers, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *ADDED])

    return run


def drop_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    min_chars: int = 40, min_docs: int = 5, max_filter_bytes: int = 128 << 20,
) -> DataFrame:
    """``docs`` with repeated lines removed from the text, and ``n_lines`` (before) and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses its lines in
    all documents but the one with the largest id.
    """
    docs = without(docs, ADDED)
    source = docs.select(col(id_column).cast("long").alias("id"), col(text_column).alias("text"))
    suspects = stage(suspected_lines(source, min_chars, max_filter_bytes), "line-suspects")
    suspects = suspects.dropDuplicates(["id", "key"])
    repeated = suspects.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("kept")).where(F.col("n") >= min_docs)
    drops = (
        suspects.join(repeated, "key").where(F.col("id") < F.col("kept"))
        .groupBy(F.col("id").alias("__tb_id")).agg(F.collect_list("key").alias("__tb_keys"))
    )
    joined = docs.join(drops, col(id_column).cast("long") == F.col("__tb_id"), "left").drop("__tb_id")
    text_at = docs.columns.index(text_column)
    out = docs.withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema
    return joined.mapInArrow(_drop(text_at, min_chars), out)
