"""Phrases of words that stand together more often than their parts do, by Toivonen's sampling.

1. A sample of documents (a share by hash) proposes words and phrases, at a lowered threshold.
2. One full pass counts exactly all words, the proposed phrases and their negative border: the phrases
   that were not proposed although both their parts (without the last, without the first word) were. What is not counted has
   a part that is not frequent, if no phrase of the border is.
3. A frequent phrase of the border is a failure of the sample. Then all frequent phrases known are proposed and a further
   pass counts what became of interest, without what earlier passes have counted, until nothing fails.
4. Exact counts give the score of each phrase of at least two words: for its weakest cut, the square of its count by
   the product of the parts' counts, in millionths. Phrases mostly found inside a longer one are dropped.

Proposals are sent as Bloom filters of bounded size: a false yes makes more phrases count, and counts are exact. A task holds a
bounded number of words, numbers phrases locally, and passes each phrase on once per portion, packed by segments of hashes; a
segment is summed alone. However frequent a phrase is, it comes once from each portion.

Defined results: a null or empty text has no words, a null language is ``und``; rows that repeat count each; further
columns are ignored; an empty table gives no phrases.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm import bloom
from tallyboard.llm.common import chunked, col, rows_of, sequence_hashes
from tallyboard.scratch import stage

#: Words that a task holds before it counts and passes on.
HELD = 300_000
#: Bytes of a text that are cut into words at a time, up to the end of a piece.
SLICE = 1 << 20
#: Pieces end at these; words end at space and tab; A-Z are lower-cased. All in one table of bytes.
#: The end of a piece becomes a byte that no text in UTF-8 has, so what is left of white space only parts words.
_END = b"\xff"
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", _END * 10 + b" abcdefghijklmnopqrstuvwxyz")

#: Phrases that are put together at a time.
STEP = 1 << 16
#: Segments of hashes, at least, and words for each beyond that: a segment is summed in one go and stays small.
SEGMENTS, SEGMENT_WORDS = 64, 2_000_000

_SCHEMA = pa.schema([
    ("lang", pa.string()), ("size", pa.int32()), ("segment", pa.int32()), ("texts", pa.binary()), ("lengths", pa.binary()), ("numbers", pa.binary()),
])
_COLUMNS = "lang string, size int, segment int, texts binary, lengths binary, numbers binary"


def word_hashes(lang: str, words: Sequence[bytes]) -> np.ndarray:
    hashed = partial(xxhash.xxh3_64_intdigest, seed=xxhash.xxh3_64_intdigest(lang.encode()))
    return np.fromiter(map(hashed, words), np.uint64, len(words))


def slices(data: bytes) -> Iterator[bytes]:
    """Cuts of about SLICE bytes, only where a piece ends."""
    at = 0
    while len(data) - at > SLICE:
        end = data.find(_END, at + SLICE)
        if end < 0:
            break
        yield data[at : end + 1]
        at = end + 1
    yield data[at:]


class Portion:
    """Numbered words of some texts of one language; 0 stands between pieces."""

    def __init__(self, lang: str):
        self.lang = lang
        # In order of the numbers, as a dict keeps what came first in front.
        self.numbers: defaultdict[bytes, int] = defaultdict(count(1).__next__, {_END: 0})
        self.parts: list[np.ndarray] = []

    def add(self, data: bytes) -> int:
        found = data.replace(_END, b" \xff ").split()
        found.append(_END)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found)))
        return len(found)

    def phrases(self, filters: list[list[np.ndarray]], most: int, hashes: np.ndarray) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
        """(size, columns of word numbers, counts) of what the pass with the last of ``filters`` counts.

        Bit k of a phrase's mask says that filter k, and the masks of both its parts, have it. A phrase is counted by the first
        pass whose bit both parts have, so no pass counts it again. Without filters everything up to ``most`` words counts.
        """
        ids = np.concatenate(self.parts)
        numbers = np.bincount(ids, minlength=len(self.numbers))
        words = np.flatnonzero(numbers[1:]) + 1
        if len(filters) < 2:
            yield 1, [words], numbers[words]
        own = np.int64(1) << max(0, len(filters) - 1)

        def mask(level: int, hashed: np.ndarray) -> np.ndarray:
            if not filters:
                return np.ones(len(hashed), np.int64)
            out = np.zeros(len(hashed), np.int64)
            for k, held in enumerate(filters):
                out |= bloom.holds(held[level], hashed).astype(np.int64) << k
            return out

        of_word = mask(0, sequence_hashes(hashes, 1))
        of_word[0] = 0
        place, key = np.arange(len(ids)), ids  # where phrases of the size at hand start, and their local numbers
        held = of_word[ids]
        for size in range(2, most + 1):
            # Phrases one word shorter that start at consecutive places.
            both = np.flatnonzero(np.diff(place) == 1)
            shared = held[both] & held[both + 1]
            both, shared = both[(shared & own) > 0], shared[(shared & own) > 0]
            start = place[both]
            pairs = key[both] * len(hashes) + ids[start + size - 1]
            _, first, local, numbers = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
            fresh = np.flatnonzero((shared[first] & -shared[first]) == own)
            at = start[first]
            yield size, [ids[at[fresh] + k] for k in range(size)], numbers[fresh]
            if size == most:
                return
            hashed = np.zeros(len(at), np.uint64)
            for n in range(0, len(at), STEP):
                some = at[n : n + STEP]
                hashed[n : n + STEP] = _phrase_hashes([hashes[ids[some + k]] for k in range(size)])
            known = mask(size - 1, hashed) & shared[first]
            place, key, held = start, local, known[local]

    def rows(self, filters: list[list[np.ndarray]], most: int, segments: int) -> Iterator[tuple]:
        """The counted phrases of each segment of hashes, as one run of bytes with their lengths and counts."""
        names = list(self.numbers)
        hashes = word_hashes(self.lang, names)
        texts = pa.array(names, pa.binary())
        total = sum(int((p != 0).sum()) for p in self.parts)
        if len(filters) < 2 and total:
            yield self.lang, 0, 0, b"", np.zeros(1, "<i4").tobytes(), np.array([total], "<i8").tobytes()
        for size, words, numbers in self.phrases(filters, most, hashes):
            segment = np.empty(len(numbers), np.uint16 if segments <= 1 << 16 else np.int64)  # short ones sort faster
            for at in range(0, len(numbers), STEP):
                segment[at : at + STEP] = _phrase_hashes([hashes[w[at : at + STEP]] for w in words]) % np.uint64(segments)
            order = np.argsort(segment, kind="stable")
            for at in range(0, len(order), STEP):
                some = order[at : at + STEP]
                parts = [texts.take(pa.array(w[some])) for w in words]
                joined = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, b" ")
                ends = np.frombuffer(joined.buffers()[1], "<i4", len(joined) + 1, 4 * joined.offset)
                raw = joined.buffers()[2]
                cuts = [0, *(np.flatnonzero(segment[some][1:] != segment[some][:-1]) + 1).tolist(), len(some)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    yield (
                        self.lang, size, int(segment[some[a]]), raw[int(ends[a]) : int(ends[b])].to_pybytes(),
                        np.diff(ends[a : b + 1]).tobytes(), numbers[some[a:b]].astype("<i8").tobytes(),
                    )


def _phrase_hashes(words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from the hashes of their words, as ``sequence_hashes`` gives them."""
    n = len(words)
    return sequence_hashes(np.stack(words, axis=1).ravel(), n)[::n] if len(words[0]) else np.empty(0, np.uint64)


def _pass(sent, most: int, segments: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        filters = sent.value
        held: dict[str, Portion] = {}
        number = 0
        for lang, text in rows_of((b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)), "lang", "text"):
            for data in slices(text.encode().translate(_TABLE)) if text else ():
                if lang not in held:
                    held[lang] = Portion(lang)
                number += held[lang].add(data)
                if number >= HELD:
                    for portion in held.values():
                        yield from portion.rows(filters, most, segments)
                    held, number = {}, 0
        for portion in held.values():
            yield from portion.rows(filters, most, segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from chunked(rows(batches), _SCHEMA, max_bytes=4 << 20)

    return run


def _summed(least: int):
    """The phrases of a segment with at least so many occurrences."""

    def run(key, part):
        texts = b"".join(part.column("texts").to_pylist())
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(part.column("lengths").to_pylist()), "<i4"), dtype="<i8")])
        phrases = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.tobytes()), pa.py_buffer(texts))
        numbers = np.frombuffer(b"".join(part.column("numbers").to_pylist()), "<i8")
        found = pa.table({"phrase": phrases, "n": numbers}).group_by("phrase").aggregate([("n", "sum")])
        if key[1].as_py():
            found = found.filter(pc.greater_equal(found.column("n_sum"), least))
        n = found.num_rows
        return pa.table({
            "lang": pa.array([key[0].as_py()] * n, pa.string()), "size": pa.array([key[1].as_py()] * n, pa.int32()),
            "phrase": found.column("phrase").cast(pa.string()), "n": found.column("n_sum"),
        })

    return run


def _hashed(batch: pa.RecordBatch) -> np.ndarray:
    out = np.zeros(batch.num_rows, np.uint64)
    for k, (lang, phrase) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)):
        words = phrase.encode().split(b" ")
        out[k] = sequence_hashes(word_hashes(lang, words), len(words))[0]
    return out


def _filters(proposed: DataFrame, most: int) -> list[np.ndarray]:
    """One filter for each size below ``most``."""
    numbers = {r["size"]: r["count"] for r in proposed.groupBy("size").count().collect()}
    return [
        bloom.build(proposed.where(F.col("size") == size).select("lang", "phrase"), numbers.get(size, 0), _hashed)
        for size in range(1, most)
    ]


def frequent_phrases(
    docs: DataFrame, text_column: str = "text", lang_column: str | None = "lang", most: int = 3, min_count: int = 10,
    share: float = 1 / 16,
) -> DataFrame:
    """``lang, size, phrase, n``: exact counts of all words and phrases of up to ``most`` words found ``min_count`` times.

    Everything is counted for each language. The row of size 0 holds the number of all words. ``share`` of the documents are the sample.
    """
    if not 2 <= most <= 60:
        raise ValueError("phrases have 2 to 60 words")
    context = docs.sparkSession.sparkContext
    lang = F.lit("und") if lang_column is None else F.coalesce(col(lang_column).cast("string"), F.lit("und"))
    source = docs.select(lang.alias("lang"), col(text_column).alias("text"))

    def counted(texts: DataFrame, filters: list, size: int, least: int, segments: int = SEGMENTS) -> DataFrame:
        rows = texts.mapInArrow(_pass(context.broadcast(filters), size, segments), _COLUMNS)
        return rows.groupBy("lang", "size", "segment").applyInArrow(_summed(least), "lang string, size int, phrase string, n long")

    slots = max(1, round(1 / share))
    lowered = max(2, int(0.75 * share * min_count))
    sample = source.where(F.pmod(F.xxhash64("text"), F.lit(slots)) == 0)
    proposed = stage(counted(sample, [], most - 1, lowered), "proposed")
    words = proposed.where("size = 0").agg(F.sum("n")).first()[0] or 0
    segments = max(SEGMENTS, slots * words // SEGMENT_WORDS)
    proposed = proposed.where("size > 0")
    filters = [_filters(proposed, most)]
    known = stage(counted(source, filters, most, min_count, segments), "counted")
    key = ["lang", "size", "phrase"]
    while True:
        parts = known.where((F.col("size") > 0) & (F.col("size") < most))
        if parts.join(proposed.select(*key), key, "left_anti").isEmpty():
            return known
        proposed = parts
        filters.append(_filters(proposed, most))
        known = stage(known.union(stage(counted(source, filters, most, min_count, segments), "counted")), "counted")


def collocations(counted: DataFrame, top: int | None = 2000, inside_percent: int = 50) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` from the counts of :func:`frequent_phrases`; ``top`` of each language (None: all).

    Numbers have up to 12 digits; products are decimals, so nothing is rounded.
    """
    exact = lambda c: F.col(c).cast("decimal(12,0)")
    words = F.split("phrase", " ", -1)
    phrases = counted.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size", words.alias("w"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    parts = counted.where("size > 0").select("lang", "phrase", "n")
    cuts = cuts.join(parts.withColumnsRenamed({"phrase": "first", "n": "l"}), ["lang", "first"])
    cuts = cuts.join(parts.withColumnsRenamed({"phrase": "rest", "n": "r"}), ["lang", "rest"])
    cuts = cuts.withColumn("up", exact("a") * exact("a") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("down", exact("l") * exact("r"))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("cut"))
    # Each phrase inside a longer one, with the count of the most frequent of those.
    longer = phrases.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    around = longer.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("around"))
    kept = lowest.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < inside_percent * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    total = counted.where("size = 0").select("lang", F.col("n"))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
