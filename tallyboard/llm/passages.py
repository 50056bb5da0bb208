"""Passages that recur across documents, located with sharded Aho-Corasick automata and removed.

A passage is a window of so many consecutive words that also starts in a document with a smaller id.

1. Documents with the same words form a class; all but the smallest id lose everything (if they have a window).
2. From every window a phrase of half its length is picked, the one with the smallest hash. Equal windows
   pick the same phrase, so a phrase that only one document picks is in no repeated window.
   The others recur: their texts are taken from their smallest document.
3. Documents that hold a recurring phrase are dealt into shards of bounded size by id. Each shard compiles
   its phrases into an automaton over words and streams its documents through it, which confirms phrases
   word for word and finds every place of each.
4. Windows around these places are compared over all documents by 96-bit hashes; a window whose smallest
   document is another one removes its words.

Other documents need no automaton: by step 2 they hold no repeated window.

Defined results: a null text has no words; kept words are joined by one space, so white space is
normalised everywhere; a row with a null id loses nothing and counts for none; rows that repeat an id are
judged by their own text, and no row counts against another with the same id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import chunked, col, rolling_hashes, rows_of, without
from tallyboard.scratch import stage

#: Characters of the documents that one automaton serves.
SHARD_CHARS = 4_000_000
#: Up to so many ids of documents with recurring phrases (8 MB) are broadcast; more are joined by a shuffle.
SENT_IDS = 1_000_000
ADDED = ("n_words", "n_removed")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mark_of(words: list[bytes]) -> int:
    """32 bits that tell texts of one id apart."""
    return int(np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), "<i4")[0])


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest value in each run of ``size``, from minima towards both ends of blocks."""
    m = len(values) - size + 1
    if m <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // size) * size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, size)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:m], left[size - 1 : size - 1 + m])


def phrases_of(hashed: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the phrase at each place."""
    return rolling_hashes(hashed, window // 2, 1)


def picked(hashed: np.ndarray, window: int) -> np.ndarray:
    if len(hashed) < window:
        return np.empty(0, np.uint64)
    return np.unique(window_minima(phrases_of(hashed, window), window - window // 2 + 1))


def _describe(window: int):
    schema = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("mark", pa.int32()), ("n", pa.int64()), ("phrases", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for key, text in rows_of(batches, "id", "text"):
                words = words_of(text)
                if key is not None and len(words) >= window:
                    digest = xxhash.xxh3_128_digest(b" ".join(words))
                    yield key, digest, mark_of(words), len(words), picked(hashes_of(words), window).view(np.int64)

        yield from chunked(rows(), schema)

    return run


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text is the one that was described under this id."""
    for batch in batches:
        fits = [mark_of(words_of(t)) == m for t, m in rows_of([batch], "text", "mark")]
        yield batch.filter(pa.array(fits, pa.bool_()))


def _phrase_texts(window: int):
    schema = pa.schema([("phrase", pa.int64()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for text, owned in rows_of(batches, "text", "owned"):
                if owned:
                    words = words_of(text)
                    found, places = np.unique(phrases_of(hashes_of(words), window).view(np.int64), return_index=True)
                    for phrase, place in zip(owned, places[np.searchsorted(found, owned)].tolist(), strict=True):
                        yield phrase, b" ".join(words[place : place + window // 2]).decode()

        yield from chunked(rows(), schema)

    return run


def symbols(numbers: np.ndarray) -> tuple[int, ...]:
    """Two letters a word, from two ranges: states of the automaton have few arcs, and no match starts within a word."""
    out = np.zeros(2 * len(numbers), np.int64)
    known = numbers > 0
    out[0::2][known] = 1 + (numbers[known] >> 10)
    out[1::2][known] = (1 << 30) + (numbers[known] & 1023)
    return tuple(out.tolist())


class Automaton:
    """Finds the places of phrases (lists of words, all equally long) in a list of words."""

    def __init__(self, phrases: list[list[bytes]]):
        self.numbers: dict[bytes, int] = {}
        self.size = len(phrases[0]) if phrases else 0
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, phrase in enumerate(phrases):
            coded = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in phrase]
            self.machine.add_word(symbols(np.array(coded)), k + 1)
        if phrases:
            self.machine.make_automaton()

    def places(self, words: list[bytes]) -> np.ndarray:
        if not self.size or len(words) < self.size:
            return np.empty(0, np.int64)
        get = self.numbers.get
        coded = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        ends = np.array([end for end, _ in self.machine.iter(symbols(coded))], np.int64)
        return ends // 2 - self.size + 1


def windows_at(places: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Starts of the windows that hold a phrase at one of the places."""
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, np.maximum(places + window // 2 - window, 0), 1)
    np.add.at(edges, places + 1, -1)
    return np.flatnonzero(np.cumsum(edges)[: n_words - window + 1] > 0)


def _locate(window: int):
    def run(key, documents, phrases):
        machine = Automaton([p.encode().split() for p in phrases.column("words").to_pylist()])
        parts = {"a": [], "b": [], "id": [], "mark": [], "place": []}
        for i, mark, text in zip(*(documents.column(c) for c in ("id", "mark", "text")), strict=True):
            words = words_of(text.as_py())
            starts = windows_at(machine.places(words), len(words), window)
            if len(starts):
                hashed = hashes_of(words)
                parts["a"].append(rolling_hashes(hashed, window, 2)[starts].view(np.int64))
                parts["b"].append((rolling_hashes(hashed, window, 3)[starts] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                parts["id"].append(np.full(len(starts), i.as_py(), np.int64))
                parts["mark"].append(np.full(len(starts), mark.as_py(), np.int32))
                parts["place"].append(starts.astype(np.int32))
        kinds = dict.fromkeys(("b", "mark", "place"), np.int32)
        return pa.table({c: np.concatenate(v) if v else np.empty(0, kinds.get(c, np.int64)) for c, v in parts.items()})

    return run


def repeated_windows(source: DataFrame, described: DataFrame, window: int) -> DataFrame:
    """(id, mark, starts) of the windows to remove; ``described`` has one row for each class."""
    every = described.select("id", "mark", F.explode("phrases").alias("phrase"))
    recurring = every.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "mark")).alias("owner")).where("n > 1")
    held = stage(every.join(recurring.select("phrase", "owner"), "phrase"), "phrases")
    mine = F.struct("id", "mark") == F.col("owner")
    wanted = held.groupBy("id", "mark").agg(F.collect_list(F.when(mine, F.col("phrase"))).alias("owned"))
    ids = held.select("id").distinct()
    if ids.count() <= SENT_IDS:
        # Few enough to be sent to every task, so other documents are not shuffled here.
        source = source.join(F.broadcast(ids), "id", "left_semi")
    schema = "id long, text string, mark int, owned array<long>"
    texts = stage(source.join(wanted, "id").select("id", "text", "mark", "owned").mapInArrow(_own_text, schema), "texts")

    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(size / SHARD_CHARS)))).cast("int").alias("shard")
    written = texts.mapInArrow(_phrase_texts(window), "phrase long, words string").dropDuplicates(["phrase"])
    needed = held.select("phrase", shard).distinct().join(written, "phrase").select("shard", "words")
    found = texts.select("id", "mark", "text", shard).groupBy("shard").cogroup(needed.groupBy("shard")).applyInArrow(
        _locate(window), "a long, b int, id long, mark int, place int"
    )
    found = stage(found, "windows")
    repeated = found.groupBy("a", "b").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    later = found.join(repeated.select("a", "b", "first"), ["a", "b"]).where("id > first")
    return later.groupBy("id", "mark").agg(F.collect_list("place").alias("starts"))


def _remove(text_at: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers, removed = [], [], []
            last = batch.num_columns - 1
            for text, judged in zip(batch.column(text_at), batch.column(last).to_pylist(), strict=True):
                words = words_of(text.as_py())
                numbers.append(len(words))
                if judged:
                    mark = mark_of(words)
                    for j in judged:
                        if j["mark"] == mark:
                            words = cut(words, j["starts"], window)
                            break
                removed.append(numbers[-1] - len(words))
                texts.append(b" ".join(words).decode())
            columns = batch.columns[:last]
            columns[text_at] = pa.array(texts, pa.string())
            columns += [pa.array(numbers, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *ADDED])

    return run


def cut(words: list[bytes], starts: list[int] | None, window: int) -> list[bytes]:
    """The words outside the windows that start there; None: all windows."""
    if starts is None:
        return [] if len(words) >= window else words
    edges = np.zeros(len(words) + 1, np.int64)
    edges[np.unique(starts)] += 1
    np.add.at(edges, np.unique(starts) + window, -1)
    kept = np.cumsum(edges)[:-1] == 0
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


def drop_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 50) -> DataFrame:
    """``docs`` with repeated passages removed from the text, and ``n_words`` (before) and ``n_removed``."""
    docs = without(docs, ADDED)
    source = docs.select(col(id_column).cast("long").alias("id"), col(text_column).alias("text"))
    kinds = "id long, digest binary, mark int, n long, phrases array<long>"
    described = stage(source.mapInArrow(_describe(window), kinds), "words")
    classes = described.groupBy("digest", "n").agg(F.min("id").alias("first"))
    placed = described.join(classes, ["digest", "n"])
    one_each = placed.where("id = first").dropDuplicates(["digest", "n"]).select("id", "mark", "phrases")
    copies = placed.where("id > first").select("id", "mark", F.lit(None).cast("array<int>").alias("starts"))
    judged = repeated_windows(source, stage(one_each, "classes"), window).union(copies).distinct()
    judged = judged.groupBy(F.col("id").alias("__tb_id")).agg(F.collect_list(F.struct("mark", "starts")).alias("__tb_judged"))
    joined = docs.join(judged, col(id_column).cast("long") == F.col("__tb_id"), "left").drop("__tb_id")
    out = docs.withColumns({c: F.lit(0).cast("long") for c in ADDED}).schema
    return joined.mapInArrow(_remove(docs.columns.index(text_column), window), out)
