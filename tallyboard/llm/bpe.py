"""Byte-level BPE with a lexicon of frequent words in a minimal acyclic transducer.

1. Words (the pieces that merging never crosses) are counted over all documents; the ``lexicon_words``
   most frequent are kept, a fixed number.
2. They are compiled into a minimal acyclic automaton whose states share suffixes. Each arc carries a
   number; their sum along a word is its place in a table of id lists (the transducer's output).
3. The file goes to every worker process once, which maps it into memory. Each batch looks up its words
   there, all at once; words that it lacks are merged exactly. A bounded memo keeps what was found.

Defined results: null text has no ids and decodes to an empty text; rows are encoded one by one, so
repeated or null ids do no harm; a special token's text gives its id, as in the tokenizers library.
"""

from __future__ import annotations

import struct
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm import tokens
from tallyboard.llm.common import chunked, col, without
from tallyboard.scratch import stage

LEXICON_WORDS = 1 << 16
#: Words held by a counting task, and by a worker's memo, before they are passed on or dropped.
HELD = 400_000
#: Longer words are merged each time; none of them is frequent.
LONGEST = 64
ADDED = ("ids", "decoded")


# --- the transducer -----------------------------------------------------------------------------


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The automaton's file for words with their ids; words in ascending order, each once.

    States are made word by word. What the next word no longer shares is frozen: a state equal to a frozen
    one (same end mark, same arcs) is replaced by it, so suffixes are shared.
    """
    frozen: dict[tuple, int] = {}
    arcs_of: list[tuple] = []
    count_of: list[int] = []
    ends: list[bool] = []
    path: list[list] = [[False, []]]  # open states along the last word: end mark, arcs (byte, frozen state)
    last, table, bounds = b"", [], [0]

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            end, arcs = path.pop()
            key = (end, tuple(arcs))
            if key not in frozen:
                frozen[key] = len(arcs_of)
                arcs_of.append(key[1])
                ends.append(end)
                count_of.append(int(end) + sum(count_of[to] for _, to in arcs))
            path[-1][1][-1] = (path[-1][1][-1][0], frozen[key])

    for word, ids in entries:
        if word <= last and bounds != [0]:
            raise ValueError("words must be ascending and distinct")
        shared = 0
        while shared < min(len(last), len(word)) and last[shared] == word[shared]:
            shared += 1
        freeze(shared)
        for b in word[shared:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
        table += ids
        bounds.append(len(table))
    freeze(0)
    root = len(arcs_of)
    arcs_of.append(tuple(path[0][1]))
    ends.append(path[0][0])

    keys, targets, numbers = [], [], []
    for state, arcs in enumerate(arcs_of):
        before = int(ends[state])  # words that end here come first in order
        for b, to in arcs:
            keys.append(state << 8 | b)
            targets.append(to)
            numbers.append(before)
            before += count_of[to]
    parts = [
        np.array(keys, "<i8"), np.array(targets, "<i8"), np.array(numbers, "<i8"),
        np.array(ends, "<i8"), np.array(bounds, "<i8"), np.array(table, "<i4"),
    ]
    return struct.pack("<7q", root, *map(len, parts)) + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled automaton in mapped memory."""

    def __init__(self, packed: bytes):
        with tempfile.TemporaryFile() as f:  # has no name, so nothing is left behind
            f.write(packed)
            f.flush()
            held = np.asarray(np.memmap(f, np.uint8, "r"))
        self.root, *sizes = struct.unpack("<7q", held[:56].tobytes())
        parts, at = [], 56
        for n, kind in zip(sizes, ("<i8", "<i8", "<i8", "<i8", "<i8", "<i4"), strict=True):
            parts.append(held[at : at + n * int(kind[2])].view(kind))
            at += n * int(kind[2])
        self.keys, self.targets, self.numbers, self.ends, self.bounds, self.table = parts

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the table, -1 for words that are not in the lexicon; one step for all at a time."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        state, place = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        alive = np.arange(len(words)) if len(self.keys) else np.empty(0, np.int64)
        place[lengths == 0] = -1
        if not len(self.keys):
            return np.full(len(words), -1)
        for k in range(int(lengths.max(initial=0))):
            alive = alive[lengths[alive] > k]
            keys = state[alive] << 8 | data[starts[alive] + k]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = self.keys[at] == keys
            place[alive[~found]] = -1
            alive, at = alive[found], at[found]
            place[alive] += self.numbers[at]
            state[alive] = self.targets[at]
        place[(place >= 0) & (self.ends[state] == 0)] = -1
        return place

    def ids(self, place: int) -> bytes:
        """Little-endian 32-bit numbers."""
        return self.table[self.bounds[place] : self.bounds[place + 1]].tobytes()


# --- encoding -----------------------------------------------------------------------------------


def pieces(words: tokens.Vocabulary, text: str) -> list[str]:
    """The text cut where the library cuts it; a special token is a piece of its own."""
    if words.plain(text):
        return tokens.PLAIN_WORDS.findall(text)
    out = []
    for part in words.split_special(text):
        if part in words.special:
            out.append(part)
        elif part:
            out += [part[a:b] for _, (a, b) in words.library.pre_tokenizer.pre_tokenize_str(part)]
    return out


def _count(path: str):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.vocabulary(path)

        def rows():
            seen: Counter[str] = Counter()
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    if text:
                        seen.update(pieces(words, text))
                        if len(seen) >= HELD:
                            yield from seen.items()
                            seen.clear()
            yield from seen.items()

        yield from chunked(((w, n) for w, n in rows() if len(w) <= LONGEST and w not in words.special), schema, 100_000)

    return run


class Encoder:
    def __init__(self, words: tokens.Vocabulary, lexicon: Lexicon):
        self.words, self.lexicon = words, lexicon
        self.memo: dict[str, bytes] = {}

    def learn(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of words that the memo lacks: from the lexicon, else by exact merging."""
        new = list(wanted)
        coded = [w.encode() for w in new]
        found, special, merge = {}, self.words.special, self.words.merge
        for w, b, place in zip(new, coded, self.lexicon.places(coded).tolist(), strict=True):
            if place >= 0:
                found[w] = self.lexicon.ids(place)
            elif w in special:
                found[w] = struct.pack("<i", special[w])
            else:
                ids = merge(b)
                found[w] = struct.pack(f"<{len(ids)}i", *ids)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        cut = [pieces(self.words, t) if t else [] for t in texts]
        get = self.memo.get
        coded = [list(map(get, c)) for c in cut]
        lacking = [k for k, c in enumerate(coded) if None in c]
        if lacking:
            wanted = {w for k in lacking for w, x in zip(cut[k], coded[k], strict=True) if x is None}
            if len(self.memo) + len(wanted) > HELD:
                self.memo.clear()
                wanted = set(chain.from_iterable(cut[k] for k in lacking))
            self.memo.update(self.learn(wanted))
            for k in lacking:
                coded[k] = map(get, cut[k])
        return list(map(b"".join, coded))


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(path: str, packed: bytes) -> Encoder:
    """One for each worker process and lexicon."""
    key = (path, hash(packed))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokens.vocabulary(path), Lexicon(packed))
    return _ENCODERS[key]


def decode(flat: np.ndarray, bounds: np.ndarray, letters: np.ndarray, starts: np.ndarray) -> list[str]:
    """The texts of id lists: ``bounds`` cut ``flat``; ``starts`` cut ``letters`` into the bytes of each id."""
    sizes = starts[flat + 1] - starts[flat]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    data = letters[np.arange(ends[-1]) + np.repeat(starts[flat] - ends[:-1], sizes)].tobytes()
    cuts = ends[bounds].tolist()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]


def _code(path: str, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, sent.value)
        bytes_of = encoder.words.bytes_of
        letters = np.frombuffer(b"".join(bytes_of), np.uint8)
        starts = np.concatenate(([0], np.cumsum(list(map(len, bytes_of)))))
        for whole in batches:
            at = whole.num_columns - 1
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                ids = encoder.encode(batch.column(at).to_pylist())
                bounds = np.concatenate(([0], np.cumsum(list(map(len, ids))))) // 4
                flat = np.frombuffer(b"".join(ids), "<i4")
                columns = [batch.column(k) for k in range(at)]
                columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)))
                columns.append(pa.array(decode(flat, bounds, letters, starts), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *ADDED])

    return run


def build_lexicon(texts: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> bytes:
    """The automaton of the most frequent words of column ``text``: as many whole frequencies as give at most ``lexicon_words``.

    Only those words, and how many words each frequency has, come to the driver.
    """
    counts = stage(texts.mapInArrow(_count(path), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    order = Window.orderBy(F.col("n").desc())
    # One row a frequency: few, as a table of m words has at most the square root of 2 m frequencies.
    enough = sizes.withColumn("so_far", F.sum("words").over(order)).where(F.col("so_far") <= lexicon_words)
    least = enough.agg(F.min("n")).first()[0]
    words = tokens.vocabulary(path)
    top = counts.where(F.col("n") >= least).select("word").collect() if least is not None else []
    coded = sorted(r.word.encode() for r in top)
    return compile_lexicon((w, words.merge(w)) for w in coded)


def encode(
    docs: DataFrame, text_column: str = "text", keep: list[str] | None = None,
    tokenizer: str | None = None, lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``ids`` (array of int) and ``decoded``, the text of these ids."""
    path = tokenizer or tokens.default_path()
    text = col(text_column).alias("text")
    packed = build_lexicon(docs.select(text), path, lexicon_words)
    sent = docs.sparkSession.sparkContext.broadcast(packed)
    kept = without(docs.select(*[col(c) for c in (docs.columns if keep is None else keep)]), ADDED).columns
    source = docs.select(*[col(c) for c in kept], col(text_column).alias("__tb_text"))
    out = source.drop("__tb_text").withColumns({"ids": F.lit(None).cast("array<int>"), "decoded": F.lit(None).cast("string")}).schema
    return source.mapInArrow(_code(path, sent), out)
