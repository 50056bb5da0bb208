"""Words that are one edit from a more frequent word, found with blocked Gram matrices of letter counts.

1. Each task counts the words of its texts and passes on (word, number) in bounded portions.
2. Two words one edit apart have letter counts at a squared distance of at most two: exactly two if they are
   of one length (one letter out, another in), exactly one if their lengths are adjacent. Letters are dealt
   over a few groups, and the sums of a word's counts over the groups are its cell. An edit moves a cell by one step
   at most, so only blocks of the same or a neighbouring cell, of the same or the next length, meet.
3. A cell is cut into blocks of bounded size. For two blocks one NumPy product of their count matrices gives all squared
   distances; pairs at the right distance are verified letter by letter. A task gives one row for a word and
   pair of blocks (how many near words, and the best), never the pairs.
4. A word's form is the best of its near words; roots follow the forms by doubling steps.

No group is collected: a cell that holds a third of all words is many blocks, and the number of near words of a word is
bounded by its length and the alphabet. The driver holds the frequencies of at most 512 letters and one sum.

Defined results: a null or empty text has no words; a null id counts as an empty one in the checksum; rows that repeat
an id count each; further columns are ignored; an empty table gives no words. Ties between forms go to the smaller word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import chunked, col, rows_of
from tallyboard.scratch import stage

#: Words that a counting task holds before it passes them on.
HELD = 300_000
#: Groups of letters that make a cell.
GROUPS = 6
#: Words in a block, and letters.
BLOCK, BLOCK_LETTERS = 1024, 1 << 20
#: Products that one task computes, roughly.
TASK_PAIRS = 150_000_000
#: Pairs that are verified at a time, in letters.
VERIFY_LETTERS = 1 << 22
#: Cells are numbers below this prime; a digit of a group's sum that runs over joins cells and loses none.
_CELLS = (1 << 61) - 1
_DIGIT = 8
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # UTF-8 of a-z and U+00C0 to U+00FF


# --- words ------------------------------------------------------------------------------------------


def words_of(number: str, text: str, divisor: int | None) -> Counter:
    """Lower-cased (A-Z) runs of letters of a text. With ``divisor`` a run whose checksum it divides loses one letter."""
    found = Counter(_RUN.findall(text.encode().lower()))
    if divisor is None:
        return found
    out: Counter = Counter()
    start = zlib.crc32(f"{number}:".encode())
    for run, n in found.items():
        h = zlib.crc32(run, start)
        if h % divisor == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        out[run] += n
    return out


def _counted(divisor: int | None, min_chars: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def passed(held: Counter) -> Iterator[tuple]:
        for word, n in held.items():
            if len(word) >= min_chars and len(letters := word.decode()) >= min_chars:
                yield letters, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held: Counter = Counter()
            for number, text in rows_of(batches, "id", "text"):
                for word, n in words_of(number or "", text or "", divisor).items():
                    held[word] += n
                if len(held) >= HELD:
                    yield from passed(held)
                    held = Counter()
            yield from passed(held)

        yield from chunked(rows(), schema)

    return run


def word_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 5, min_count: int = 3,
    divisor: int | None = None,
) -> DataFrame:
    """``word, n`` of the words with enough letters and occurrences over all texts."""
    source = docs.select(col(id_column).cast("string").alias("id"), col(text_column).alias("text"))
    counted = source.mapInArrow(_counted(divisor, min_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- cells ------------------------------------------------------------------------------------------


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each code point: frequent letters are dealt so that groups are about equally frequent."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter != ''")
    found = letters.groupBy("letter").count().orderBy(F.desc("count"), "letter").limit(512).collect()
    groups = (np.arange(0x110000) % GROUPS).astype(np.int8)
    held = [0] * GROUPS
    for r in found:
        g = held.index(min(held))
        groups[ord(r.letter)] = g
        held[g] += r["count"]
    return groups


def points_of(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")


def cells_of(words: list[str], lengths: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """The cell of each word: its sums over the groups as digits of one number."""
    sums = np.empty((len(words), GROUPS), np.int64)
    place = groups[points_of(words)].astype(np.int64) + np.repeat(np.arange(len(words)) * GROUPS, lengths)
    sums[:] = np.bincount(place, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)
    cells = np.zeros(len(words), object if len(words) and lengths.max() > 1 << 20 else np.int64)
    for g in range(GROUPS):
        cells = (cells + sums[:, g].astype(cells.dtype) * (1 << _DIGIT * g)) % _CELLS
    return cells.astype(np.int64)


def _celled(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            # In portions, as a word can be as long as a text.
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(lengths) // BLOCK_LETTERS)) + 1).tolist(), len(words)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    cells = cells_of(words[a:b], lengths[a:b], sent.value)
                    part = batch.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays([pa.array(lengths[a:b]), pa.array(cells), *part.columns], ["length", "cell", "word", "n"])

    return run


def steps() -> list[tuple[int, int]]:
    """(letters more, cell difference) of each way that one edit can move a cell, one direction each."""
    digits = [1 << _DIGIT * g for g in range(GROUPS)]
    out = [(0, 0), *((1, d) for d in digits)]
    return out + [(0, (a - b) % _CELLS) for k, a in enumerate(digits) for b in digits[k + 1 :]]


# --- pairs of blocks ----------------------------------------------------------------------------------


def counted_letters(points: np.ndarray, letters: np.ndarray, kind: type) -> np.ndarray:
    place = np.searchsorted(letters, points) + np.arange(len(points))[:, None] * len(letters)
    return np.bincount(place.ravel(), minlength=len(points) * len(letters)).reshape(len(points), len(letters)).astype(kind)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether ``long`` without one letter is ``short``: their common start and common end cover it."""
    n = short.shape[1]
    start, end = short == long[:, :n], (short == long[:, 1:])[:, ::-1]
    first = np.where(start.all(1), n, start.argmin(1))
    last = np.where(end.all(1), 0, n - end.argmin(1))
    return last <= first


def near_pairs(a: list[str], b: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of two blocks that are one edit apart. Words of a block have one length, those of ``b`` at most one more."""
    if not len(a[0]):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pa_, pb = points_of(a).reshape(len(a), -1), points_of(b).reshape(len(b), -1)
    more = pb.shape[1] - pa_.shape[1]
    letters = np.union1d(pa_, pb)
    # Squares stay whole numbers in single precision up to 4095 letters.
    kind = np.float32 if pb.shape[1] < 4096 else np.float64
    x, y = counted_letters(pa_, letters, kind), counted_letters(pb, letters, kind)
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    # One product gives 2xy - xx - yy, the squared distance below zero.
    left = np.column_stack([2 * x, -xx, np.full(len(x), -1, kind)])
    right = np.column_stack([y, np.ones(len(y), kind), yy])
    i, j = np.nonzero((left @ right.T) == (-1 if more else -2))
    if same:
        i, j = i[i < j], j[i < j]
    fits = np.zeros(len(i), bool)
    step = max(1, VERIFY_LETTERS // pb.shape[1])
    for at in range(0, len(i), step):
        p, q = pa_[i[at : at + step]], pb[j[at : at + step]]
        fits[at : at + step] = one_inserted(p, q) if more else one_replaced(p, q)
    return i[fits], j[fits]


def best_of(words: list[str], place: np.ndarray, other: np.ndarray, others: list[str], numbers: list[int]) -> Iterator[tuple]:
    """For each word with near words: how many, the largest number of occurrences, and whose it is."""
    order = np.empty(len(others), np.int64)
    order[sorted(range(len(others)), key=others.__getitem__)] = np.arange(len(others))
    rank = np.lexsort((order[other], -np.asarray(numbers, np.int64)[other], place))
    place, other = place[rank], other[rank]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    for at, n in zip(first.tolist(), np.diff(first, append=len(place)).tolist(), strict=True):
        k = int(other[at])
        yield words[place[at]], n, numbers[k], others[k]


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for a, an, b, bn in rows_of(batches, "low", "low_n", "high", "high_n"):
            same = b is None
            i, j = near_pairs(a, a if same else b, same)
            if not len(i):
                continue
            if same:
                yield from best_of(a, np.concatenate([i, j]), np.concatenate([j, i]), a, an)
            else:
                yield from best_of(a, i, j, b, bn)
                yield from best_of(b, j, i, a, an)

    yield from chunked(rows(), NEAR)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` of the words that have a word one edit away; ``form`` is the most frequent of those.

    ``words`` holds distinct ``word`` and ``n``, as written.
    """
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(letter_groups(words))
    cells = stage(words.mapInArrow(_celled(sent), "length long, cell long, word string, n long"), "cells")
    per = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_LETTERS) / F.greatest("length", F.lit(1)))))
    sizes = cells.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("m"))
    sizes = stage(sizes.withColumn("blocks", F.ceil(F.col("m") / per).cast("int")), "cell-sizes")
    dealt = cells.join(sizes.select("length", "cell", "blocks"), ["length", "cell"])
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    blocks = dealt.groupBy("length", "cell", block.alias("block")).agg(F.collect_list(F.struct("word", "n")).alias("rows"))
    blocks = stage(blocks.select("length", "cell", "block", F.col("rows.word").alias("words"), F.col("rows.n").alias("numbers")), "blocks")

    moves = F.array(*[F.struct(F.lit(more).alias("more"), F.lit(d).cast("long").alias("d")) for more, d in steps()])
    moved = sizes.select("length", "cell", "m", "blocks", F.explode(moves).alias("by"))
    moved = moved.select(
        "length", "cell", F.col("m").alias("low_m"), F.col("blocks").alias("low_blocks"), (F.col("length") + F.col("by.more")).alias("length2"),
        F.pmod(F.col("cell") + F.col("by.d"), F.lit(_CELLS)).alias("cell2"),
    )
    other = sizes.select(F.col("length").alias("length2"), F.col("cell").alias("cell2"), "m", "blocks")
    met = stage(moved.join(other, ["length2", "cell2"]), "cell-pairs")
    work = met.agg(F.sum(F.col("low_m").cast("double") * F.col("m"))).first()[0] or 0
    itself = (F.col("length") == F.col("length2")) & (F.col("cell") == F.col("cell2"))
    pairs = met.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("low_blocks") - 1)))
    pairs = pairs.withColumn("block2", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.where(~itself | (F.col("block") <= F.col("block2"))).withColumn("alone", itself & (F.col("block") == F.col("block2")))
    low = blocks.withColumnsRenamed({"words": "low", "numbers": "low_n"})
    high = blocks.select(F.col("length").alias("length2"), F.col("cell").alias("cell2"), F.col("block").alias("block2"), "words", "numbers")
    key = ["length", "cell", "block", "length2", "cell2", "block2"]
    filled = pairs.select(*key, "alone").join(low, key[:3]).join(high, key[3:]).select(
        *key, "low", "low_n", F.when(~F.col("alone"), F.col("words")).alias("high"), F.when(~F.col("alone"), F.col("numbers")).alias("high_n")
    )
    # As many tasks as the products need; the tables alone are too small to tell.
    tasks = max(spark.sparkContext.defaultParallelism, int(work / TASK_PAIRS) + 1)
    found = filled.repartition(tasks, *key).select("low", "low_n", "high", "high_n").mapInArrow(_near, "word string, n_near long, form_n long, form string")
    best = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))).alias("best")
    )
    return best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows (word, form): the last form on the way from form to form. Each round doubles the steps taken."""
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = stage(at.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n, root``: a word's form is its near word with most occurrences, if these are ``factor`` times its own."""
    if factor < 2:
        raise ValueError("forms could go round in circles if they need not be more frequent")
    words = stage(words.select("word", "n"), "words")
    held = words.join(near_words(words), "word", "left")
    more = F.col("form_n") >= factor * F.col("n")
    held = stage(held.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(more, F.col("form")).alias("form"), F.when(more, F.col("form_n")).alias("form_n")
    ), "forms")
    last = roots(held.where("form IS NOT NULL"))
    return held.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
