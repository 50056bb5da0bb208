"""Quality classifier: hashed word n-grams, logistic regression learnt by follow-the-regularised-leader.

Words are runs of letters and digits, or runs of other signs; their 1- and 2-grams are hashed into a
fixed number of weights. A word that repeats the one before it also counts as the gram "same again",
whatever the word. A document's features are damped counts of equal total length, so a long text
weighs no more than a short one. Scores are sparse dot products through the logistic function.

Learning takes at most ``most`` labelled rows, those with the smallest hash of their id: a fixed bound, which
also bounds the one task that learns. That task gets no texts: grams are counted where the texts are read, and it
holds the counts packed, unpacking one document at a time. Scoring is one pass over whole texts without a shuffle; it sends every
task the weights, a fixed size too.

Defined results: a null or empty text has the bias as its only feature; a document with several
labels takes the largest, null labels are ignored; without any labelled row all scores are 0.5; repeated
rows are scored each; a caller's column named like an added one is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm.common import chunked, col, rows_of, sequence_hashes, without

WORD = re.compile(r"\w+|[^\w\s]+")
ADDED = ("score",)
AGAIN = np.uint64(xxhash.xxh3_64_intdigest(b"same again"))


@dataclass(frozen=True)
class Settings:
    #: Weights are 2 to this power, and one for the bias.
    bits: int = 18
    ngrams: int = 2
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.002
    rounds: int = 3
    most: int = 10_000


def grams(text: str | None, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places of the weights, ascending, and how often their grams are found."""
    words = [w.encode() for w in WORD.findall(text or "")]
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    again = np.full(int((hashed[1:] == hashed[:-1]).sum()), AGAIN)
    found = np.concatenate([again, *(sequence_hashes(hashed, n) for n in range(1, settings.ngrams + 1))])
    return np.unique(found >> np.uint64(64 - settings.bits), return_counts=True)


def valued(places: np.ndarray, number: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and the values there; the bias is last."""
    values = np.log1p(number)
    if len(values):
        values /= np.sqrt((values**2).sum())
    return np.append(places.astype(np.int64), 1 << settings.bits), np.append(values, 0.3)


def features(text: str | None, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    return valued(*grams(text, settings), settings)


def packed(text: str | None, settings: Settings) -> bytes:
    """The grams of a text in a byte or two each: steps from place to place, then the numbers."""
    places, number = grams(text, settings)
    return zlib.compress(np.concatenate([np.diff(places.astype("<i4"), prepend=np.int32(0)), number.astype("<i4")]).astype("<i4").tobytes(), 1)


def unpacked(held: bytes, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    steps, number = np.frombuffer(zlib.decompress(held), "<i4").reshape(2, -1).astype(np.int64)
    return valued(np.cumsum(steps), number, settings)


class Leader:
    """Follow the regularised leader, each coordinate with its own rate."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.z, self.n = np.zeros((1 << settings.bits) + 1), np.zeros((1 << settings.bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.s
        return np.where(np.abs(z) <= s.l1, 0.0, (np.sign(z) * s.l1 - z) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(places)
        gradient = (logistic(w @ values) - label) * values
        n = self.n[places]
        grown = n + gradient**2
        self.z[places] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.s.alpha * w
        self.n[places] = grown


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def _packed(settings: Settings):
    schema = pa.schema([("id", pa.int64()), ("place", pa.int32()), ("label", pa.int32()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from chunked(
            (
                (i, place, label, packed(text.as_py(), settings)) for batch in batches
                for i, place, label, text in zip(*(batch.column(n).to_pylist() for n in ("id", "place", "label")), batch.column("text"), strict=True)
            ),
            schema,
        )

    return run


def _learn(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = list(rows_of(batches, "grams", "label"))
        leader = Leader(settings)
        for _ in range(settings.rounds):
            for held, label in examples:
                leader.learn(*unpacked(held, settings), label)
        yield pa.RecordBatch.from_arrays([pa.array([leader.weights().astype("<f8").tobytes()])], ["weights"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", label_column="quality", settings: Settings = Settings()) -> np.ndarray:
    """The weights. ``labels`` has the id and 0 or 1."""
    spark = docs.sparkSession
    known = labels.select(col(id_column).cast("long").alias("id"), col(label_column).cast("int").alias("label")).dropna()
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    # Rows fixed in number by the limit, so sending them to every task is safe.
    chosen = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(settings.most))
    texts = docs.select(col(id_column).cast("long").alias("id"), col(text_column).alias("text"))
    # Texts that share an id are numbered in their order, as the texts themselves are not sent on.
    rows = texts.join(chosen, "id").withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("text")))
    rows = rows.select("id", "place", "label", "text").mapInArrow(_packed(settings), "id long, place int, label int, grams binary")
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("id", F.lit(1)), "id", "place")
    found = rows.select("grams", "label").mapInArrow(_learn(settings), "weights binary").collect()
    return np.frombuffer(found[0].weights, "<f8") if found else Leader(settings).weights()


def _score(settings: Settings, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        for batch in batches:
            scores = []
            for text in batch.column(batch.num_columns - 1):
                places, values = features(text.as_py(), settings)
                scores.append(logistic(weights[places] @ values))
            columns = [batch.column(k) for k in range(batch.num_columns - 1)] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *ADDED])

    return run


def score(docs: DataFrame, weights: np.ndarray, text_column="text", keep: list[str] | None = None, settings: Settings = Settings()) -> DataFrame:
    """The columns ``keep`` (all by default) and ``score``: the chance that the text is of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(np.array(weights))
    kept = without(docs.select(*[col(c) for c in (docs.columns if keep is None else keep)]), ADDED)
    source = docs.select(*[col(c) for c in kept.columns], col(text_column).alias("__tb_text"))
    return source.mapInArrow(_score(settings, sent), kept.withColumn("score", F.lit(0.0)).schema)
