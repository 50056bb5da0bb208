"""Documents packed into training sequences: vector bin packing by the dot-product heuristic.

An item has three demands: tokens, one segment, and tokens that bear loss. The first token of a piece has nothing
before it to be told from, so it bears none, nor does a prompt. A sequence has a limit for each. Sequences are filled one at a time: of the waiting pieces that fit, the one whose demands have
the largest dot product with what the sequence has left goes in. When none fits, the largest waiting
piece is cut to fill the rest.

Every task packs the documents of its own input partition from a bounded pool, so texts are not shuffled,
a hot source stays spread as it was read, and a lost task is redone alone. What a task has left at its end, less than
two sequences hold, is packed in a second pass with what up to 255 other tasks have left. So one sequence in 256 tasks
may stay underfull, however small the partitions. The pieces are written out before, so no text is encoded twice
and no sequence changes when a task is run again.

Defined results: a null or empty text is the separator alone; rows with the same or a null id are packed
as documents of their own; an example longer than a sequence is cut; no row in, no row out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm import tokens
from tallyboard.llm.common import chunked, col, rows_of
from tallyboard.scratch import stage

POOL = 4096
#: A cut shorter than this is not worth a segment; the rest of the sequence is padded.
LEAST_CUT = 16
#: The rests of so many tasks are packed together.
TASKS = 256

OUT = pa.schema([
    ("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
KINDS = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: A rest has no sequence, but where its loss begins and with whose rests it is packed.
WITH_RESTS = pa.schema([*OUT, ("loss_from", pa.int64()), ("share", pa.int64())])
#: Sequences of the second pass are numbered from here, those of a task from its number shifted by ``TASK_BITS``.
SECOND, TASK_BITS = 1 << 62, 40


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    #: A sequence of one piece has one token without loss.
    loss: int = 1023


@dataclass
class Item:
    key: int | None
    #: The document's ids from ``base`` on.
    ids: np.ndarray
    start: int
    #: Ids before this place bear no loss.
    loss_from: int
    base: int = 0

    @property
    def total(self) -> int:
        return self.base + len(self.ids)

    def loss(self, stop: int) -> int:
        return max(0, stop - max(self.start + 1, self.loss_from))

    def fitting(self, room: int, loss_room: int) -> int:
        """How many of the next ids fit."""
        return min(self.total - self.start, room, max(1, self.loss_from - self.start) + loss_room)

    def next(self, length: int) -> bytes:
        return self.ids[self.start - self.base : self.start - self.base + length].tobytes()


class Packer:
    def __init__(self, limits: Limits, first_sequence: int, pool: int = POOL):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("every limit must be at least 1")
        self.limits, self.next, self.pool = limits, first_sequence, pool
        self.items: list[Item] = []
        self.tokens, self.losses = np.zeros(pool + 1), np.zeros(pool + 1)

    def piece(self, item: Item, length: int, sequence: int, offset: int) -> tuple:
        row = (item.key, item.start, length, item.next(length), item.total, sequence, offset)
        item.start += length
        return row

    def add(self, item: Item) -> Iterator[tuple]:
        """Whole sequences of a long document go out at once, its tail waits."""
        limits = self.limits
        while item.start < item.total:
            length = item.fitting(limits.tokens, limits.loss)
            if length < limits.tokens and item.loss(item.start + length) < limits.loss:
                break
            yield self.piece(item, length, self.next, 0)
            self.next += 1
        if item.start < item.total:
            self.measure(len(self.items), item)
            self.items.append(item)
        if len(self.items) > self.pool:
            while len(self.items) > self.pool // 2:
                yield from self.sequence()

    def measure(self, k: int, item: Item) -> None:
        self.tokens[k], self.losses[k] = item.total - item.start, item.loss(item.total)

    def remove(self, k: int) -> None:
        last = self.items.pop()
        if k < len(self.items):
            self.items[k] = last
            self.measure(k, last)

    def best(self, room: int, segments: int, loss_room: int) -> int | None:
        """The fitting piece with the largest dot product of demands and room, both as shares of the limits."""
        limits, n = self.limits, len(self.items)
        tokens, losses = self.tokens[:n], self.losses[:n]
        product = (
            tokens * (room / limits.tokens**2) + segments / limits.segments**2 + losses * (loss_room / limits.loss**2)
        )
        product[(tokens > room) | (losses > loss_room)] = -1
        k = int(product.argmax())
        return k if product[k] >= 0 else None

    def sequence(self) -> Iterator[tuple]:
        """One sequence from the waiting pieces."""
        limits = self.limits
        room, segments, loss_room = limits.tokens, limits.segments, limits.loss
        while self.items and room and segments:
            k = self.best(room, segments, loss_room)
            if k is None:
                k = int(self.tokens[: len(self.items)].argmax())
                length = self.items[k].fitting(room, loss_room)
                if length < min(LEAST_CUT, limits.tokens, limits.loss):
                    break
            else:
                length = int(self.tokens[k])
            item = self.items[k]
            loss = item.loss(item.start + length)
            yield self.piece(item, length, self.next, limits.tokens - room)
            room, segments, loss_room = room - length, segments - 1, loss_room - loss
            if item.start == item.total:
                self.remove(k)
            else:
                self.measure(k, item)
        self.next += 1

    def full(self) -> Iterator[tuple]:
        """Sequences while what waits exceeds one of the limits twice over."""
        limits, n = self.limits, len(self.items)
        while (
            n >= 2 * limits.segments or self.tokens[:n].sum() >= 2 * limits.tokens or self.losses[:n].sum() >= 2 * limits.loss
        ):
            yield from self.sequence()
            n = len(self.items)

    def fill(self) -> Iterator[tuple]:
        """Sequences until nothing waits."""
        while self.items:
            yield from self.sequence()


def _task() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def _first_pass(path: str, separator: int | None, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.vocabulary(path)
        task = _task()
        packer = Packer(limits, task << TASK_BITS)
        end = [] if separator is None else [separator]

        def rows():
            for key, prompt, text in rows_of(batches, "id", "prompt", "text"):
                before = words.encode(prompt) if prompt else []
                ids = np.array(before + words.encode(text or "") + end, "<u4")
                for piece in packer.add(Item(key, ids, 0, len(before))):
                    yield *piece, None, None
            for piece in packer.full():
                yield *piece, None, None
            for item in packer.items:
                length = item.total - item.start
                yield item.key, item.start, length, item.next(length), item.total, None, None, item.loss_from, task // TASKS

        yield from chunked(rows(), WITH_RESTS)

    return run


def _second_pass(limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, SECOND + (_task() << TASK_BITS))

        def rows():
            for key, start, ids, loss_from in rows_of(batches, "id", "start", "ids", "loss_from"):
                yield from packer.add(Item(key, np.frombuffer(ids, "<u4"), start, loss_from, start))
            yield from packer.fill()

        yield from chunked(rows(), OUT)

    return run


def pack(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", prompt_column: str | None = None,
    limits: Limits = Limits(), separator: int | None = 0, tokenizer: str | None = None,
) -> DataFrame:
    """One row for each piece: ``id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit token ids. The ids of ``prompt_column`` come before those of
    the text and bear no loss. ``tokenizer`` is the path of a byte-level BPE file on every executor.
    """
    prompt = col(prompt_column) if prompt_column else F.lit(None)
    source = docs.select(
        col(id_column).cast("long").alias("id"), prompt.cast("string").alias("prompt"), col(text_column).alias("text")
    )
    first = stage(
        source.mapInArrow(_first_pass(tokenizer or tokens.default_path(), separator, limits), f"{KINDS}, loss_from long, share long"), "pieces"
    )
    rests = first.where("sequence_id IS NULL").repartition("share").mapInArrow(_second_pass(limits), KINDS)
    return first.where("sequence_id IS NOT NULL").select(*OUT.names).unionByName(rests)
