import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyboard.llm import packing, tokens
from tallyboard.llm.packing import Limits

TEXTS = [
    None, "", "a", "word " * 5000, "x" * 30_000, "naïve café ² ½ 中文 <|endoftext|> end", "a\x1cb c", "Same text", "Same text",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_path())


def check(rows, wanted, limits=Limits()):
    """Pieces put together again give every id once; sequences keep the limits and have no gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.id].append((r.start, r.ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert r.length * 4 == len(r.ids) > 0
    got = {k: np.frombuffer(b"".join(x for _, x in sorted(v)), "<u4").tolist() for k, v in by_doc.items()}
    assert got == wanted
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(places) <= limits.segments
    return len(by_sequence)


def test_round_trip(spark, library):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    wanted = {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(TEXTS)}
    n = check(packing.pack(docs.coalesce(1)).collect(), wanted)
    assert n == -(-sum(map(len, wanted.values())) // 1024)


def test_whole_table_has_little_padding(spark, library):
    from tallyboard.llm.queries import QUERIES
    docs = dict(tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op1_packing"](spark, "/root/testdata/sf0.001").collect()
    total = 0
    for r in rows:
        ids = np.array(library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids + [0], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
        total += r.length
    assert len({r.sequence_id for r in rows}) * 1024 - total < 0.02 * total


def test_limits_hold_for_instruction_data(spark, library):
    data = [(k, "prompt " * (k % 40), "answer " * (k % 90 + 1)) for k in range(400)]
    limits = Limits(256, 6, 100)
    rows = packing.pack(spark.createDataFrame(data, "doc_id long, q string, a string").coalesce(1), text_column="a", prompt_column="q", limits=limits).collect()
    wanted = {k: library.encode(q).ids + library.encode(a).ids + [0] for k, q, a in data}
    check(rows, wanted, limits)
    prompts = {k: len(library.encode(q).ids) for k, q, _ in data}
    loss = defaultdict(int)
    for r in rows:
        loss[r.sequence_id] += max(0, r.start + r.length - max(r.start + 1, prompts[r.id]))
    assert max(loss.values()) <= 100


def test_the_best_product_goes_first():
    packer = packing.Packer(Limits(10, 3, 10), 0)
    for k, n in enumerate((3, 7, 6, 4)):
        assert not list(packer.add(packing.Item(k, np.zeros(n, "<u4"), 0, 0)))
    assert [(r[0], r[5], r[6]) for r in packer.fill()] == [(1, 0, 0), (0, 0, 7), (2, 1, 0), (3, 1, 6)]


def test_many_small_partitions_have_little_padding(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(200)
    texts = dict(tuple(r) for r in docs.collect())
    wanted = {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
    spread = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(211)
    n = check(packing.pack(spread).collect(), wanted)
    total = sum(map(len, wanted.values()))
    assert n * 1024 - total < 0.05 * total


def test_the_loss_limit_decides():
    # By tokens and segments alone, the two answers would share a sequence.
    def packed(loss):
        packer = packing.Packer(Limits(20, 4, loss), 0)
        for key, n, prompt in ((0, 10, 0), (1, 9, 0), (2, 10, 9), (3, 8, 8)):
            assert not list(packer.add(packing.Item(key, np.zeros(n, "<u4"), 0, prompt)))
        by_sequence = defaultdict(list)
        for r in packer.fill():
            by_sequence[r[5]].append((r[0], r[2]))
        return list(by_sequence.values())

    assert packed(19) == [[(0, 10), (1, 9)], [(2, 10), (3, 8)]]
    assert packed(10) == [[(0, 10), (2, 10)], [(1, 9), (3, 8)]]


def test_first_ids_bear_no_loss():
    item = packing.Item(1, np.arange(30, dtype="<u4"), 10, 4)
    assert item.loss(10 + 5) == 4 and item.fitting(20, 4) == 5
    rest = packing.Item(1, np.arange(10, 30, dtype="<u4"), 12, 15, 10)
    assert rest.total == 30 and rest.loss(17) == 2 and rest.next(2) == np.array([12, 13], "<u4").tobytes()


def test_empty_table_null_ids_and_clashing_columns(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(None, "a", 1), (None, "a", 2)], "doc_id long, text string, sequence_id int")
    assert len(packing.pack(docs).collect()) == 2


def test_fast_path_agrees_with_the_library(library):
    rng = np.random.default_rng(3)
    words = tokens.vocabulary(tokens.default_path())
    kinds = [range(32, 127), range(0, 0x250), range(0x250, 0x3000), range(0x1F300, 0x1F700)]
    for k in range(400):
        text = "".join(chr(rng.choice(list(kinds[k % 4]))) if rng.random() < 0.7 else rng.choice([" ", "'s", "\n", "the"]) for _ in range(60))
        assert words.encode(text) == library.encode(text, add_special_tokens=False).ids
        if words.plain(text):
            import regex
            assert tokens.PLAIN_WORDS.findall(text) == regex.findall(tokens.PATTERN, text)
