import hashlib
import itertools

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyboard.llm import bpe, tokens

TEXTS = [
    None, "", " ", "hello hello world", "x" * 100_000, "a\x85b c\x1dd ª²½ Ⅷ 中文字 ‍👩‍👩‍👧 <|endoftext|><|endoftext|> tail\n\n  \n",
    "it's we'll I'VE 'sorry'", "same", "same", "é" * 70, "�\x00\x01", "¿Qué? «así» – “sí”…",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_path())


@pytest.mark.parametrize("size", [0, 3, 1000])
def test_equals_the_library(spark, library, size):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    rows = bpe.encode(docs, lexicon_words=size).collect() if size else bpe.encode(docs, lexicon_words=1).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        ids = library.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False) == (TEXTS[r.doc_id] or "")


def test_query(spark, library):
    from tallyboard.llm.queries import QUERIES
    texts = dict(tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op9_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        )


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_transducer_gives_each_word_its_ids_and_shares_suffixes():
    words = sorted(a.encode() + b for a, b in itertools.product(("in", "out", "für", "x"), (b"side", b"sides", b"line", b"lines", b"")))
    lexicon = bpe.Lexicon(bpe.compile_lexicon((w, list(range(k, k + 1 + k % 3))) for k, w in enumerate(words)))
    asked = words + [b"insid", b"zzz", b"", b"outliness"]
    places = lexicon.places(asked).tolist()
    assert places == [*range(len(words)), -1, -1, -1, -1]
    assert [lexicon.ids(p) for p in places[: len(words)]] == [np.arange(k, k + 1 + k % 3, dtype=np.int32).tobytes() for k in range(len(words))]
    assert len(lexicon.ends) < 25 < sum(map(len, words))


def test_pieces_of_odd_texts(library):
    rng = np.random.default_rng(5)
    words = tokens.vocabulary(tokens.default_path())
    pools = [range(0, 0x300), range(0x370, 0x600), range(0x2000, 0x2200), range(0x4E00, 0x4E80), range(0x1F300, 0x1F400)]
    lexicon = bpe.Lexicon(bpe.compile_lexicon([(b" the", [262])]))
    encoder = bpe.Encoder(words, lexicon)
    for k in range(500):
        pool = list(pools[k % 5])
        text = "".join(chr(rng.choice(pool)) if rng.random() < 0.6 else rng.choice([" ", "  ", "'s", "\n", " the"]) for _ in range(40))
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
