import hashlib
import random
import re

import numpy as np
import pytest

from tallyboard.llm import passages


def brute(docs, window=50):
    first = {}
    cut = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    for (i, _), words in zip(docs, cut, strict=True):
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if i is not None:
                first[w] = min(i, first.get(w, i))
    out = []
    for (i, _), words in zip(docs, cut, strict=True):
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=repr)


def result(spark, docs, window=50):
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, mark string").repartition(3)
    out = passages.drop_repeated_passages(df, window=window).collect()
    assert all(r.mark == "x" for r in out)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in out), key=repr)


def corpus(seed, n, window):
    """Texts of few words with shared passages around the window's length, copies, and overlapping passages."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("xyz")
    shared = [[word() for _ in range(rng.randrange(window - 2, 3 * window))] for _ in range(6)]
    docs = []
    for k in range(n):
        text = []
        for _ in range(rng.randrange(4)):
            text += [word() for _ in range(rng.randrange(20))]
            part = rng.choice(shared)
            at = rng.randrange(len(part) // 2)
            text += part[at : at + rng.randrange(1, len(part))]
        docs.append((k * 37 % 1009, rng.choice([" ", "\n", " \t "]).join(text)))
        if rng.random() < 0.1:
            docs.append((2000 + k, " ".join(text)))
    return docs


@pytest.mark.parametrize("window", [10, 11, 50])
def test_against_brute_force(spark, window):
    docs = corpus(window, 150, window)
    got = result(spark, docs, window)
    assert got == brute(docs, window)
    assert sum(r[2] for r in got) > 500


@pytest.mark.parametrize("sent", [0, 1000])
def test_many_shards(spark, monkeypatch, sent):
    monkeypatch.setattr(passages, "SHARD_CHARS", 300)
    monkeypatch.setattr(passages, "SENT_IDS", sent)
    docs = corpus(3, 100, 12)
    assert result(spark, docs, 12) == brute(docs, 12)


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(60))
    docs = [
        (1, None), (2, ""), (3, " \n"), (None, long), (5, long), (5, long), (6, long), (7, long + " tail"), (7, "other text"), (8, "x " * 40_000),
        (9, "x " * 60), (10, "ü" * 100_000), (11, long.upper()), (12, long.replace(" ", " ")), (4, "head " + long),
    ]
    assert result(spark, docs) == brute(docs)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_minima_and_automaton():
    rng = np.random.default_rng(1)
    for n, size in ((0, 3), (2, 3), (3, 3), (50, 7), (49, 1)):
        v = rng.integers(0, 1000, n, dtype=np.uint64)
        assert passages.window_minima(v, size).tolist() == [min(v[k : k + size]) for k in range(n - size + 1)]
    words = [bytes([97 + x]) for x in rng.integers(0, 3, 500)]
    asked = [words[10:15], words[100:105], [b"zz"] * 5]
    want = [k for k in range(496) if words[k : k + 5] in asked]
    assert passages.Automaton(asked).places(words).tolist() == want


def test_query(spark):
    from tallyboard.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs)]
    assert sorted(tuple(r) for r in QUERIES["op8_passages"](spark, sf).collect()) == sorted(want)
