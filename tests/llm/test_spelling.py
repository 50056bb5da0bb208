import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyboard.llm import spelling


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words, factor=2):
    out = {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if distance_one(w, v))
        fits = near and -near[0][0] >= factor * n
        out[w] = [n, len(near), near[0][1] if fits else None, -near[0][0] if fits else None]
    for w, row in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        row.append(root)
    return {w: tuple(r) for w, r in out.items()}


def got(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def check(spark, words):
    assert got(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)


def made(seed, n, letters="abé×ÿ", most=8):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(1, most))): rng.choice([1, 2, 3, 4, 8, 16, 200]) for _ in range(n)}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    check(spark, made(seed, 500))


def test_small_blocks_and_portions(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 3)
    monkeypatch.setattr(spelling, "BLOCK_LETTERS", 40)
    monkeypatch.setattr(spelling, "VERIFY_LETTERS", 20)
    check(spark, made(3, 300, "ab", 9))


def test_one_cell_holds_most_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 16)
    rng = random.Random(5)
    check(spark, {"".join(rng.sample("abcdefg", 7)): rng.randint(1, 50) for _ in range(400)} | made(6, 60))


def test_very_long_words(spark):
    long = "ab" * 3000
    check(spark, {long: 9, long + "c": 4, long[:-1]: 1, long[:-1] + "x": 2, "c" * 700: 5, "c" * 699: 11, "short": 3})


def test_long_chains_of_forms(spark):
    check(spark, {"a" * k: 2**k for k in range(1, 21)})


def test_edits_are_verified():
    a = spelling.points_of(["abcd", "abcd", "abcd", "abcd", "aaaa"]).reshape(5, 4)
    b = spelling.points_of(["abcde", "xabcd", "abxcd", "abdcx", "aaaaa"]).reshape(5, 5)
    assert spelling.one_inserted(a, b).tolist() == [True, True, True, False, True]
    assert spelling.near_pairs(["abcd", "bacd"], ["abcx", "dcab"], False)[0].tolist() == [0]
    assert spelling.near_pairs([""], ["a"], False)[0].tolist() == []


def test_groups_cover_every_step():
    """An edit leads from a cell to one of the listed cells, or back along one."""
    groups = (np.arange(0x110000) % spelling.GROUPS).astype(np.int8)
    steps = set(spelling.steps())
    rng = random.Random(7)
    for _ in range(300):
        a = "".join(rng.choices("abcdefghé", k=rng.randint(1, 700)))
        k = rng.randrange(len(a))
        for b in (a[:k] + "z" + a[k:], a[:k] + rng.choice("xyz") + a[k + 1 :]):
            cells = spelling.cells_of([a, b], np.array([len(a), len(b)]), groups).tolist()
            moves = {(len(b) - len(a), (cells[1] - cells[0]) % spelling._CELLS), (len(a) - len(b), (cells[0] - cells[1]) % spelling._CELLS)}
            assert moves & steps


def test_words_of_texts(spark):
    texts = [
        (1, "Spelling spelling, SPELLING-spellÉr étÉs"), (1, "spelling spelling"), (None, "spelling ×÷abc"), (2, None), (3, ""),
        (4, "x" * 5000 + " spelling " * 400),
    ]
    want = Counter()
    for i, t in texts:
        run = ""
        for c in (t or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                want[run if h % 3 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
                run = ""
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, n string")
    have = {r.word: r.n for r in spelling.word_counts(df, min_chars=3, min_count=2, divisor=3).collect()}
    assert have == {w: n for w, n in want.items() if len(w) >= 3 and n >= 2}


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.word_counts(empty)).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([("a", 1)], "word string, n long"), factor=1)
