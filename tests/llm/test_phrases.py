import random
import re
from collections import Counter

import pytest

from tallyboard.llm import bloom, phrases


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, most=3, least=10, top=2000):
    f = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            words = [w for w in re.split("[ \t]", piece) if w]
            for n in range(1, most + 1):
                for k in range(len(words) - n + 1):
                    f[lang or "und", tuple(words[k : k + n])] += 1
    totals = Counter()
    for (lang, w), n in f.items():
        totals[lang] += n if len(w) == 1 else 0
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in found.items():
        inside = any(
            la == lang and len(v) > len(w) and any(v[k : k + len(w)] == w for k in range(len(v))) and 100 * b >= 50 * a
            for (la, v), b in found.items()
        )
        if not inside:
            score, _, left, right = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.append((lang, -score, -a, " ".join(w).encode(), left, right))
    rows = []
    for lang in totals:
        for rank, (_, s, a, p, left, right) in enumerate(sorted(x for x in out if x[0] == lang)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(rows)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def made(seed, docs=120, words="ab cd e é Straße X".split()):
    rng = random.Random(seed)
    rows = []
    for _ in range(docs):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "de", None]), text))
    return rows


@pytest.mark.parametrize("share", [1, 1 / 16, 1 / 100_000])
def test_against_all_phrases(spark, share):
    """However poor the sample, expansion finds all: the last share proposes nothing."""
    rows = made(1) + [("en", None), ("en", ""), (None, " . ,")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "lang string, text string, n int")
    assert got(phrases.collocations(phrases.frequent_phrases(df, share=share))) == brute(rows)


def test_longer_phrases_few_words_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "SLICE", 30)
    rows = made(2, 60, "the quick brown fox".split())
    df = spark.createDataFrame(rows, "lang string, text string")
    counted = phrases.frequent_phrases(df, most=5, min_count=3)
    assert got(phrases.collocations(counted, top=40)) == brute(rows, 5, 3, 40)


def test_full_filters_only_cost_work(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BITS", 64)
    rows = made(3, 80, [f"w{k}" for k in range(12)])
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(phrases.collocations(phrases.frequent_phrases(df, min_count=4))) == brute(rows, least=4)


def test_passes_do_not_count_twice(spark):
    """Every phrase is counted by exactly one pass."""
    text = " ".join(random.Random(4).choices("abcdef", k=3000))
    df = spark.createDataFrame([("en", text)] * 3 + [("en", text + " x")], "lang string, text string")
    counted = phrases.frequent_phrases(df, share=1 / 7)
    assert counted.count() == counted.select("lang", "size", "phrase").distinct().count()


def test_exact_beyond_64_bits(spark):
    big = 3_000_000_007
    df = spark.createDataFrame([("en", 0, "", big * 9), ("en", 1, "a", big), ("en", 1, "b", big + 2), ("en", 2, "a b", big - 1)], "lang string, size int, phrase string, n long")
    (row,) = phrases.collocations(df).collect()
    assert row.score == 1_000_000 * (big - 1) ** 2 // (big * (big + 2))


def test_order_of_ties_and_limit(spark):
    rows = [("en", f"{w}1 {w}2.") for w in ["é", "z", "a", "\U0001f600", "￮"] for _ in range(10)]
    df = spark.createDataFrame(rows, "lang string, text string")
    have = got(phrases.collocations(phrases.frequent_phrases(df), top=4))
    assert have == brute(rows, top=4) and len(have) == 4


def test_no_texts_and_no_language(spark):
    assert phrases.collocations(phrases.frequent_phrases(spark.createDataFrame([], "lang string, text string"))).collect() == []
    df = spark.createDataFrame([("a b",)] * 10, "text string")
    assert [r.lang for r in phrases.collocations(phrases.frequent_phrases(df, lang_column=None)).collect()] == ["und"]
