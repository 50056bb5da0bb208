import itertools
import random
import re

import numpy as np
import pytest

from tallyboard.llm import graph, jaccard


def sets_of(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[k : k + words]) for k in range(len(found) - words + 1))


def brute(docs, words, percent):
    """(id, size, smallest id reached) by comparing all pairs; a row is a node."""
    sets = [sets_of(t, words) for _, t in docs]
    label = list(range(len(docs)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in itertools.combinations(range(len(docs)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            label[root(a)] = root(b)
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if root(j) == root(k) and docs[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=repr)


def result(spark, docs, words=5, percent=80):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, rep string").repartition(4)
    return sorted((tuple(r) for r in jaccard.similar_groups(df, words=words, percent=percent).collect()), key=repr)


def corpus(seed, groups, size, words=120, edits=8):
    """Groups of near copies of random texts that also share a common passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    docs, k = [], 0
    for g in range(groups):
        base = [word() for _ in range(rng.randrange(10, words))] + (passage if g % 2 else [])
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(edits)):
                text[rng.randrange(len(text))] = word()
            docs.append((k * 7 % 1009, " ".join(text).title() if rng.random() < 0.2 else " ".join(text)))
            k += 1
    return docs


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 50)])
def test_against_all_pairs(spark, words, percent):
    docs = corpus(words, 25, 6)
    assert result(spark, docs, words, percent) == brute(docs, words, percent)


def test_large_groups_are_split_without_loss(spark, monkeypatch):
    for name, value in (("BUCKET_DOCS", 12), ("BUCKET_SHINGLES", 1500), ("LIST_DOCS", 8), ("ANCHORS", 1)):
        monkeypatch.setattr(jaccard, name, value)
    docs = corpus(11, 4, 40, edits=14)
    want = brute(docs, 3, 90)
    assert result(spark, docs, 3, 90) == want
    assert 4 < len({r[2] for r in want}) < len(docs)


def test_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_BITS", 1 << 13)
    docs = corpus(5, 20, 5)
    assert result(spark, docs, 3, 90) == brute(docs, 3, 90)


def test_odd_rows(spark):
    docs = [
        (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "ONE"), (3, "one two"), (4, "one\x0btwo"), (None, "one two"), (None, "alone here"),
        (20, "a b c d e f"), (20, "a b c d e f"), (20, "other text of the same id"), (30, "é É"), (31, "é é"), (40, "x " * 60_000),
        (41, "y" * 100_000), (2, "y" * 100_000),
    ]
    assert result(spark, docs, 3, 90) == brute(docs, 3, 90)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_search_finds_what_counting_finds():
    rng = np.random.default_rng(8)
    bucket, added = jaccard.Bucket(70), []
    for _ in range(150):
        base = rng.integers(0, 60, 40) if rng.random() < 0.5 or not added else np.array(sorted(added[rng.integers(len(added))]))
        found = {int(x) for x in rng.permutation(base)[:30]} | {int(x) for x in rng.integers(0, 300, 4)}
        added.append(found)
    added.sort(key=len)
    label = list(range(len(added)))
    for k, s in enumerate(added):
        links = bucket.add(sorted(s))
        for j in links:
            assert 170 * len(s & added[j]) >= 70 * (len(s) + len(added[j]))
        for j in range(k):
            if 170 * len(s & added[j]) >= 70 * (len(s) + len(added[j])):
                old, new = label[j], label[k]
                label = [new if x == old else x for x in label]
        assert len({label[j] for j in range(k + 1)}) == len(bucket.roots)


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(9, k) for k in range(300, 500)] + [(9, 9), (500, 9)]
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 100 for k in range(100, 161)} | {k: 9 for k in [9, *range(300, 501)]}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_lists_that_agree_in_their_low_bits_count_apart(monkeypatch):
    low = 12345
    sizes, bounds = np.array([200, 200]), np.array([0, 2, 4])
    lists, weights = np.array([low, low + (1 << 31), low, low + (1 << 31)]), np.array([10, 1, 10, 1])
    for columns in (1, 2048):
        monkeypatch.setattr(jaccard, "COLUMNS", columns)
        assert jaccard.alike(sizes, bounds, lists, weights, 90).tolist() == [0, 0]
        assert jaccard.alike(sizes, bounds, lists, np.array([8, 1, 8, 1]), 90).tolist() == [0, 1]


def test_large_group_sends_few_lists(spark, monkeypatch):
    """Forty near copies hold many lists; neighbours join nearly all of them before any document goes with its lists."""
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(900)]
    rows = []
    for k in range(40):
        words = list(base)
        for at in rng.choice(900, 5, replace=False):
            words[at] = f"x{rng.integers(1 << 40)}"
        rows.append((k, " ".join(words)))
    sent, routed = [], jaccard.routed_lists

    def counted(short, percent):
        out = routed(short, percent)
        sent.extend(len(r.lists) for r in out.collect())
        return out

    monkeypatch.setattr(jaccard, "routed_lists", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: r.component_id for r in jaccard.similar_groups(df, words=3, percent=90).collect()}
    assert set(found.values()) == {0} and sum(sent) < 400


def test_few_edges_take_no_rounds_of_their_own(spark, monkeypatch):
    edges = [(k, k + 1) for k in range(100, 160)] + [(9, k) for k in range(300, 500)] + [(9, 9), (500, 9)]
    want = {k: 100 for k in range(100, 161)} | {k: 9 for k in [9, *range(300, 501)]}
    made, plain = [], graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, label: made.append(label) or plain(df, label))
    for last, least, most in ((4096, 3, 3), (20, 6, 15), (0, 6, 60)):
        monkeypatch.setattr(graph, "LAST", last, raising=False)
        made.clear()
        assert dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()) == want
        assert least <= len(made) <= most


def test_whole_sets_are_fetched_for_clusters_alone(spark, monkeypatch):
    """Documents that only share a passage with others do not send their shingles; copies do not meet at their digest."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(30))
    docs = [(k, passage + " " + " ".join(word() for _ in range(200))) for k in range(60)]
    docs += [(100, docs[7][1]), (101, docs[7][1]), (102, docs[9][1] + " end"), (None, docs[9][1])]
    fetched, plain = [], jaccard.sets_of

    def counted(wanted, described):
        assert "shingles" not in wanted.columns
        out = plain(wanted, described)
        fetched.extend(r.rep for r in out.collect())
        return out

    monkeypatch.setattr(jaccard, "sets_of", counted)
    assert result(spark, docs, 3, 90) == brute(docs, 3, 90)
    assert sorted(fetched) == [9, 102]
