import hashlib
import random
import re

import pytest
import xxhash

from tallyboard.llm import fingerprint


def pieces(text):
    cuts = [*fingerprint.CUTS, 1 << 30]
    return {line[a:b] for line in text.split("\n") for a, b in zip(cuts, cuts[1:], strict=False) if line[a:b]}


def alike(a, b):
    a, b = pieces(a), pieces(b)
    return 1.0 if not a and not b else (len(a) + len(b) - len(a ^ b)) / (len(a) + len(b))


def brute(docs):
    """The rows wanted, sorted; rows that repeat an id stand in the order of the hashes of their texts."""

    def hashes(text):
        signed = lambda x: x - (x >> 63 << 64)
        data = text.encode()
        number = fingerprint.CHECK.to_bytes(4, "little")
        first = xxhash.xxh64(data, seed=42).intdigest()
        return signed(first), signed(xxhash.xxh64(data, seed=xxhash.xxh64(number, seed=42).intdigest()).intdigest())

    order = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is not None, d[0], *hashes(d[1])))
    out = []
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), alike(text, edited), alike(text, following)))
    return in_order(out)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *r))


def result(spark, docs):
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], "doc_id long, text string, k int, cut int, next string").repartition(3)
    rows = fingerprint.compare_with_edit(df).collect()
    return figures(rows, "id"), rows


def figures(rows, name):
    return in_order((r[name], r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows)


def close(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3]
        assert g[3:] == pytest.approx(w[3:], abs=1e-12)


def corpus(seed, n):
    rng = random.Random(seed)
    lines = ["".join(rng.choice("ab \n") for _ in range(rng.randrange(1, 700))) for _ in range(40)]
    return [(k * 13, "\n".join(rng.choice(lines) + str(rng.randrange(4)) for _ in range(rng.randrange(9)))) for k in range(n)]


def test_against_sets(spark):
    docs = corpus(1, 200)
    close(result(spark, docs)[0], brute(docs))


def test_odd_rows(spark):
    docs = [
        (5, None), (6, ""), (7, "x"), (8, "\n\n"), (9, "é𝒳" * 5), (None, "null id"), (10, "b"), (10, "a"), (10, "a"), (-4, "first\nof all " * 9),
        (11, "z" * 200_000), (12, "\n".join(f"line {k}" for k in range(4000))), (13, "\n".join(f"line {k}" for k in range(2, 4100))),
    ]
    got, rows = result(spark, docs)
    close(got, brute(docs))
    prints = {r.id: r.fingerprint for r in rows}
    assert prints[5] == prints[6] == prints[8] and prints[12] != prints[13]


@pytest.mark.parametrize("docs", [[], [(1, "only one document\nof two lines")], [(1, None)]])
def test_few_rows(spark, docs):
    close(result(spark, docs)[0], brute(docs))


def test_rows_that_repeat_an_id_stay(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BLOCK", 4)
    docs = [(None, f"none\n{k % 3}") for k in range(9)] + [(7, "copy of one text\n" * 3)] * 30 + [(7, None), (7, ""), (8, "after"), (8, "after it")]
    close(result(spark, docs)[0], brute(docs))
    alone = [(3, "only text, in copies")] * 5
    got, rows = result(spark, alone)
    close(got, brute(alone))
    assert len({(r.fingerprint, r.edited_fingerprint) for r in rows}) == 1


def test_failed_peeling_is_tried_larger(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROOM", 0.05)
    monkeypatch.setattr(fingerprint, "LEAST", 2)
    docs = corpus(2, 60) + corpus(2, 4) * 2
    close(result(spark, docs)[0], brute(docs))


def test_recovered_digests_are_the_differing_ones(spark):
    rng = random.Random(3)
    rows = []
    for k in range(50):
        both = [rng.getrandbits(62) for _ in range(rng.randrange(60))]
        rows.append((k, both + [rng.getrandbits(62) for _ in range(rng.randrange(20))], both + [rng.getrandbits(62) for _ in range(rng.randrange(20))]))
    pairs = spark.createDataFrame(rows, "k int, a array<long>, b array<long>")
    got = {}
    for r in fingerprint.recovered(pairs.repartition("k"), ["k"]).collect():
        got.setdefault(r.k, {})[r.digest] = r.side
    for k, a, b in rows:
        assert got.get(k, {}) == {x: 1 for x in set(a) - set(b)} | {x: -1 for x in set(b) - set(a)}


def test_query_is_native_and_right(spark):
    from tallyboard.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = QUERIES["op6_fingerprints"](spark, sf)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    rows = df.collect()
    close(figures(rows, "doc_id"), brute(docs))
    texts = dict(docs)
    same = {}
    for r in rows:
        assert same.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert sum(r.near_edited > r.near_next for r in rows) > 0.97 * len(rows)


def read(text):
    """(size, {cell: [count, digests, checks]}) of a published fingerprint."""
    size, _, cells = text.partition(";")
    out = {}
    for entry in filter(None, cells.split(",")):
        cell, n, d, c = entry.split(":")
        out[int(cell)] = [int(n), int(d, 16), int(c, 16)]
    return int(size), out


def peel(size, cells, places, checks):
    """({digest: side}, whether all cells are then empty)."""
    cells, found = {k: list(v) for k, v in cells.items()}, {}
    while alone := [(n, d) for n, d, c in cells.values() if abs(n) == 1 and checks.get(d) == c]:
        n, d = alone[0]
        found[d] = n
        for t, p in enumerate(places[d]):
            cell = cells.setdefault(t * size + p % size, [0, 0, 0])
            cell[0], cell[1], cell[2] = cell[0] - n, cell[1] ^ d, cell[2] ^ checks[d]
    return found, not any(any(v) for v in cells.values())


def test_published_fingerprints_are_enough_to_compare(spark):
    from pyspark.sql import functions as F
    docs = corpus(5, 150) + [(90_000 + 13 * k, "\n".join(f"{k % 3} line {j}" for j in range(k, 40 * k))) for k in range(12)]
    order = sorted(docs)
    _, rows = result(spark, docs)
    prints = {r.id: (r.fingerprint, r.edited_fingerprint) for r in rows}
    edited = [(i, t[: len(t) - len(t) // 4] + order[(k + 1) % len(order)][1][: len(t) // 4]) for k, (i, t) in enumerate(order)]
    every = spark.createDataFrame([(t,) for _, t in order + edited], "text string").select(F.explode(fingerprint.paragraphs(F.col("text"))).alias("d")).distinct()
    places, checks = {}, {}
    whole = F.lit(1 << 40)
    for r in every.select("d", fingerprint.check_of(F.col("d")), *[F.pmod(F.xxhash64("d", F.lit(fingerprint.PLACE + t)), whole) for t in range(3)]).collect():
        places[r[0] % 2**64], checks[r[0] % 2**64] = r[2:], r[1] % 2**64
    texts, changed = dict(order), dict(edited)
    for i in texts:
        for text, printed in ((texts[i], prints[i][0]), (changed[i], prints[i][1])):
            size, cells = read(printed)
            found, complete = peel(size, cells, places, checks)
            assert complete and len(found) == len(pieces(text)) and size >= 1.5 * len(found) and size & (size - 1) == 0
    by_id = {r.id: r for r in rows}
    ids = [i for i, _ in order]
    for i, following in zip(ids, ids[1:] + ids[:1], strict=True):
        for other, near in ((prints[i][1], by_id[i].near_edited), (prints[following][0], by_id[i].near_next)):
            lists = [set(peel(*read(p), places, checks)[0]) for p in (prints[i][0], other)]
            total = sum(map(len, lists))
            assert near == pytest.approx(1.0 if not total else (total - len(lists[0] ^ lists[1])) / total, abs=1e-12)
            (size, a), (size_b, b) = read(prints[i][0]), read(other)
            if size == size_b:  # subtracted as they are
                minus = {c: [a.get(c, z)[0] - b.get(c, z)[0], a.get(c, z)[1] ^ b.get(c, z)[1], a.get(c, z)[2] ^ b.get(c, z)[2]] for z in [[0, 0, 0]] for c in a.keys() | b.keys()}
                found, complete = peel(size, minus, places, checks)
                assert set(found) == lists[0] ^ lists[1] if complete else set(found) <= lists[0] ^ lists[1]
