import hashlib
from collections import defaultdict

import numpy as np
import pytest

from tallyboard.llm import line_dedup
from tallyboard.llm.common import SPACE

LONG = "A Line Of Boilerplate That Is Quite Long Enough, Really"


def brute(docs, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(SPACE).encode().lower().decode()
    holders = defaultdict(set)
    for i, text in docs:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders[key(line)].add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if i is None or len(holders[key(x)]) < min_docs or i == max(holders[key(x)])
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


DOCS = [
    *[(k, f"own text {k}\n  {LONG.upper() if k % 2 else LONG}\t\nend") for k in range(1, 8)],
    (8, None), (9, ""), (10, "\n\n"), (11, LONG + "\n" + LONG), (11, LONG), (None, LONG), (12, "ü" * 39 + "\n" + "Ü" * 40),
    *[(k, "Ü" * 40 + "\r") for k in range(20, 24)], (30, "x" * 200_000),
]


@pytest.mark.parametrize("most", [128 << 20, 0], ids=["filter sent", "filter kept in segments"])
def test_against_brute_force(spark, most):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    out = line_dedup.drop_repeated_lines(docs, max_filter_bytes=most)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=repr)
    assert got == brute(DOCS)
    assert sum(r[2] for r in got) > 8


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_repeated_lines(docs).collect() == []
    docs = spark.createDataFrame([(k, LONG, "x", 7) for k in range(6)], "doc_id long, text string, key string, n_lines int")
    rows = line_dedup.drop_repeated_lines(docs).orderBy("doc_id").collect()
    assert [(r.text, r.key, r.n_lines) for r in rows] == [("", "x", 1)] * 5 + [(LONG, "x", 1)]


def test_filters_lose_no_repeat():
    rng = np.random.default_rng(1)
    once = rng.integers(0, 2**63, 60_000, dtype=np.uint64)
    hashes = rng.permutation(np.concatenate([once, once[:500]]))
    _, suspect = line_dedup.twice_seen(hashes, np.zeros(len(hashes), bool))
    assert set(once[:500]) <= set(hashes[suspect])
    assert suspect.sum() < 3000


def test_query_matches_brute_force(spark):
    from tallyboard.llm.queries import QUERIES
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs)]
    got = [tuple(r) for r in QUERIES["op7_line_dedup"](spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
