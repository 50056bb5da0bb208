import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyboard.llm import quality
from tallyboard.llm.quality import Settings

SF = "/root/testdata/sf0.01"


def slow_weights(examples, s):
    """One coordinate at a time, as the method is written down."""
    z, n = {}, {}

    def weight(k):
        zk = z.get(k, 0.0)
        if abs(zk) <= s.l1:
            return 0.0
        return -(zk - math.copysign(s.l1, zk)) / ((s.beta + math.sqrt(n.get(k, 0.0))) / s.alpha + s.l2)

    for _ in range(s.rounds):
        for places, values, label in examples:
            w = [weight(k) for k in places]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, values, strict=True))))
            for k, x, wk in zip(places, values, w, strict=True):
                g = (p - label) * x
                step = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / s.alpha
                z[k] = z.get(k, 0.0) + g - step * wk
                n[k] = n.get(k, 0.0) + g * g
    return {k: weight(k) for k in z}


def test_learning_matches_a_plain_loop():
    s = Settings(bits=8, rounds=2)
    texts = [("good words here", 1), ("BAD!! BAD!! BAD!!", 0), ("more good words", 1), ("", 0), ("!! !!", 0)]
    examples = [(*quality.features(t, s), y) for t, y in texts]
    leader = quality.Leader(s)
    for _ in range(s.rounds):
        for e in examples:
            leader.learn(*e)
    want = slow_weights(examples, s)
    got = leader.weights()
    assert all(abs(got[k] - w) < 1e-9 for k, w in want.items())
    assert np.count_nonzero(got) <= len(want)


def test_held_out_accuracy(spark):
    from tallyboard.llm.queries import QUERIES
    rows = {r.doc_id: r for r in QUERIES["op2_quality"](spark, SF).collect()}
    docs = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(rows) == sorted(docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows.values() if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    good = [r.score for r in held if labels[r.doc_id]]
    bad = [r.score for r in held if not labels[r.doc_id]]
    assert np.mean([[a > b for b in bad] for a in good]) > 0.97
    assert np.mean([x >= 0.3 for x in good]) > 0.97


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs = spark.createDataFrame([(k, "aa bb" if k % 2 else "cc!! dd!!") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    one = quality.train(docs, labels)
    two = quality.train(docs, labels.union(spark.createDataFrame([(3, None), (None, 1), (99, 0)], labels.schema)))
    assert np.array_equal(one, two)
    rows = quality.score(docs, one).collect()
    assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in rows)


@pytest.mark.parametrize("rows", [[], [(None, None, 3), (1, "", 4), (1, "x" * 300_000, 5), (1, "x", 6)]])
def test_odd_rows_without_labels(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.score(docs, quality.train(docs, labels)).collect()
    assert [r.score for r in out] == [0.5] * len(rows) and out[0:1] == out[0:1]


def test_the_learning_task_holds_packed_counts():
    s = Settings(rounds=1)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 1500)) for _ in range(150)] + ["", None, "same same same"]
    rows = pa.RecordBatch.from_pydict({"id": range(153), "place": [1] * 153, "label": [k % 2 for k in range(153)], "text": texts})
    sent = [b.select(["grams", "label"]) for b in quality._packed(s)(iter([rows]))]
    plain = [quality.features(t, s) for t in texts]
    assert sum(b.nbytes for b in sent) * 4 < sum(a.nbytes + b.nbytes for a, b in plain)
    tracemalloc.start()
    (found,) = quality._learn(s)(iter(sent))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    leader = quality.Leader(s)
    assert most < 6 * leader.z.nbytes + sum(a.nbytes + b.nbytes for a, b in plain) / 3
    for k, (places, values) in enumerate(plain):
        leader.learn(places, values, k % 2)
    assert found.column(0)[0].as_py() == leader.weights().astype("<f8").tobytes()


def test_texts_of_one_id_are_learnt_in_their_order(spark):
    s = Settings(bits=8)
    texts = ["zz good", "aa bad!!", None, "mm mm words", ""]
    docs = spark.createDataFrame([(7, t) for t in texts] + [(8, "other"), (None, "no id")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0)], "doc_id long, quality int")
    got = quality.train(docs, labels, settings=s)
    order = sorted(texts, key=lambda t: (t is not None, t))
    found = []
    for rows in ([(t, 1) for t in order] + [("other", 0)], [("other", 0)] + [(t, 1) for t in order]):  # as the ids' hashes stand
        leader = quality.Leader(s)
        for _ in range(s.rounds):
            for t, y in rows:
                leader.learn(*quality.features(t, s), y)
        found.append(leader.weights())
    assert any(np.array_equal(got, w) for w in found)
