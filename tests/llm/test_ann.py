import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyboard.llm import ann

SF = "/root/testdata/sf0.001"


def brute(rows, k=20, every=20):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in rows:
        if q % every == 0:
            found = sorted((-float((w * v).sum()), i) for i, w in rows if i != q)
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_walk_gives_all_pairs_in_order():
    rng = np.random.default_rng(2)
    for n, m in ((1, 1), (1, 5), (4, 1), (6, 9)):
        a, b = rng.random(n), rng.random(m)
        if n > 3:
            a[1] = a[2]
        pairs = list(ann.walk(a, b, np.ones((n, m), int), 10**9))
        sums = [a[i] + b[j] for i, j in pairs]
        assert len(set(pairs)) == len(pairs) == n * m and np.allclose(sums, sorted(sums))
    counts = np.array([[0, 3], [2, 0]])
    assert sum(counts[p] for p in ann.walk(np.array([0.1, 0.2]), np.array([0.0, 5.0]), counts, 3)) == 5


def test_query_on_small_table(spark):
    from tallyboard.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, have = brute(rows), got(QUERIES["op3_ann"](spark, SF))
    assert recall(have, want) >= 0.9
    by_id = dict(rows)
    assert all(abs(s - float((np.array(by_id[q]) * by_id[i]).sum())) < 1e-12 for q, v in have.items() for i, s in v)


def recall(have, want):
    assert set(have) == set(want) and all(len(have[q]) == len(want[q]) for q in want)
    return sum(len({i for i, _ in have[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))


def made(spark, kind, n=20_000):
    """Vectors of the test table, perturbed: as they are, of uneven lengths, or with one copied to a third of all rows."""
    rng = np.random.default_rng(11)
    x = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()])
    x = x[rng.integers(0, len(x), n)] + rng.normal(scale=0.1, size=(n, x.shape[1]))
    if kind == "uneven":
        x *= rng.lognormal(size=(n, 1))
    if kind == "copied":
        x[rng.random(n) < 1 / 3] = x[1]
    return x


@pytest.mark.parametrize("kind", ["even", "uneven", "copied"])
def test_recall_of_the_query(spark, tmp_path, kind):
    from tallyboard.llm.queries import QUERIES
    x = made(spark, kind)
    ids = pa.array(np.arange(len(x)))
    pq.write_table(pa.table({"vec_id": ids, "embedding": pa.array(list(x))}), tmp_path / "embeddings.parquet")
    have = got(QUERIES["op3_ann"](spark, str(tmp_path)))
    want = {}
    for q in range(0, len(x), 20):
        scores = (x * x[q]).sum(1)
        scores[q] = -np.inf
        want[q] = [(int(i), float(scores[i])) for i in np.lexsort((ids, -scores))[:20]]
    found = recall(have, want)
    print(kind, found)
    assert found >= 0.9


ODD = [
    (0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]),
    (6, [float("nan"), 1.0, 0.0]), (7, [float("inf"), 1.0, 0.0]), (8, [1.0]), (9, []), (20, [-5.0, 2.0, 0.0]), (21, [9.0, 9.0, 1.0]), (None, [1.0, 1.0, 1.0]),
]


def test_odd_vectors_ties_and_repeats(spark):
    df = spark.createDataFrame([(i, v, "x") for i, v in ODD + [(1, [1.0, 0.0, 0.0])]], "vec_id long, embedding array<double>, vector string")
    have = got(ann.nearest(df, df.where("vec_id % 20 = 0"), k=3))
    assert have == {0: [(21, 9.0), (1, 1.0), (1, 1.0)], 20: [(0, -5.0), (1, -5.0), (1, -5.0)]}


def test_common_vector_is_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(k, [1.0, 2.0, 3.0, 4.0] if k % 3 else rng.normal(size=4).tolist()) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, have = brute(rows), got(ann.nearest(df, df.where("vec_id % 20 = 0")))
    assert {q: [i for i, _ in v] for q, v in have.items()} == {q: [i for i, _ in v] for q, v in want.items()}


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(1, [0.0, 0.0])]])
def test_nothing_to_find(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert ann.nearest(df).collect() == []
