import math

import numpy as np
import pytest

from tallyboard.llm import hamming


def brute(rows, least=0.95):
    fine = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    sizes = [len(v) for (_, v), ok in zip(rows, fine, strict=True) if ok]
    usual = max(set(sizes), key=lambda n: (sizes.count(n), -n)) if sizes else 0
    fine = [ok and len(v) == usual for (_, v), ok in zip(rows, fine, strict=True)]
    x = np.array([v if ok else [0.0] * usual for (_, v), ok in zip(rows, fine, strict=True)], float).reshape(len(rows), usual)
    norm = np.linalg.norm(x, axis=1)
    norm[norm == 0] = 1
    near = (x @ x.T) / norm[:, None] / norm >= least
    fine = np.array(fine, bool)
    near &= fine[:, None] & fine
    np.fill_diagonal(near, False)
    out = []
    for k in range(len(rows)):
        seen, front = {k}, [k]
        while front:
            for m in np.flatnonzero(near[front.pop()]).tolist():
                if m not in seen:
                    seen.add(m)
                    front.append(m)
        ids = [rows[m][0] for m in seen if rows[m][0] is not None]
        out.append((rows[k][0], int(near[k].sum()), min(ids, default=None)))
    return sorted(out, key=repr)


def got(df):
    rows = df.collect()
    for r in rows:
        assert r.kept == (r.component_id is None if r.id is None else r.id == r.component_id)
    return sorted(((r.id, r.n_links, r.component_id) for r in rows), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in rows], "vec_id long, embedding array<double>, n_links string")


def clustered(seed, n, dims, groups, spread):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dims))
    x = centers[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dims))
    return [(int(i), (v * rng.uniform(0.1, 50)).tolist()) for i, v in zip(rng.permutation(n), x, strict=True)]


@pytest.mark.parametrize(("dims", "spread"), [(64, 0.1), (64, 0.22), (5, 0.15)])
def test_against_all_pairs(spark, dims, spread):
    rows = clustered(1, 700, dims, 60, spread)
    want, have = brute(rows), got(hamming.near_vectors(frame(spark, rows)))
    links = sum(n for _, n, _ in want)
    assert links and sum(n for _, n, _ in have) >= 0.995 * links
    assert all(h[1] <= w[1] for h, w in zip(have, want, strict=True))  # no link below the bound
    if spread == 0.1:
        assert have == want


def test_copies_and_one_large_group(spark, monkeypatch):
    monkeypatch.setattr(hamming, "HOME", 8)
    monkeypatch.setattr(hamming, "BLOCK", 16)
    monkeypatch.setattr(hamming, "PAIRS", 100)
    rng = np.random.default_rng(3)
    base, hot = rng.normal(size=32), rng.normal(size=32)
    rows = [(k, hot.tolist()) for k in range(300)] + [(k, (base + 0.03 * rng.normal(size=32)).tolist()) for k in range(300, 600)]
    rows += [(k, rng.normal(size=32).tolist()) for k in range(600, 900)]
    assert got(hamming.near_vectors(frame(spark, rows))) == brute(rows)


def test_recall_through_the_query(spark, tmp_path):
    """20,000 vectors, pairs just above the bound and uneven lengths."""
    from tallyboard.llm.queries import QUERIES

    rng = np.random.default_rng(5)
    x = rng.normal(size=(10_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1)[:, None] * x
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    cos = rng.uniform(0.951, 0.97, len(x))[:, None]
    y = (cos * x + np.sqrt(1 - cos**2) * aside) * rng.lognormal(0, 2, len(x))[:, None]
    rows = [(k, v) for k, v in enumerate(np.concatenate([x, y]).tolist())]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    have = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op13_near_vectors"](spark, str(tmp_path)).collect()}
    found = sum(have[k + 10_000] == (1, k) for k in range(10_000))
    assert len(have) == 20_000 and found >= 9_950


ODD = [
    (0, [1, 0, 0]), (1, [1, 0, 0]), (1, [2, 0, 0]), (2, [1, 0.01, -0.0]), (3, None), (4, [0, 0, 0]), (5, [1, None, 0]),
    (6, [float("nan"), 1, 0]), (7, [float("inf"), 1, 0]), (8, [1]), (9, []), (10, [0, 1, 0]), (None, [0, 1, 0]), (None, [0, 0, 1]), (12, [0, 1, -0.0]),
]


def test_odd_vectors(spark):
    assert got(hamming.near_vectors(frame(spark, ODD))) == brute(ODD)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(2, [0.5]), (1, [0.25]), (3, [-1.0])]])
def test_few_vectors(spark, rows):
    assert got(hamming.near_vectors(frame(spark, rows))) == brute(rows)


def test_cosine_next_to_the_bound():
    a = np.array([[1.0, 0.0]])
    b = np.array([[0.95, math.sqrt(1 - 0.95**2)], [0.95, math.sqrt(1 - 0.95**2) + 1e-9], [0.95, math.sqrt(1 - 0.95**2) - 1e-9]])
    near = hamming.cosines(a, b, 0.95)[0].tolist()
    assert near[1:] == [False, True]


def test_forest_spans_what_is_linked():
    near = np.zeros((6, 6), bool)
    for a, b in ((0, 3), (3, 5), (5, 0), (1, 2)):
        near[a, b] = near[b, a] = True
    edges = hamming.forest(near)
    assert len(edges) == 3 and {frozenset(e) for e in edges} <= {frozenset(e) for e in ((0, 3), (3, 5), (5, 0), (1, 2))}
