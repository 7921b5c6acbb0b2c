import math
import random

import numpy as np
import pytest

from wayframe.llm import vectors as vs

SCHEMA = "vec_id long, embedding array<float>, label int, node string"
ODD = [(900, None, 0, ""), (901, [1.0, None, 2.0], 0, ""), (902, [float("nan")] * 8, 0, ""), (903, [float("inf")] * 8, 0, ""), (904, [0.0] * 8, 0, ""), (None, [1.0] * 8, 0, ""), (950, [], 0, "")]


def clustered(n, d, seed, noise=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 12), d))
    x = centres[rng.integers(0, len(centres), n)] + noise * rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, x, extra=()):
    return spark.createDataFrame([(i, [float(c) for c in v], i % 3, "z") for i, v in enumerate(x)] + list(extra), SCHEMA).repartition(3)


def brute_top(rows, every, k):
    fine = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for q in sorted(i for i in fine if i % every == 0):
        found = sorted(((-sum(a * b for a, b in zip(fine[q], fine[i], strict=False)), i) for i in fine if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


@pytest.mark.parametrize("n, limits", [(300, None), (300, (4, 16, 8)), (3, None)])
def test_top_k_is_exact(spark, monkeypatch, n, limits):
    if limits:
        for name, v in zip(("QUERIES_IN_GROUP", "ROWS_IN_BLOCK", "PIVOTS"), limits, strict=True):
            monkeypatch.setattr(vs, name, v)
    x = clustered(n, 8, 1)
    x[n // 2 :: 3] = x[0]  # ties
    got = vs.top_k(frame(spark, x, ODD), vs.F.col("vec_id") % 10 == 0, 5)
    rows = [(i, list(v)) for i, v in enumerate(x)] + [(r[0], r[1]) for r in ODD]
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 10, 5)


def test_top_k_prunes_and_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vs.top_k(empty, vs.F.col("vec_id") % 10 == 0).count() == 0
    assert vs.top_k(frame(spark, clustered(5, 4, 0)[1:2]), vs.F.col("vec_id") % 10 == 0).count() == 0


def test_products_of_large_integers():
    a = np.array([[2.0**27, 1.0]])
    assert vs.products(a, a)[0, 0] == 2**54 + 1


def brute_links(rows, least=0.9):
    fine = {i: np.array(v, np.float64) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    ids = sorted(fine)
    m = np.stack([fine[i] / np.linalg.norm(fine[i]) for i in ids])
    near = m @ m.T >= least
    np.fill_diagonal(near, False)
    parent = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(near), strict=True):
            low = min(parent[a], parent[b])
            if parent[a] != low or parent[b] != low:
                parent[a] = parent[b] = low
                changed = True
    out = {i: (0, i) for i, _ in rows}
    return out | {i: (int(near[k].sum()), ids[parent[k]]) for k, i in enumerate(ids)}


@pytest.mark.parametrize("block", [None, 8])
def test_near_vectors(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(vs, "BUCKET_BLOCK", block)
        monkeypatch.setattr(vs, "SUPER", 64)
    x = clustered(400, 16, 2, 0.05)
    x[350:] = x[0]  # copies
    x[300:340] = x[1] + np.random.default_rng(0).normal(size=(40, 16)).astype(np.float32) * 0.01  # a dense group
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vs.near_vectors(frame(spark, x, [o for o in ODD if o[0] != 950 and o[0] is not None])).collect()}
    want = brute_links(rows + [(o[0], o[1]) for o in ODD if o[0] not in (None, 950)])
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and got.keys() == want.keys()
    assert np.mean([got[i] == want[i] for i in want]) > 0.95
    assert got[904] == (0, 904) and got[900] == (0, 900)


def test_near_vectors_odd(spark):
    assert vs.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    r = vs.near_vectors(spark.createDataFrame([(None, [1.0, 2.0], 0, ""), (1, [1.0, 2.0], 0, ""), (2, [2.0, 4.0], 0, ""), (3, [1e30, 2e30], 0, "")], SCHEMA)).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id), x.kept) for x in r) == [("1", 2, "1", True), ("2", 2, "1", False), ("3", 2, "1", False), ("None", 0, "None", True)]


def test_hadamard_keeps_lengths():
    rng = random.Random(0)
    x = np.array([[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)])
    assert np.allclose(np.linalg.norm(vs.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(vs.hadamard(vs.hadamard(x)), x)


def test_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 0.5]), (2, [0.0, 0.5])]
    docs = spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in vs.top_k(docs, vs.F.col("vec_id") == 0, 2).collect())
    # the first row finds 1 and, by the smaller id, the other 0; the second finds both rows of 2
    assert got == [(0, 1, 1, 65536), (0, 1, 2, 32768), (0, 2, 0, 0), (0, 2, 2, 32768)]
