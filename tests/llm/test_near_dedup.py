import random

import numpy as np
import pytest

from wayframe.llm import common, near_dedup as nd


def brute(texts, size=5, share=(80, 100)):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and inter * share[1] >= share[0] * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=0, n=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([2, 6, 40, 150]))]
        texts.append(" ".join(base))
        for _ in range(rnd.choice([0, 0, 1, 3, 12])):
            edit = list(base)
            for _ in range(rnd.randrange(0, 1 + len(edit) // 40)):
                edit[rnd.randrange(len(edit))] = rnd.choice(vocab)
            texts.append(rnd.choice([" ", "\n"]).join(edit).upper() if rnd.random() < 0.2 else " ".join(edit))
    texts += ["", None, " \n\t", "one", "ONE", "one two", "É é", "é é", "w1 " * 30_000]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("size", [4, 5])
def test_against_brute_force(spark, size):
    rows = corpus(size)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, band string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(docs, size=size).collect()}
    assert got == brute(rows, size)


def test_chain_of_near_copies_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    rnd = random.Random(5)
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(150):  # each differs from the base in another place; between two copies the similarity is near the threshold
        edit = list(base)
        for _ in range(rnd.randrange(2, 5)):
            edit[rnd.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(edit)))
    rows += [(200 + i, " ".join(base)) for i in range(50)]
    chain = [f"c{i}" for i in range(100)]
    for i in range(30):
        chain = [*chain[3:], *(f"d{i}.{j}" for j in range(3))]
        rows.append((400 + i, " ".join(chain)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(docs, size=4).collect()}
    assert got == brute(rows, 4)


def test_odd_cases(spark):
    schema = "doc_id long, text string"
    assert nd.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, None), (3, None), (4, "")]
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in nd.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert got == sorted([("None", "None", True), ("1", "1", True), ("1", "1", True), ("2", "1", False), ("None", "None", True), ("3", "3", True), ("4", "4", True)])


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for j in (0.8, 0.9, 0.97):
        n = 2000
        common_part = round(n * 2 * j / (1 + j))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[:common_part], rng.integers(0, 1 << 63, n - common_part, dtype=np.uint64)])
        s = nd.odd_sketches(np.stack([nd.minhashes(a), nd.minhashes(b)])).view(np.uint64)
        z = int(np.bitwise_count(s[0] ^ s[1]).sum())
        assert z <= nd.MOST_BITS and abs(nd.sketch_similarity(z) - j) < 0.13


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 2)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}
    for a, b in links:
        if a is None or a == b:
            continue
        parent.setdefault(a, a), parent.setdefault(b, b)
        ra, rb = a, b
        while parent[ra] != ra:
            ra = parent[ra]
        while parent[rb] != rb:
            rb = parent[rb]
        parent[max(ra, rb)] = min(ra, rb)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    assert got == {x: find(x) for x in parent}
