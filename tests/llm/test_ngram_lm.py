import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wayframe.llm import ngram_lm as lm


def split(text):
    return [*(text or "").encode().lower().split(), b"</s>"]


class Brute:
    """Interpolated modified Kneser-Ney from dictionaries of word tuples."""

    def __init__(self, texts, order):
        self.order, grams = order, [Counter() for _ in range(order + 1)]
        self.raw = Counter()
        for t in texts:
            w = [b"<s>"] * (order - 1) + split(t)
            for i in range(order - 1, len(w)):
                grams[order][tuple(w[i - order + 1 : i + 1])] += 1
                self.raw[w[i]] += 1
        for m in range(order - 1, 0, -1):
            for g in grams[m + 1]:
                grams[m][g[1:]] += 1
        self.grams = grams
        self.d = [None] + [lm.discounts([sum(c == k for c in grams[m].values()) for k in (1, 2, 3, 4)]) for m in range(1, order + 1)]
        self.by = [None] + [defaultdict(list) for _ in range(order)]
        for m in range(1, order + 1):
            for g, c in grams[m].items():
                self.by[m][g[:-1]].append(c)

    def p(self, context, word, m=None):
        m = self.order if m is None else m
        if m == 0:
            return 1 / (len(self.raw) + 1)
        context = tuple(context[len(context) - m + 1 :])
        counts, d = self.by[m].get(context), (0, *self.d[m])
        lower = self.p(context[1:], word, m - 1)
        if not counts:
            return lower
        c, total = self.grams[m][(*context, word)], sum(counts)
        return max(c - d[min(c, 3)], 0) / total + sum(d[min(x, 3)] for x in counts) / total * lower


def corpus(n=120):
    rnd = random.Random(0)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text, w = [], rnd.choice(vocab)
        for _ in range(rnd.randrange(0, 40)):
            w = vocab[(vocab.index(w) * 7 + rnd.randrange(6)) % 60]
            text.append(w.upper() if rnd.random() < 0.1 else w)
        rows.append((i, " ".join(text)))
    return [*rows, (900, None), (901, ""), (902, "never seen words é"), (903, "w1 " * 20_000)]


@pytest.mark.parametrize("order, shard", [(1, 1500), (2, 1500), (3, lm.SHARD), (3, 1500), (4, 30_000)])
def test_against_brute_force(spark, monkeypatch, order, shard):
    monkeypatch.setattr(lm, "SHARD", shard)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1.0, "q") for i, t in rows], "doc_id long, text string, score double, shard string").repartition(3)
    got = {r.doc_id: r for r in lm.score(docs, order=order).collect()}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    brute = Brute([t for i, t in rows if not out[i]], order)
    n, v = sum(brute.raw.values()), len(brute.raw)
    for i, t in rows:
        if i == 903:
            continue
        w, r = split(t), got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[i], len(w), n)
        assert r.n_known == sum(x in brute.raw for x in w)
        assert math.isclose(r.base_score, sum(math.log10((brute.raw[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
        padded = [b"<s>"] * (order - 1) + w
        want = sum(math.log10(brute.p(padded[k : k + order - 1], padded[k + order - 1])) for k in range(len(w)))
        assert math.isclose(r.score, want, rel_tol=1e-9), i
    some = [w.split() for _, w in rows[:3] if w]
    for words in some:
        context = words[-(order - 1) :] if order > 1 else []
        mass = sum(brute.p([c.lower().encode() for c in context], x) for x in [*brute.raw, b"<unseen>"])
        assert math.isclose(mass, 1, rel_tol=1e-9)


def test_held_out_gain(spark):
    docs = spark.createDataFrame(corpus(400), "doc_id long, text string")
    held = [r for r in lm.score(docs).collect() if r.held_out and r.doc_id < 900]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def test_odd_tables(spark):
    schema = "doc_id long, text string"
    assert lm.score(spark.createDataFrame([], schema)).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lm.score(spark.createDataFrame([(only, "a b")], schema)).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score) == (3, 0, 0, 0.0)
    rows = lm.score(spark.createDataFrame([(None, "a b"), (None, None), (2, "a"), (2, "a")], schema)).collect()
    assert len(rows) == 4 and all(np.isfinite(r.score) for r in rows)


def test_the_query_scores_with_trigrams(spark, tmp_path):
    from wayframe.llm.entries import op7_ngram_lm

    rows = corpus(60)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in op7_ngram_lm(spark, str(tmp_path)).collect()}
    brute = Brute([t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1], 3)
    for i, t in rows[:60]:
        w = [b"<s>"] * 2 + split(t)
        assert math.isclose(got[i], sum(math.log10(brute.p(w[k : k + 2], w[k + 2])) for k in range(len(w) - 2)), rel_tol=1e-9)
