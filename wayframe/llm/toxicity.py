"""Toxicity by classifier chains.

A chain of linear models predicts categories in turn; each later model also
sees the probabilities of the earlier categories. In training those come from
models that haven't seen the row (out of fold), as they will in use.

The training sample is bounded: at most SAMPLE labelled documents of each class,
those with the smallest hash of their id. Each sampled document weighs as many
labelled ones as it stands for, so the balance of the classes is that of all
labels at any table size. Features are words and word beginnings; the FEATURES
with the largest weighted chi-square are kept. Scoring reads every word of every
text, in one pass without a shuffle.

The label table has one toxicity label. Finer categories are labelled from it
weakly: a toxic document is an insult where it has a word of INSULTS, which name
a person, and contempt where it has one of CONTEMPT, which belittle. The chain
predicts insult, contempt and toxic in this order, from features that the labels
alone select; a document is rejected by toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayframe.llm.common import drop_path, materialize, text_rows
from wayframe.llm.pii import logistic

CATEGORIES = ("insult", "contempt", "toxic")
#: Words that label the finer categories among toxic documents.
INSULTS = frozenset("idiot idiots moron morons fool fools jerk jerks loser losers clown clowns scum bastard pig coward liar cretin imbecile trash".split())
CONTEMPT = frozenset("stupid dumb worthless pathetic disgusting useless ugly filthy vile despicable ridiculous contemptible repulsive hateful".split())
SAMPLE = 6_000
FEATURES = 256
LEAST = 5
FOLDS = 4
WORD = re.compile(r"\w+")


def features_of(text: str) -> set[str]:
    """Distinct lower-case words, and the first four and five letters of longer ones (marked by a star)."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:5] + "*" for w in words if len(w) > 5} | {w[:4] + "*" for w in words if len(w) > 4}


@dataclass
class Chain:
    vocabulary: dict[str, int]
    weights: list[np.ndarray]  # of category k: one for each feature, each earlier category, and the constant

    def present(self, text: str) -> list[int]:
        v = self.vocabulary
        return [v[f] for f in v.keys() & features_of(text)]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, one column for each category."""
        for w in self.weights:
            p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            x = np.hstack([x, p[:, None]])
        return x[:, x.shape[1] - len(self.weights) :]

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.vocabulary)))
        for i, t in enumerate(texts):
            x[i, self.present(t)] = 1
        return self.predict(x)


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray, weight: np.ndarray | None = None) -> list[np.ndarray]:
    """One model for each column of labels; a model's inputs end with out-of-fold probabilities of the earlier ones. Rows weigh 1 unless weight says."""
    weights = []
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        same, back = np.unique(np.hstack([x, y[:, None], fold[:, None]]).round(6), axis=0, return_inverse=True)
        count = np.bincount(back.ravel(), weight, len(same)).astype(float)
        rows, target, part = same[:, :-2], same[:, -2], same[:, -1]
        weights.append(logistic(rows, target, count, 3e-5, 12))
        apart = np.zeros(len(rows))
        for f in np.unique(part):
            own = part == f
            w = logistic(rows[~own], target[~own], count[~own], 3e-5, 12) if (~own).any() else np.zeros(rows.shape[1] + 1)
            apart[own] = 1 / (1 + np.exp(-np.clip(rows[own] @ w[:-1] + w[-1], -30, 30)))
        x = np.hstack([x, apart[back.ravel()][:, None]])
    return weights


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Chain | None:
    """The chain from labelled documents; None where a class has none of them."""
    marks = (
        labels.select(labels[key].alias("_key"), labels["toxic"].cast("int").alias("_toxic"))
        .where("_key is not null and _toxic is not null")
        .groupBy("_key")
        .agg(F.max("_toxic").alias("_toxic"))
    )
    known = marks.join(docs.select(docs[key].alias("_key")).where("_key is not null").distinct(), "_key", "left_semi")
    totals = dict(known.groupBy("_toxic").count().collect())
    ids = [known.where(F.col("_toxic") == c).orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE) for c in (0, 1)]
    picked, picked_path = materialize(ids[0].union(ids[1]), "picked")
    sample = (
        docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
        .join(F.broadcast(picked), "_key")  # at most 2 * SAMPLE rows of two numbers
        .groupBy("_key", "_toxic")
        .agg(F.max("_text").alias("_text"))
    )
    sample, path = materialize(sample, "sample")
    sizes = dict(sample.groupBy("_toxic").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                for c, t in zip(part.column(1).to_pylist(), texts, strict=True):
                    found[c == 1].update(features_of(t))
        names = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([f[n] for n in names], pa.int64()) for f in found)], names=["feature", "clean", "toxic"])

    n0, n1 = float(sizes[0]), float(sizes[1])
    w0, w1 = totals[0] / n0, totals[1] / n1
    gap = F.col("toxic") / n1 - F.col("clean") / n0
    mean = (F.col("toxic") * w1 + F.col("clean") * w0) / float(totals[0] + totals[1])
    top = (
        sample.select("_key", "_toxic", "_text")
        .mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") + F.col("clean") >= LEAST) & (F.col("clean") < n0 / 2))
        .orderBy((gap * gap / (mean * (1 - mean))).desc(), "feature")
        .limit(FEATURES)
        .collect()
    )
    chain = Chain({r.feature: i for i, r in enumerate(top)}, [])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                words = [set(WORD.findall(t.lower())) for t in texts]
                kinds = [pa.array([not w.isdisjoint(k) for w in words]) for k in (INSULTS, CONTEMPT)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *kinds, pa.array([chain.present(t) for t in texts], pa.list_(pa.int32()))], names=["key", "toxic", "insult", "contempt", "present"])

    rows = sample.select(F.xxhash64("_key").alias("key"), "_toxic", "_text").mapInArrow(mark, "key long, toxic int, insult boolean, contempt boolean, present array<int>").collect()
    drop_path(docs.sparkSession, picked_path, path)
    rows.sort(key=lambda r: r.key)
    x = np.zeros((len(rows), len(top)))
    for i, r in enumerate(rows):
        x[i, r.present] = 1
    toxic = np.array([r.toxic == 1 for r in rows])
    finer = [toxic & np.array([r[c] for r in rows]) for c in CATEGORIES[:-1]]
    chain.weights = fit_chain(x, np.stack([*finer, toxic], 1), np.arange(len(rows)) % FOLDS, np.where(toxic, w1, w0))
    return chain


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """The columns in keep, a probability for each category (p_ and its name), and toxic.

    One row for each row of docs, repeated ones too. A null text counts as
    empty. Labels that are null, or of documents that aren't there, are left
    out; where a document has several, the largest holds. Without a labelled
    document of both classes nothing can be learned: probabilities are null and
    toxic is false. Texts of any length count whole; columns not named aren't
    read; an empty table gives no rows.
    """
    chain = train(docs, labels, key, text)
    if chain is None:
        return docs.select(*(docs[k] for k in keep), *(F.lit(None).cast("double").alias(f"p_{c}") for c in CATEGORIES), F.lit(False).alias("toxic"))
    names = [*(f"_keep{i}" for i in range(len(keep))), *(f"p_{c}" for c in CATEGORIES)]
    schema = ", ".join([*(f"_keep{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keep)), *(f"p_{c} double" for c in CATEGORIES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), *map(pa.array, chain.score(texts).T)], names=names)

    out = docs.select(*(docs[k].alias(f"_keep{i}") for i, k in enumerate(keep)), docs[text].alias("_text")).mapInArrow(run, schema)
    return out.withColumnsRenamed({f"_keep{i}": k for i, k in enumerate(keep)}).withColumn("toxic", F.col("p_toxic") >= threshold)
