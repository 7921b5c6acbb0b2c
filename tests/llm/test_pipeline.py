"""The whole pipeline against brute-force versions of its stages, each on its own input."""

import random

import corpus_pipeline as cp
import pytest
from test_near_dedup import brute as near_brute
from test_packing_bpe import brute_ids
from test_pii_toxicity import brute as pii_brute
from test_substring_dedup import brute as repeat_brute

from wayframe.llm import pii


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(6)
    vocab = [f"word{i}" for i in range(300)]
    sentence = lambda n: " ".join(rnd.choice(vocab) for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(12) for _ in range(6))
    rows, toxic = [], {}
    for i in range(240):
        text = [sentence(rnd.randrange(4, 15)) for _ in range(rnd.randrange(3, 20))]
        if i % 5 == 0:
            toxic[i] = 1
            text = [t + " Cursing slurry insulted!" for t in text]
        elif i % 6 == 0:
            text.insert(1, passage)
        elif i % 7 == 0:
            text.append(f"Write to a{i}@mail.example.com or 10.0.0.{i % 250} password=e3b3ed3cc8548923d{i % 10}.")
        rows.append((i, " ".join(text)))
    rows += [(300 + i, rows[i * 7 + 1][1].replace("word1 ", "word2 ", 1)) for i in range(20)]
    rows += [(500, None), (501, ""), (502, "lone")]
    out = tmp_path_factory.mktemp("sf")
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    labels = [(i, 1, toxic.get(i, 0)) for i in range(240) if i % 2 == 0 or i % 5 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out), dict(rows), set(toxic)


def test_stages(spark, corpus, tmp_path):
    folder, texts, toxic = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == list(cp.COLUMNS)
            seen[name] = {r.doc_id: r.text for r in docs.collect()}
    copies_of_toxic = {300 + i for i in range(20) if i * 7 + 1 in toxic}
    assert set(seen["toxicity"]) == set(texts) - toxic - copies_of_toxic
    kept = near_brute(list(seen["toxicity"].items()), 5)
    assert set(seen["near_dedup"]) == {i for i, (_, c) in kept.items() if i == c}
    want = repeat_brute(list(seen["near_dedup"].items()))
    assert {i: t for i, t in seen["substring_dedup"].items() if t is not None} == want
    for i, t in seen["pii"].items():
        before = seen["substring_dedup"][i]
        assert (t is None) == (before is None)
        assert not pii_brute(t or "") and "password=e3" not in (t or "")
        if before and not pii_brute(before):
            assert t == before
    ids = dict(zip(seen["pii"], brute_ids(seen["pii"].values()), strict=True))
    rows = docs.collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values())) and {r.doc_id for r in rows} == set(ids)
    assert all(r.doc_tokens == len(ids[r.doc_id]) for r in rows)
    assert pii.KINDS[-1] == "secret"
    again = cp.run(spark, folder)
    assert again.count() == len(rows)


def test_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row int, toxic string, component_id long"
    words = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, words), (5, words), (5, other), (7, other + " tail"), (7, other + " tail"), (None, words), (None, None), (8, ""), (8, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1, "x", 3) for i, t in rows], schema)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    left = sorted(((r.doc_id, r.text) for r in cp.drop_near_copies(spark, docs, str(tmp_path)).collect()), key=str)
    assert left == sorted([(1, words), (5, other), (None, words), (None, None), (8, ""), (8, ""), (9, None)], key=str)
    once = docs.where("doc_id = 7").union(docs.where("doc_id = 1"))
    assert sorted(r.doc_id for r in cp.drop_near_copies(spark, once, str(tmp_path)).collect()) == [1, 7]
    out = cp.run(spark, str(tmp_path)).collect()
    assert len({(r.doc_id, r.sequence_id, r.offset) for r in out}) == len(out) and all(len(r.ids) == 4 * r.length for r in out)
    assert sum(r.doc_tokens == 1 for r in out) == 4


def test_an_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
