import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from wayframe.llm import pii, toxicity

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            s = m.group()
            digits = re.sub("[^0-9]", "", s)
            if kind == "ip" and any(int(p) > 255 for p in s.split(".")):
                continue
            if kind == "card":
                doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(d - 9 if d > 9 else d for d in doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], list(PATTERNS).index(x[0])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a0 12.@-+()5%é\n", max_size=40))
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_base_spans_of_numbers():
    rnd = random.Random(0)
    for _ in range(3000):
        text = "".join(rnd.choice(["4337166598464399", "4111 1111 1111 1111", "+1 (988) 555-2485", "10.0.0.", "255", "256.1.2.3", "x@y.z", "@a.b", " ", "-", "9"]) for _ in range(6))
        assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for unit in ("z", "1", "1.", "1 ", "@", "a@", "+1", "+1 (", "a=1"):
        text = unit * (200_000 // len(unit)) + " x@y.zz"
        list(pii.candidates(text, pii.base_spans(text)))


def test_find(spark):
    rows = [(i, f"w{i} AKIAMD62HKU6VBLCCCC{i % 10} foo password=e3b3ed3cc8548923d{i % 10} bar version 3. x 12.5 b") for i in range(40)]
    rows += [(100, None), (101, ""), (102, "plain words only"), (103, "mail a.b@c.de or 10.0.0.1 or 4337166598464399 or +1 (988) 555-2485."), (None, "x@y.zz"), (103, "same id"), (104, "Ch. 7, page 12, 1984")]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n_email int, spans string")
    got = pii.find(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id != 103}
    one = next(r for r in got if r.doc_id == 103 and r.n_email == 1)
    assert (one.n_ip, one.n_card, one.n_phone) == (1, 1, 1)
    assert one.masked_text == "mail [EMAIL] or [IP] or [CARD] or [PHONE]."
    assert by[None].n_email == 1 and by[100].masked_text is None and by[100].spans == "" and by[102].spans == "" and by[104].spans == ""
    assert all(by[i].spans.count("secret") == 2 for i in range(40)), by[0].spans
    assert by[3].masked_text == "w3 [SECRET] foo password=[SECRET] bar version 3. x 12.5 b"
    assert pii.find(docs.limit(0)).count() == 0


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.85, 0.8, 0.75, 0.7])  # with fewer, the reliabilities are barely identified
    votes = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    fitted = pii.Votes(patterns, n.astype(float))
    assert abs(fitted.prior[1] - 0.3) < 0.05
    assert np.allclose(fitted.table[1, :, 2], right, atol=0.05)


def toxic_docs(spark, n=400):
    rnd = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "omega", "the", "of"]
    rows, labels = [], []
    for i in range(n):
        text = [rnd.choice(words) + rnd.choice(["", "s", "ly"]) for _ in range(rnd.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(["insulta", "curseword", "slurrish"]))
        rows.append((i, " ".join(text), toxic))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame([(i, t, "z") for i, t, _ in rows] + [(None, "insulta curseword", "z"), (9999, None, "z"), (9998, "", "z"), (9997, "beta " * 20_000, "z"), (0, rows[0][1], "z")], "doc_id long, text string, toxic string")
    return rows, docs, spark.createDataFrame([*labels, (None, 1, 1), (1, None, None), (77777, 1, 1)], "doc_id long, quality int, toxic int")


def test_classify(spark):
    rows, docs, labels = toxic_docs(spark)
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(rows) + 5
    by = {r.doc_id: r.toxic for r in got}
    held = [(by[i], t) for i, _, t in rows if not (i % 2 == 0 or i % 3 == 0)] + [(by[i], t) for i, _, t in rows]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert by[None] and not by[9999] and not by[9998] and not by[9997]
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    none = toxicity.classify(docs, labels.limit(0)).collect()
    assert len(none) == len(got) and not any(r.toxic for r in none)


def test_later_links_use_earlier_probabilities():
    rng = np.random.default_rng(1)
    x = (rng.random((3000, 5)) < 0.3).astype(float)
    a = x[:, 0] > 0
    b = a & (x[:, 1] > 0)
    weights = toxicity.fit_chain(x, np.stack([a, b], 1), np.arange(3000) % 4)
    assert [len(w) for w in weights] == [6, 7]
    p = toxicity.Chain({str(i): i for i in range(5)}, weights).predict(x)
    assert ((p[:, 0] > 0.5) == a).mean() > 0.99 and ((p[:, 1] > 0.5) == b).mean() > 0.99


def test_a_capped_sample_keeps_the_balance_of_the_labels(spark, monkeypatch):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 12 == 0
        text = [rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(8)] + ["rude"] * (rnd.random() < (0.8 if toxic else 0.25))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    whole = toxicity.classify(docs, marks).collect()
    monkeypatch.setattr(toxicity, "SAMPLE", 100)
    capped = toxicity.classify(docs, marks).collect()
    assert not any(r.toxic for r in whole) and not any(r.toxic for r in capped)  # "rude" is toxic in one of four
    assert abs(np.mean([r.p_toxic for r in capped]) - 1 / 12) < 0.03
