import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from wayframe.llm import bpe, packing

DOCS = "doc_id long, text string, lang string, length string, task string"
ODD = ["", None, "a", "Hello, WORLD it's 12 \n\t x", "é" * 50 + " é", "z" * 30_000, "same text", "same text", "日本語 text", "\x1c a\xa0b"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def theirs(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.TextEncoder(ranks, P.PATTERN)


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x", "y") for i, t in enumerate(texts)], DOCS)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_encoder_agrees_with_tiktoken(encoder, theirs, text):
    ids = encoder.encode(text).tolist()
    assert ids == theirs.encode_ordinary(text)
    assert encoder.bpe.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=30), st.binary(max_size=12), st.integers(0, 30), st.integers(0, 30))
def test_appends_and_edits_are_exact(encoder, data, more, i, j):
    start, end = sorted((min(i, len(data)), min(j, len(data))))
    box = bpe.Editable(encoder.bpe, data)
    assert box.append(more) == bpe.Editable(encoder.bpe, data + more).ids()
    whole = data + more
    assert box.replace(start, end, b"the") == bpe.Editable(encoder.bpe, whole[:start] + b"the" + whole[end:]).ids()
    assert encoder.bpe.decode(box.ids()) == box.data


def test_one_long_run(encoder, theirs):
    for text in ("a" * 20_000, " " * 3_000 + "x", "ab" * 9_000):
        assert encoder.encode(text).tolist() == theirs.encode_ordinary(text)


def test_table(spark, theirs):
    d = docs(spark, ODD)
    got = {r.doc_id: r for r in bpe.encode_table(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, digests=True).collect()}
    assert len(got) == len(ODD)
    for i, t in enumerate(ODD):
        ids = theirs.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_table(d.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
    ids = {r.doc_id: r.ids for r in bpe.encode_table(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    assert ids[2] == theirs.encode_ordinary("a")


def brute_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def check_packed(rows, texts):
    ids = dict(enumerate(brute_ids(texts)))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(own) and r.doc_tokens == len(ids[r.doc_id])
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[doc])
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert set(by_seq) == set(range(len(by_seq)))
    total = sum(map(len, ids.values()))
    assert len(by_seq) <= total / 4096 + 2


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x2FF), st.sampled_from("aB'’ \u0301\u0307ΣςıİKÅẞﬁ日٣<|>"), st.characters(codec="utf-8")), max_size=30))
def test_word_encoder(text):
    own = packing.WordEncoder(P.path("word_bpe_49k.json")) if not packing._ENCODERS else next(iter(packing._ENCODERS.values()))
    packing._ENCODERS.setdefault("test", own)
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == brute_ids([text])[0][:-1]


def test_pack(spark):
    encode = packing.word_encoder(P.path("word_bpe_49k.json"))
    check_packed(packing.pack(docs(spark, ODD).repartition(3), encode, 2).collect(), ODD)
    many = [("word " * (37 * i % 5000)) for i in range(120)] + ["same size"] * 300
    check_packed(packing.pack(docs(spark, many).repartition(5), encode, 2, emit_ids=False).collect(), many)
    assert packing.pack(docs(spark, ODD).limit(0), encode, 2).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.integers(1, 500), max_size=25))
def test_plan_fills_every_slot(counts):
    plan = packing.plan_sequences(counts, 256, 8)
    used = defaultdict(int)
    for pattern, times in plan.patterns:
        assert sum(n * k for n, k in pattern.items()) <= 256
        for n, k in pattern.items():
            used[n] += k * times
    assert dict(used) == counts


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(0, 1), min_size=3, max_size=12), st.integers(5, 40))
def test_knapsack(values, capacity):
    values = np.array([-1.0, *values])
    worth, counts = packing.knapsack(values, capacity)
    best = [0.0] * (capacity + 1)
    for c in range(1, capacity + 1):
        best[c] = max([best[c - 1], *(best[c - i] + values[i] for i in range(1, min(c, len(values) - 1) + 1))])
    assert abs(worth - best[capacity]) < 1e-9
    assert abs(sum(values[i] * counts[i] for i in range(1, len(values))) - worth) < 1e-9
    assert sum(i * counts[i] for i in range(len(values))) <= capacity
