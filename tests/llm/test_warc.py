import hashlib
import io
import random

import pytest
import zstandard

from wayframe.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, key string"


def pages():
    rnd = random.Random(0)
    rows = []
    for i in range(200):
        body = rnd.choice(["x" * 99, "y" * 100, "é" * 50, f"page {i} " * rnd.randrange(1, 300), ""])
        rows.append((i, f"http://h/{i}?q=a b\r\n&c=é", body))
    rows += [(500, None, None), (501, "u", "z" * 700_000), (502, "u", "z" * 700_000), (None, "n", "z" * 700_000), (None, "n", "only with a null key " * 9), (3, rows[3][1], rows[3][2])]
    rnd.shuffle(rows)
    return [(*r, "d", "k") for r in rows]


def brute(rows):
    first = {}
    for i, _, t, *_ in rows:
        b = (t or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, t, *_ in rows:
        b = (t or "").encode()
        f = first.get(b)
        revisit = f is not None and f != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_round_trip(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(warc, "FRAME", 1000)
        monkeypatch.setattr(warc, "LARGEST", 5000)
        monkeypatch.setattr(warc, "BUNDLE", 50_000)
    rows = pages()
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    by = {r[0]: (r[2] or "").encode() for r in rows}
    assert all(bytes(r.payload) == by[r.page_id] for r in got if r.record_type == "response" and r.page_id is not None)


def test_index_fetches_single_records(spark, tmp_path):
    rows = pages()
    index = warc.write(spark.createDataFrame(rows, SCHEMA).repartition(2), f"file://{tmp_path}").collect()
    assert len(index) == len(rows)
    for r in index[::7]:
        headers, body = warc.fetch(r.bundle, r.frame, r.offset, r.length)
        assert warc.key_of(headers["warc-record-id"]) == r.page_id
        if headers["warc-type"] == "response":
            assert hashlib.sha256(body).hexdigest() == headers["warc-payload-digest"][7:]


def test_bundle_is_plain_zstandard():
    w = warc.BundleWriter()
    records = [bytes([i]) * (i * 1000) for i in range(1, 200)]
    places = [w.add(r) for r in records]
    data = w.finish()
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read(1 << 26) for _ in range(1))
    assert whole == b"".join(records)
    reader = warc.BundleReader(io.BytesIO(data))
    assert len(reader.frames) > 10
    for r, (frame, offset) in list(zip(records, places, strict=True))[::-1]:
        assert reader.read(frame, offset, len(r)) == r


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
