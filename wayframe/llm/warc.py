"""WARC archives as seekable Zstandard bundles.

A bundle is a sequence of independent frames, each with the records that fit
into FRAME bytes (a larger record has frames of its own), and at its end a seek
table in a skippable frame: the compressed and raw size of every frame. The
index maps a record to its bundle, frame, offset in that frame's raw bytes, and
length, so one frame is read for one record. Bundles end at BUNDLE raw bytes.

Records are deduplicated by payload: of equal payloads only that of the
smallest key is stored. Copies are found on digests alone, pre-aggregated.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayframe.llm.common import drop_path, fresh_path, materialize, text_rows

FRAME, BUNDLE, LARGEST = 256 << 10, 64 << 20, 64 << 20
TABLE_MAGIC, SKIPPABLE = 0x8F92EAB1, 0x184D2A5E
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


class BundleWriter:
    """Collects records; gives (frame, offset) of each, and the whole bundle's bytes."""

    def __init__(self, level: int = 3):
        self._zip = zstandard.ZstdCompressor(level=level)
        self._out: list[bytes] = []
        self._sizes: list[tuple[int, int]] = []
        self._open: list[bytes] = []
        self._raw = self.raw = 0

    def _close(self, raw: bytes) -> None:
        data = self._zip.compress(raw)
        self._out.append(data)
        self._sizes.append((len(data), len(raw)))

    def _flush(self) -> None:
        if self._open:
            self._close(b"".join(self._open))
            self._open, self._raw = [], 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self._raw and self._raw + len(record) > FRAME:
            self._flush()
        at = (len(self._sizes), self._raw)
        self.raw += len(record)
        if len(record) > LARGEST:
            for i in range(0, len(record), LARGEST):
                self._close(record[i : i + LARGEST])
        else:
            self._open.append(record)
            self._raw += len(record)
        return at

    def finish(self) -> bytes:
        self._flush()
        table = b"".join(struct.pack("<II", *s) for s in self._sizes) + struct.pack("<IBI", len(self._sizes), 0, TABLE_MAGIC)
        return b"".join([*self._out, struct.pack("<II", SKIPPABLE, len(table)), table])


class BundleReader:
    """Random access to a bundle in any file that can seek."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        end = file.tell()
        file.seek(end - 9)
        frames, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != TABLE_MAGIC:
            raise ValueError("no seek table at the end")
        entry = 12 if flags & 0x80 else 8
        file.seek(end - 9 - entry * frames)
        table = file.read(entry * frames)
        self.frames, at = [], 0
        for i in range(frames):
            packed, raw = struct.unpack_from("<II", table, entry * i)
            self.frames.append((at, packed, raw))
            at += packed
        self._held: tuple[int, bytes] = (-1, b"")

    def frame(self, i: int) -> bytes:
        if self._held[0] != i:
            at, packed, raw = self.frames[i]
            self.file.seek(at)
            self._held = (i, zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=raw))
        return self._held[1]

    def read(self, frame: int, offset: int, length: int) -> bytes:
        parts = []
        while length > 0:
            part = self.frame(frame)[offset : offset + length]
            parts.append(part)
            length -= len(part)
            frame, offset = frame + 1, 0
        return b"".join(parts)


def record_id(key: object) -> str:
    """Integers as they are, other keys as quoted text; a null key is none (the text "none" is quoted in full)."""
    if key is None:
        return "<urn:x-record:none>"
    return f"<urn:x-record:{key if isinstance(key, int) else 'text:' + quote(str(key), safe='')}>"


def key_of(name: str) -> int | str | None:
    value = name[len("<urn:x-record:") : -1]
    return None if value == "none" else unquote(value[5:]) if value.startswith("text:") else int(value)


def make_record(key: object, url: str | None, payload: bytes, digest: str, refers_to: object, date: str) -> bytes:
    revisit = refers_to is not None
    block = b"" if revisit else HTTP % len(payload) + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._' + chr(39))}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}"]
    else:
        lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the payload (empty for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2] if headers["warc-type"] == "response" else b""


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row into bundles below folder; return their index.

    The index has key, bundle (its address), frame, offset, length. Of rows with
    equal payloads of at least `least` bytes the smallest key's is a response and
    the others are revisits of it; all other rows are responses. A null payload
    counts as empty, a null url is left out. Rows with a null key are revisits if
    another row with a key has their payload, else responses. Repeated rows with
    the smallest key are responses each. An empty table writes nothing. Keys are
    integers or strings; further columns aren't read, whatever their names.

    A bundle's name is new in every attempt of a task, and the index names those
    of the attempts that counted, so tasks may run again.
    """
    kind = pages.schema[key].dataType.simpleString()
    plain = pages.select(pages[key].alias("key"), pages[url].cast("string").alias("url"), F.coalesce(pages[payload], F.lit("")).alias("html"))
    digest = F.sha2(F.col("html").cast("binary"), 256)
    long_ = F.octet_length("html") >= least
    firsts = plain.where(long_).select(digest.alias("d"), "key").groupBy("d").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").select("d", "first")
    rows = plain.withColumn("digest", digest).join(firsts, (F.col("digest") == F.col("d")) & long_, "left")
    rows = rows.select("key", "url", "html", "digest", F.when(F.col("key").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bundle, name = [], BundleWriter(), ""

        def done() -> pa.RecordBatch:
            system, path = _open(name)
            system.create_dir(os.path.dirname(path), recursive=True)
            with system.open_output_stream(path, compression=None) as out:
                out.write(bundle.finish())
            cols = list(zip(*held, strict=True))
            types = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(cols[0], key_type), *(pa.array(c, t) for c, t in zip(cols[1:], types, strict=True))], names=["key", "bundle", "frame", "offset", "length"])

        for batch in batches:
            key_type = batch.column(0).type
            for part, texts in text_rows(batch, "html"):
                columns = [part.column(i).to_pylist() for i in (0, 1, 3, 4)]
                for k, u, d, first, t in zip(*columns, texts, strict=True):
                    name = name or f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    record = make_record(k, u, t.encode("utf-8"), d, first, date)
                    frame, offset = bundle.add(record)
                    held.append((k, name, frame, offset, len(record)))
                    if bundle.raw >= BUNDLE:
                        yield done()
                        held, bundle, name = [], BundleWriter(), ""
        if held:
            yield done()

    return rows.mapInArrow(run, f"key {kind}, bundle string, frame int, offset long, length long").withColumnRenamed("key", key)


def fetch(bundle: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry, reading the seek table and its frame only."""
    system, path = _open(bundle)
    with system.open_input_file(path) as f:
        return parse_record(BundleReader(f).read(frame, offset, length))


def read(index: DataFrame, key: str = "page_id", payloads: bool = True) -> DataFrame:
    """Read every bundle of an index back: key, payload_bytes, payload_digest, record_type, refers_to and, with payloads, the payload.

    The digest of a stored payload is computed anew; if it isn't the recorded
    one, the read fails. A revisit's length and digest are the recorded ones.
    """
    kind = index.schema[key].dataType.simpleString()
    by_bundle = index.groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset", "length")).alias("records"))  # bounded by a bundle
    schema = f"key {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}" + ", payload binary" * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = _open(name)
                with system.open_input_file(path) as f:
                    reader, rows, size = BundleReader(f), [], 0
                    for r in sorted(records, key=lambda r: (r["frame"], r["offset"])):
                        h, body = parse_record(reader.read(r["frame"], r["offset"], r["length"]))
                        digest = h["warc-payload-digest"].removeprefix("sha256:")
                        if h["warc-type"] == "response" and (hashlib.sha256(body).hexdigest() != digest or len(body) != int(h["x-payload-length"])):
                            raise ValueError(f"{h['warc-record-id']} of {name} is damaged")
                        refers = h.get("warc-refers-to")
                        rows.append((key_of(h["warc-record-id"]), int(h["x-payload-length"]), digest, h["warc-type"], refers and key_of(refers), body))
                        size += len(body)
                        if size > 16 << 20:
                            yield _rows(rows, payloads)
                            rows, size = [], 0
                    if rows:
                        yield _rows(rows, payloads)

    def _rows(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
        number = {"int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}.get(kind, pa.int64())
        types = [number, pa.int64(), pa.string(), pa.string(), number, *[pa.binary()] * payloads]
        names = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)], names=names)

    return by_bundle.repartition(max(1, index.select("bundle").distinct().count())).mapInArrow(run, schema).withColumnRenamed("key", key)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", payloads: bool = True) -> DataFrame:
    """write() to a new folder in the shared one, then read()."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    folder = folder if "://" in folder else f"file://{folder}"
    index, index_path = materialize(write(pages, folder, key, url, payload), "warc-index")
    out, _ = materialize(read(index, key, payloads), "warc-read")
    if not payloads:
        drop_path(spark, folder, index_path)
    return out
