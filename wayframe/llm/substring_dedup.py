"""Substring dedup by sliding sentence spans.

A text falls into units: sentences, where those of more than LONG words are cut
further after the word of the smallest hash of every WINDOW consecutive ones, so
that the cuts are the same wherever the passage stands, and at most WINDOW words
apart. A span is the shortest run of at least RUN consecutive units with at least
WORDS words; there is one from each unit on. In a passage of 51 words the first
shared cut comes after at most 12 words, a span from there has at most 31, and
only the last 8 words can be cut differently: it always holds a span. Spans are
hashed and joined over the whole corpus. What a span covers is removed unless
it is the span's first occurrence: in the smallest key, and there the first.

Only hashes travel until the end: one row for each distinct span of a document.
How often a span occurs is pre-aggregated, and the join with the repeated spans
can be split, so a passage in a third of all documents is no hot task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayframe.llm.common import drop_path, materialize, text_rows

RUN, WORDS, LONG, WINDOW = 3, 24, 8, 7
BOUNDARY = re.compile(r"[.!?]+\s+|\s*\n\s*")
WORD = re.compile(r"[^ \t\n\r\v\f]+[ \t\n\r\v\f]*")  # as bytes.split() splits


def cuts(words: list[bytes]) -> list[int]:
    """How many words come before each cut: after the least hash of every WINDOW words, the last one of equal ones."""
    h, out, best = [*map(zlib.crc32, words)], [], -1
    for j in range(WINDOW - 1, len(h)):
        if best <= j - WINDOW:
            own = h[j - WINDOW + 1 : j + 1]
            best = j - own[::-1].index(min(own))
            out.append(best + 1)
        elif h[j] <= h[best]:
            best = j
            out.append(j + 1)
    return out if out and out[-1] == len(h) else [*out, len(h)]


def units(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, words, hash) of the units, which together are the whole text."""
    out = []
    add = lambda s, e, words: out.append((s, e, len(words), xxhash.xxh64_intdigest(b" ".join(words)))) if words or s < e else None
    start = 0
    for end in [*(m.end() for m in BOUNDARY.finditer(text)), len(text)]:
        if end == start:
            continue
        words = text[start:end].encode("utf-8", "surrogatepass").split()
        if len(words) <= LONG:
            add(start, end, words)
        else:
            ends, at, last = [m.end() for m in WORD.finditer(text, start, end)], start, 0
            for cut in cuts(words):
                add(at, ends[cut - 1], words[last:cut])
                at, last = ends[cut - 1], cut
        start = end
    return out


def spans(parts: list[tuple[int, int, int, int]], run: int = RUN, least: int = WORDS) -> list[tuple[int, int, int]]:
    """(first unit, unit after the last, signed hash) of the span from each unit on that has one."""
    if len(parts) < run:
        return []
    sums = np.concatenate([[0], np.cumsum([p[2] for p in parts])])
    ends = np.maximum(np.searchsorted(sums, sums[:-1] + least, "left"), np.arange(len(parts)) + run)
    hashes = np.array([p[3] for p in parts], np.uint64).tobytes()
    return [(i, int(j), xxhash.xxh64_intdigest(hashes[8 * i : 8 * j]) - (1 << 63)) for i, j in enumerate(ends) if j <= len(parts)]


def remove(text: str, repeated: set[int], run: int = RUN, least: int = WORDS) -> tuple[str, int, int]:
    """The text without units covered by repeated spans or by a span seen before in it; how many units it had and lost."""
    parts = units(text)
    gone, seen = np.zeros(len(parts), bool), set()
    for i, j, h in spans(parts, run, least):
        if h in repeated or h in seen:
            gone[i:j] = True
        seen.add(h)
    if not gone.any():
        return text, len(parts), 0
    return "".join(text[p[0] : p[1]] for p, g in zip(parts, gone, strict=True) if not g), len(parts), int(gone.sum())


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", run: int = RUN, least: int = WORDS) -> DataFrame:
    """docs with its text cleaned, and how many units (n_units) it had and how many went (n_removed).

    One row for each row. A null text stays null, with zero units. Rows with a
    null key take no part and keep their texts. Rows that share a key are one
    document: a span that only they have isn't repeated. A repetition within a
    text goes, its first occurrence stays. Texts shorter than a span are kept;
    texts of any length count whole. Further columns are carried, whatever their
    names, but those named n_units and n_removed give way to the operator's. An
    empty table gives none.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                own = [np.array(list({h for _, _, h in spans(units(t), run, least)}), "i8") for t in texts]
                ids = part.column(0).take(pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own])))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate([np.zeros(0, "i8"), *own]))], names=["id", "span"])

    found, path = materialize(docs.select(docs[key].alias("id"), docs[text].alias("_text")).where("id is not null").mapInArrow(hashes, f"id {kind}, span long"), "spans")
    repeated = found.groupBy("span").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("span", "first")
    later = found.join(repeated, "span").where("id > first").select("id", "span")
    by_doc, _ = materialize(later.groupBy("id").agg(F.collect_set("span").alias("_spans")), "repeats")
    drop_path(spark, path)

    plain = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    carried = docs.select(*(docs[c].alias(n) for c, n in plain.items())).join(by_doc.withColumnRenamed("id", "_id"), F.col(plain[key]) == F.col("_id"), "left").drop("_id")
    others = [n for c, n in plain.items() if c != text]
    ready = carried.select(*others, F.col(plain[text]).alias("_text"), F.when(F.col(plain[key]).isNotNull(), F.coalesce("_spans", F.array().cast("array<bigint>"))).alias("_spans"))
    fields = {f.name: f.dataType.simpleString() for f in carried.schema.fields}
    schema = ", ".join([*(f"{n} {fields[n]}" for n in others), f"{plain[text]} string, n_units long, n_removed long"])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(others)
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                rows = []
                for t, there, gone in zip(texts, part.column(k).is_valid().to_pylist(), part.column(k + 1).to_pylist(), strict=True):
                    new, n, lost = (t, len(units(t)), 0) if gone is None else remove(t, set(gone), run, least)
                    rows.append((new if there else None, n, lost))
                cols = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(k)), *cols], names=[*others, plain[text], "n_units", "n_removed"])

    out = ready.mapInArrow(clean, schema)
    named = [F.col(n).alias(c) for c, n in plain.items() if c not in ("n_units", "n_removed")]
    return out.select(*named, "n_units", "n_removed")
