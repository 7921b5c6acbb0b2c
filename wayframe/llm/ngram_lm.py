"""Interpolated modified Kneser-Ney language model over word hashes.

Counting runs in Spark: every task reduces its n-grams to distinct ones with
counts and sends them, packed, to shards by the hash of their last word but one.
So a shard has all n-grams that end alike and all that share a context: it makes
every order down to bigrams, and the counts of contexts, by itself, and writes
sorted hash arrays to the shared folder. Words with more than a shard's share of
all tokens (told from a sample, which decides on nothing else) are hot, and so is
the start mark: n-grams with one of them in that place are spread by their last
two words, and the partial counts of their contexts are summed in a second pass,
as are unigrams. Shards hold SHARD bytes of text whatever the corpus; the driver
sees one row of sums for each and at most one hot word for each. Scoring workers
map the arrays into memory and look up the distinct n-grams of a block of texts.

Files of an order and shard: 64-bit hashes, sorted (in `starts` where each value
of the high 16 bits begins, in `middle` and `low` the others), counts (a
byte each; larger ones in `counts.large`, as 64-bit rows of index and value).
Contexts followed by more than one word, once, have rows in contexts and stats
(sum of counts, how many counts of 1, of 2, of 3 and more), those that end in hot
words in files of their own; any other context that is known has exactly that
one follower. No number is cut off.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayframe.llm.common import drop_path, fresh_path, materialize, text_rows
from wayframe.llm.near_dedup import mix, word_hashes, words_of

END, START = (np.uint64(xxhash.xxh64_intdigest(x, seed=7)) for x in (b"end of text", b"start of text"))
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
FLUSH, SHARD = 4_000_000, 16 << 20
#: Bytes of arrays that a worker holds where files can't be mapped.
HELD = 512 << 20


def join_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _P + right * _Q + np.uint64(1))


def chained(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of word runs, given their words from the first to the last."""
    key = columns[0]
    for c in columns[1:]:
        key = join_hash(key, c)
    return key


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the end of each text, one after another, and where the texts start."""
    parts, starts, at = [], [], 0
    for t in texts:
        h = word_hashes(words_of(t))
        starts.append(at)
        parts += [h, np.array([END])]
        at += len(h) + 1
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(starts, np.int64)


def runs(words: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """The words of every n-gram, a column for each place; start marks come before a text."""
    position = np.arange(len(words)) - np.repeat(starts, np.diff([*starts, len(words)]))
    out = [words]
    for j in range(1, order):
        before = np.full(len(words), START, np.uint64)
        there = np.flatnonzero(position >= j)
        before[there] = words[there - j]
        out.append(before)
    return out[::-1]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key the number of its value, and an index of each value."""
    code, found = pd.factorize(keys)
    where = np.empty(len(found), np.int64)
    where[code] = np.arange(len(keys))
    return code, where


def summed(columns: list[np.ndarray], weights: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of word columns with sums of their weights (exact below 2^53)."""
    code, where = distinct(chained(columns))
    return [c[where] for c in columns], [np.bincount(code, w, len(where)).astype(np.uint64) for w in weights]


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _planes(a: np.ndarray, kind: str) -> bytes:
    """First bytes of all numbers, then all second bytes and so on, which compress."""
    return np.ascontiguousarray(a.astype(kind).view(np.uint8).reshape(len(a), -1).T).tobytes()


def _pack(words: np.ndarray, code: np.ndarray, weights: list[np.ndarray]) -> bytes:
    order = np.argsort(code[max(0, len(code) - 2)], kind="stable")
    body = [_planes(np.diff(words, prepend=np.uint64(0)), "<u8"), *(_planes(c[order], "<u4") for c in code), *(_planes(w[order], "<u8") for w in weights)]
    return b"".join(x.to_bytes(8, "little") for x in (len(order), len(words), len(code))) + _ZIP.compress(b"".join(body))


def unpacked(blob: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    n, m, k = (int.from_bytes(blob[8 * i : 8 * i + 8], "little") for i in range(3))
    data = np.frombuffer(_UNZIP.decompress(blob[24:]), np.uint8)
    take = lambda at, count, size: np.ascontiguousarray(data[at : at + count * size].reshape(size, count).T).view(f"<u{size}").ravel()
    words, at = np.cumsum(take(0, m, 8), dtype=np.uint64), 8 * m
    columns = [words[take(at + 4 * n * i, n, 4)] for i in range(k)]
    at += 4 * n * k
    return columns, [take(i, n, 8) for i in range(at, len(data), 8 * n)]


def merged(blobs: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    parts = [unpacked(b) for b in blobs]
    join = lambda i: [np.concatenate(c) for c in zip(*(p[i] for p in parts), strict=True)]
    return summed(join(0), join(1))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def among(words: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Whether each word is one of the hot ones, which are sorted."""
    return hot[np.minimum(np.searchsorted(hot, words), len(hot) - 1)] == words


def leads(before: np.ndarray, last: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """What an n-gram's shard follows from: its last word but one, with the last one where that is hot."""
    return np.where(among(before, hot), join_hash(before, last), before)


def by_shard(lead: np.ndarray, columns: list[np.ndarray], weights: list[np.ndarray], shards: int) -> Iterator[tuple[int, bytes]]:
    shard = shard_of(lead, shards)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    # Words are numbered once; a pack's own numbers follow from which of them it has.
    words, code = _numbered(columns)
    code = code.reshape(len(columns), -1)
    for s in np.unique(shard).tolist():
        own = order[bounds[s] : bounds[s + 1]]
        there = np.zeros(len(words), bool)
        mine = code[:, own]
        there[mine.ravel()] = True
        number = np.cumsum(there) - 1
        yield s, _pack(words[there], number[mine], [w[own] for w in weights])


def _numbered(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of columns, sorted, and the number of each word."""
    code, where = distinct(np.concatenate(columns))
    words = np.concatenate(columns)[where]
    by_hash = np.argsort(words)
    number = np.empty(len(words), np.int64)
    number[by_hash] = np.arange(len(words))
    return words[by_hash], number[code]


# --- files in the shared folder ---


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def save(uri: str, array: np.ndarray) -> None:
    """Written under another name and then renamed, so a task that runs again leaves one whole file."""
    own = f"{uri}.{uuid.uuid4().hex}"
    system, path = _filesystem(own)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(np.ascontiguousarray(array).tobytes())
    system.move(path, _filesystem(uri)[1])


def save_keys(at: str, keys: np.ndarray) -> None:
    """Sorted keys."""
    save(f"{at}/starts", np.searchsorted(keys >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64)).astype("<u4"))
    save(f"{at}/middle", (keys >> np.uint64(32)).astype("<u2"))
    save(f"{at}/low", keys.astype("<u4"))


def save_stats(at: str, suffix: str, keys: np.ndarray, stats: np.ndarray) -> None:
    """Rows of contexts in the narrowest numbers that hold them all."""
    by_key = np.argsort(keys)
    save(f"{at}/contexts{suffix}", keys[by_key].astype("<u8"))
    save(f"{at}/stats{suffix}", stats[by_key].astype(next(f"<u{2**b}" for b in range(4) if int(stats.max()) < 256 ** 2**b)))


def save_counts(at: str, name: str, counts: np.ndarray) -> None:
    large = np.flatnonzero(counts >= 255)
    save(f"{at}/{name}", np.minimum(counts, 255).astype("u1"))
    save(f"{at}/{name}.large", np.stack([large.astype("<u8"), counts[large].astype("<u8")], 1))


_ARRAYS: OrderedDict[str, np.ndarray] = OrderedDict()


def mapped(uri: str, dtype: str, width: int = 1) -> np.ndarray:
    """The array mapped into memory; of a store without local paths, its bytes, of which HELD are kept."""
    if uri not in _ARRAYS:
        if urlparse(uri).scheme in ("", "file"):
            path = urlparse(uri).path
            flat = np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
        else:
            system, path = _filesystem(uri)
            with system.open_input_file(path) as f:
                flat = np.frombuffer(f.read(), dtype)
        _ARRAYS[uri] = flat.reshape(-1, width) if width > 1 else flat
        if len(_ARRAYS) > 20_000 or not isinstance(flat, np.memmap) and sum(a.nbytes for a in _ARRAYS.values() if not isinstance(a.base, np.memmap)) > HELD:
            while len(_ARRAYS) > 1 and (len(_ARRAYS) > 10_000 or sum(a.nbytes for a in _ARRAYS.values()) > HELD // 2):
                _ARRAYS.popitem(last=False)
    _ARRAYS.move_to_end(uri)
    return _ARRAYS[uri]


def find(at: str, keys: np.ndarray) -> np.ndarray:
    """Where each key stands among the sorted ones; -1 where it doesn't.

    The high 16 bits give the range, a binary search in it the middle 16, and
    the low 32 decide; few keys agree in the first 32 bits.
    """
    starts, middle, low = mapped(f"{at}/starts", "<u4"), mapped(f"{at}/middle", "<u2"), mapped(f"{at}/low", "<u4")
    last = len(low) - 1
    if last < 0:
        return np.full(len(keys), -1)
    high = (keys >> np.uint64(48)).astype(np.int64)
    first, end = starts[high].astype(np.int64), starts[high + 1].astype(np.int64)
    want, rest = (keys >> np.uint64(32)).astype(np.uint16), keys.astype(np.uint32)
    length = end - first
    for _ in range(int(length.max(initial=0)).bit_length()):
        half = length >> 1
        less = (middle.take(first + half, mode="clip") < want) & (length > 0)
        step = half + 1
        step *= less
        first += step
        length = np.where(less, length - step, half)
    out = np.full(len(keys), -1)
    open_ = np.arange(len(keys))
    while open_.size:
        at_ = first[open_]
        there = (at_ < end[open_]) & (middle.take(at_, mode="clip") == want[open_])
        open_, at_ = open_[there], at_[there]
        hit = low[at_] == rest[open_]
        out[open_[hit]] = at_[hit]
        open_ = open_[~hit]
        first[open_] += 1
    return out


# --- the model ---


@dataclass
class Order:
    discounts: tuple[float, float, float]
    total: float  # sum of counts; used in the lowest order, whose context is empty
    ones: float
    twos: float
    more: float


@dataclass
class Model:
    uri: str
    order: int
    shards: int
    levels: dict[int, Order]
    train_tokens: int
    vocabulary: int
    present: set[tuple[int, int]]  # the orders' shards that have n-grams
    local: set[tuple[int, int]]  # those that have rows of contexts
    spread: set[tuple[int, int]]  # and of contexts that end in hot words
    hot: np.ndarray

    def _each(self, lead: np.ndarray, level: int, there: set[tuple[int, int]]) -> Iterator[tuple[str, np.ndarray]]:
        """A shard's address and the rows that belong to it, sorted by their shards' hash."""
        order = np.argsort(lead)
        shard = shard_of(lead[order], self.shards)
        for s, e in zip(b := np.flatnonzero(np.diff(shard, prepend=-1)), [*b[1:], len(shard)], strict=True):
            if (level, int(shard[s])) in there:
                yield f"{self.uri}/{level}/{shard[s]}", order[s:e]

    def counts(self, level: int, name: str, lead: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Counts of n-grams, zero where there are none."""
        out = np.zeros(len(keys))
        for at, own in self._each(lead, level, self.present):
            i = find(at, keys[own])
            own, i = own[i >= 0], i[i >= 0]
            value = mapped(f"{at}/{name}", "u1")[i].astype(np.float64)
            if (full := np.flatnonzero(value == 255)).size:
                large = mapped(f"{at}/{name}.large", "<u8", 2)
                value[full] = large[np.searchsorted(large[:, 0], i[full].astype(np.uint64)), 1]
            out[own] = value
        return out

    def stats(self, level: int, last: np.ndarray, keys: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Sum of counts, and how many of 1, 2, and 3 and more, of contexts that end in the words last; known ones without a row have one follower, once."""
        out = np.where(known[:, None], np.array([1.0, 1.0, 0.0, 0.0]), 0.0)
        hot = among(last, self.hot)
        for suffix, part, there in (("", ~hot, self.local), (".hot", hot, self.spread)):
            part = np.flatnonzero(part)
            for at, rows in self._each((keys if suffix else last)[part], level, there):
                own = part[rows]
                contexts = mapped(f"{at}/contexts{suffix}", "<u8")
                i = np.minimum(np.searchsorted(contexts, keys[own]), len(contexts) - 1)
                hit = contexts[i] == keys[own]
                stats = mapped(f"{at}/stats{suffix}", "u1")
                out[own[hit]] = stats.view(f"<u{stats.size // (4 * len(contexts))}").reshape(-1, 4)[i[hit]]
        return out

    def probabilities(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The model's probability of each word after those before it in its text, and its plain training count."""
        code, where = distinct(words)
        word = words[where]
        low, raw, count = self.levels[1], self.counts(1, "raw", word, word), self.counts(1, "counts", word, word)
        uniform = 1 / (self.vocabulary + 1)
        if low.total:
            gamma = (low.discounts[0] * low.ones + low.discounts[1] * low.twos + low.discounts[2] * low.more) / low.total
            p = (_less(count, low.discounts) / low.total + gamma * uniform)[code]
        else:
            p = np.full(len(words), uniform)
        # An n-gram's context is the n-gram one order lower at the place before; marks stand before a text.
        before_word = np.empty_like(words)
        before_word[1:] = words[:-1]
        before_word[starts] = START
        here, names, last, mark = code, word, word, START
        for level in range(2, self.order + 1):
            d = self.levels[level].discounts
            before = np.empty(len(words), np.int64)
            before[1:] = here[:-1]
            before[starts] = len(names)
            context = np.append(names, mark)
            stats = self.stats(level, np.append(last, START), context, np.append(count > 0, False))
            gamma = np.where(stats[:, 0] > 0, stats[:, 1:] @ np.array(d) / np.maximum(stats[:, 0], 1), 1.0)
            here, where = distinct(before * len(word) + code)
            last = words[where]
            names = join_hash(context[before[where]], last)
            count = self.counts(level, "counts", leads(before_word[where], last, self.hot), names)
            p = (_less(count, d) / np.maximum(stats[before[where], 0], 1))[here] + gamma[before] * p
            mark = join_hash(np.array([mark]), np.array([START]))[0]
        return p, raw[code]


def _less(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3).astype(int)], 0)


def discounts(n: list[float]) -> tuple[float, float, float]:
    """For counts of 1, 2, and 3 and more, from how many n-grams have the counts 1 to 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    d = [k - (k + 1) * y * b / a if a else k * y for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(float(min(max(x, 0.05 * k), 0.95 * k)) for k, x in enumerate(d, 1))


def _sums(counts: np.ndarray, raw: np.ndarray) -> list[float]:
    return [*(float((counts == k).sum()) for k in (1, 2, 3, 4)), float((counts >= 3).sum()), float(counts.sum()), float(raw.sum()), float(len(counts))]


#: Rows between the passes: what is in a pack (the order whose contexts it counts, 1 for unigrams), sums of an order, or that a shard has rows of contexts.
ROW = "kind string, level int, shard int, pack binary, sums array<double>"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["kind", "level", "shard", "pack", "sums"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> dict[int, dict[int, list[bytes]]]:
    """Packs by shard and level."""
    found: dict[int, dict[int, list[bytes]]] = {}
    for batch in batches:
        for level, shard, pack in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("level", "shard", "pack")), strict=True):
            found.setdefault(shard, {}).setdefault(level, []).append(pack)
    return found


def _hot(texts: DataFrame, shards: int, sample: int = 2_000) -> np.ndarray:
    """Sorted words with more than a shard's share of the tokens of about `sample` texts, and the start mark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, parts in text_rows(batch, "_text"):
                words, _ = tokens(parts)
                code, where = distinct(words)
                yield pa.RecordBatch.from_arrays([pa.array(words[where].view(np.int64)), pa.array(np.bincount(code, minlength=len(where)))], names=["word", "n"])

    drawn = texts.where(F.pmod(F.xxhash64("_text"), F.lit(max(1, texts.count() // sample))) == 0)
    words = drawn.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words, path = materialize(words, "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    found = words.where(F.col("n") * shards > total).select("word").collect()  # fewer than there are shards
    drop_path(texts.sparkSession, path)
    return np.unique(np.array([START, *(np.uint64(r.word & 0xFFFFFFFFFFFFFFFF) for r in found)], np.uint64))


def train(docs: DataFrame, key: str, text: str, uses: Column, order: int = 2) -> Model:
    """Count the texts for which uses holds and write the model to the shared folder."""
    spark = docs.sparkSession
    uri = fresh_path(spark, "ngrams")
    if "://" not in uri:
        uri = f"file://{uri}"
    used = docs.where(uses).select(docs[text].alias("_text"))
    size = used.agg(F.sum(F.octet_length("_text") + F.lit(8))).first()[0] or 0
    shards = max(1, -(-int(size) // SHARD))
    hot = _hot(used, shards)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def out() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            columns, weights = summed(columns, [np.ones(len(columns[0]))])
            return _rows([("n-grams", order, s, blob, None) for s, blob in by_shard(leads(columns[-2], columns[-1], hot) if order > 1 else columns[0], columns, weights, shards)])

        for batch in batches:
            for _, texts in text_rows(batch, "_text"):
                words, starts = tokens(texts)
                held.append(runs(words, starts, order))
                size += len(words)
                if size >= FLUSH:
                    yield out()
                    size = 0
        if size:
            yield out()

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every order down to bigrams; sums of each, partial counts of contexts, and unigrams (with their plain counts)."""
        for shard, levels in _gathered(batches).items():
            columns, (counts,) = merged(levels.pop(order))
            raw = counts
            for level in range(order, 1, -1):
                at = f"{uri}/{level}/{shard}"
                keys = chained(columns)
                by_key = np.argsort(keys)
                save_counts(at, "counts", counts[by_key])
                save_keys(at, keys[by_key])
                rows = [("sums", level, shard, None, _sums(counts, raw))]
                followers = [counts, counts == 1, counts == 2, counts >= 3]
                spread = among(columns[-2], hot)
                if not spread.all():
                    context, stats = summed([c[~spread] for c in columns[:-1]], [f[~spread] for f in followers])
                    if (told := stats[0] != 1).any():
                        save_stats(at, "", chained(context)[told], np.stack(stats, 1)[told])
                        rows.append(("local", level, shard, None, None))
                if spread.any():
                    context, stats = summed([c[spread] for c in columns[:-1]], [f[spread] for f in followers])
                    key = chained(context)
                    rows += [("contexts", level, s, blob, None) for s, blob in by_shard(key, [key], [*stats, context[-1] == START], shards)]
                yield _rows(rows)
                columns, (counts, raw) = summed(columns[1:], [np.ones(len(counts)), raw])
            yield _rows([("unigrams", 1, s, blob, None) for s, blob in by_shard(columns[0], columns, [counts, raw], shards)])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Unigrams, and the contexts that don't have one follower, once."""
        for shard, levels in _gathered(batches).items():
            rows = []
            for level, packs in levels.items():
                columns, weights = merged(packs)
                keys, at = columns[-1], f"{uri}/{level}/{shard}"
                if level == 1:
                    by_key = np.argsort(keys)
                    counts, raw = weights[0], weights[-1]
                    save_counts(at, "counts", counts[by_key])
                    save_counts(at, "raw", raw[by_key])
                    save_keys(at, keys[by_key])
                    rows.append(("sums", 1, shard, None, _sums(counts, raw)))
                elif (told := (weights[0] != 1) | (weights[4] > 0)).any():
                    save_stats(at, ".hot", keys[told], np.stack(weights[:4], 1)[told])
                    rows.append(("spread", level, shard, None, None))
            if rows:
                yield _rows(rows)

    packs = used.mapInArrow(count, ROW).repartitionById(shards, "shard")
    made = []
    if order > 1:
        found, path = materialize(packs.mapInArrow(orders, ROW), "orders")
        made.append(path)
        packs = found.where("pack is not null").repartitionById(shards, "shard")
    last, path = materialize(packs.mapInArrow(rest, ROW), "unigrams")
    made.append(path)
    told = last if order == 1 else last.unionByName(found.where("pack is null"))
    summary = told.select("kind", "level", "shard", "sums").collect()  # a row a shard and order
    drop_path(spark, *made)
    levels: dict[int, Order] = {}
    for level in range(1, order + 1):
        n1, n2, n3, n4, more, sum_, raw, kinds = np.sum([np.zeros(8), *(r.sums for r in summary if r.kind == "sums" and r.level == level)], axis=0).tolist()
        levels[level] = Order(discounts([n1, n2, n3, n4]), sum_, n1, n2, more)
        if level == 1:
            train_tokens, vocabulary = int(raw), int(kinds)
    shards_with = lambda kind: {(r.level, r.shard) for r in summary if r.kind == kind}
    return Model(uri, order, shards, levels, train_tokens, vocabulary, shards_with("sums"), shards_with("local"), shards_with("spread"), hot)


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its key as text, modulo 5, is 1. A null key isn't."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = 2) -> DataFrame:
    """Train on the documents not held out and score all of them.

    One row for each row: key, held_out, n_tokens (words and one end), n_known
    (tokens seen in training), train_tokens, base_score (log10 by add-half
    unigrams), score (log10 by the model) and perplexity (10^(-score/n_tokens)).

    A null or empty text is its end alone. A null key is kept and trains.
    Repeated rows count each. With nothing to train on, every token has
    probability 1 / (0 + 1). Columns not named aren't read; an empty table gives
    no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(docs[key].alias(key), docs[text].alias(text))
    model = train(docs, key, text, ~held_out(key), order)
    n, v = model.train_tokens, model.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_rows(batch, "_text", 6_000_000):
                words, starts = tokens(texts)
                p, count = model.probabilities(words, starts)
                sizes = np.diff([*starts, len(words)])
                total = np.add.reduceat(np.log10(p), starts)
                cols = [
                    *(part.column(i) for i in range(2)),
                    pa.array(sizes.astype("i8")),
                    pa.array(np.add.reduceat((count > 0).astype("i8"), starts)),
                    pa.array(np.full(len(starts), n, "i8")),
                    pa.array(np.add.reduceat(np.log10((count + 0.5) / (n + 0.5 * (v + 1))), starts)),
                    pa.array(total),
                    pa.array(10 ** np.minimum(-total / sizes, 300)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    schema = f"{key} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return docs.select(key, held_out(key).alias("held_out"), F.col(text).alias("_text")).mapInArrow(run, schema)
