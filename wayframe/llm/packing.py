"""Sequence packing as a cutting-stock problem, by column generation.

Documents become token pieces: as many whole sequences as fit, a body whose
length is a multiple of UNIT, and a tail shorter than UNIT. The histogram of
body lengths (at most budget / UNIT - 1 classes, whatever the corpus) gives a
linear program over patterns, each the multiset of lengths in one sequence. Its
columns are priced by a knapsack dynamic program over the capacity. The
solution is rounded down, so each pattern it uses is filled; the bounded rest
is packed best fit first, tails filling the gaps. Pieces ranked within their
length then look up their sequence and offset by arithmetic alone.

At scale: one pass over the texts writes the pieces; the driver sees one count
for each length; ranks come from counts for each task and length, so a third
of all rows with one length is no hot key anywhere.
"""

from __future__ import annotations

import os
import re
import warnings
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayframe.llm.common import materialize, text_rows

BUDGET = 4096
UNIT = 16
WORDS = 400_000


#: Lower-case words of ASCII and Latin-1 alone, without apostrophes, and their splits: letters, one digit, signs.
SIMPLE = re.compile(r"[a-zß-öø-ÿ0-9!-&(-/:-@\[-`{-~]+")
SPLIT = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def byte_alphabet() -> dict[int, str]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Token ids of texts by a tokenizer file whose splits never cross white space and which lower-cases.

    Distinct words are encoded once and kept (at most WORDS of them), since a
    text's ids are those of its words in turn. For words that normalising
    leaves as they are (SIMPLE) the splits go straight to the file's BPE model;
    any others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # in a text their strings are ordinary
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # The short way must be this file's: what it splits and lower-cases is tried out.
        for word in ("it's", "a1b22", "x--(y)", "naïve", "ÜBER42%", "foo.bar_baz"):
            self.learn([w := word.encode().lower()])
            if self.known.pop(w) != np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes():
                raise ValueError(f"{path} splits or normalises words in another way")

    def part(self, part: str) -> bytes:
        if not part.isascii():
            written = "".join(map(self.alphabet.__getitem__, part.encode("utf-8")))
        else:
            written = part
        found = self.parts[part] = np.array([t.id for t in self.model.tokenize(written)], "<u4").tobytes()
        return found

    def learn(self, words: list[bytes]) -> None:
        hard, known, parts, part = [], self.known, self.parts, self.part
        if len(parts) > WORDS:
            parts.clear()
        for word in words:
            w = word.decode().lower()
            if SIMPLE.fullmatch(w):
                known[word] = b"".join([parts.get(p) or part(p) for p in SPLIT.findall(w)])
            else:
                hard.append(word)
        for word, e in zip(hard, self.tokenizer.encode_batch_fast([w.decode() for w in hard], add_special_tokens=False), strict=True):
            known[word] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        # Lower-casing A-Z first and splitting at ASCII white space change no ids.
        split = [t.encode("utf-8").lower().split() for t in texts]
        if len(self.known) > WORDS:
            self.known = {}
        self.learn(list({w for words in split for w in words}.difference(self.known)))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """An encoder for pack(): one for each Python worker."""

    def encode(texts: list[str]) -> list[bytes]:
        if path not in _ENCODERS:
            _ENCODERS[path] = WordEncoder(path)
        return _ENCODERS[path].encode(texts)

    return encode


# --- the cutting-stock problem, on counts alone ---


def knapsack(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most value of lengths 1..len(values)-1 (any number of each) within capacity, and how many of each."""
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    top = len(values) - 1
    for c in range(1, capacity + 1):
        k = min(c, top)
        with_item = values[1 : k + 1] + best[c - k : c][::-1]
        i = int(with_item.argmax())
        if with_item[i] > best[c - 1] + 1e-12:
            best[c], taken[c] = with_item[i], i + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(len(values), int), capacity
    while c > 0:
        if taken[c]:
            counts[taken[c]] += 1
            c -= taken[c]
        else:
            c -= 1
    return float(best[capacity]), counts


def fractional_patterns(demand: np.ndarray, capacity: int, gap: float = 2e-4, rounds: int = 3000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used in an optimal (within gap) fractional solution.

    demand[i]: pieces of length i, 1 <= i <= capacity. Revised simplex on the
    covering program; new columns come from the knapsack over its dual prices.
    Should the rounds run out, the patterns found so far serve: sequences are
    then less full, and a warning says so.
    """
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    need = demand[used].astype(float)
    basis = np.diag((capacity // used).astype(float))
    bound = float((used * need).sum()) / capacity
    for _ in range(rounds):
        x = np.linalg.solve(basis, need)
        prices = np.linalg.solve(basis.T, np.ones(len(used)))
        if x.sum() <= bound * (1 + gap):
            break
        values = np.full(capacity + 1, -1.0)
        values[used] = prices
        worth, counts = knapsack(values, capacity)
        if worth <= 1 + 1e-9:
            break
        column = counts[used].astype(float)
        way = np.linalg.solve(basis, column)
        ratio = np.where(way > 1e-9, np.maximum(x, 0) / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
    else:
        warnings.warn(f"column generation stopped after {rounds} rounds", stacklevel=2)
    x = np.linalg.solve(basis, need)
    found = []
    for k in range(len(used)):
        counts = np.zeros(capacity + 1, int)
        counts[used] = np.rint(basis[:, k]).astype(int)
        found.append((counts, max(0.0, float(x[k]))))
    return found


@dataclass
class Plan:
    """Patterns as {length: copies}, each with the number of sequences cut by it; all their slots are filled."""

    patterns: list[tuple[dict[int, int], int]]
    sequences: int

    def slots(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By length: the first rank of each run of slots, copies in a sequence, first sequence, first offset."""
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        first, taken = 0, Counter()
        for pattern, times in self.patterns:
            offset = 0
            for length in sorted(pattern, reverse=True):
                runs.setdefault(length, []).append((taken[length], pattern[length], first, offset))
                taken[length] += pattern[length] * times
                offset += length * pattern[length]
            first += times
        return {k: tuple(np.array(c, "i8") for c in zip(*v, strict=True)) for k, v in runs.items()}


def _whole_patterns(left: Counter, lengths: list[int], unit: int, capacity: int) -> list[tuple[dict[int, int], int]]:
    demand = np.zeros(capacity + 1, int)
    for n in lengths:
        demand[n // unit] = left[n]
    out = []
    for counts, x in sorted(fractional_patterns(demand, capacity), key=lambda f: -f[1]):
        pattern = {int(i) * unit: int(counts[i]) for i in np.flatnonzero(counts)}
        times = min([int(x + 1e-6), *(left[n] // k for n, k in pattern.items())]) if pattern else 0
        if times > 0:
            out.append((pattern, times))
            for n, k in pattern.items():
                left[n] -= k * times
    return out


def plan_sequences(counts: dict[int, int], budget: int = BUDGET, unit: int = UNIT) -> Plan:
    """Patterns for all pieces, given how many there are of each length (1..budget).

    Whole sequences stand alone. Bodies (multiples of unit) and tails have a
    program each, rounded down. What is left, at most a few sequences for each
    pattern, is packed best fit first, longest first.
    """
    left = Counter({int(k): int(v) for k, v in counts.items() if v})
    patterns: list[tuple[dict[int, int], int]] = []
    if left[budget]:
        patterns.append(({budget: 1}, left.pop(budget)))
    patterns += _whole_patterns(left, [n for n in left if n % unit == 0], unit, budget // unit)
    # Tails that the rest of the bodies can't take in their gaps.
    gaps = sum(n * k for n, k in left.items() if n % unit == 0)
    tails = sum(n * k for n, k in left.items() if n % unit)
    if tails > budget + gaps:
        patterns += _whole_patterns(left, [n for n in left if n % unit], 1, budget)
    rest: list[tuple[int, Counter]] = []
    for n in sorted((n for n in left if left[n] > 0), reverse=True):
        for _ in range(left[n]):
            fit = min((i for i, (room, _) in enumerate(rest) if room >= n), key=lambda i: rest[i][0], default=None)
            if fit is None:
                rest.append((budget - n, Counter({n: 1})))
            else:
                rest[fit] = (rest[fit][0] - n, rest[fit][1] + Counter({n: 1}))
    patterns += [(dict(p), 1) for _, p in rest]
    return Plan(patterns, sum(t for _, t in patterns))


# --- in Spark ---


def cut(n: int, budget: int = BUDGET, unit: int = UNIT) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    whole, rest = divmod(n, budget)
    lengths = [budget] * whole + [x for x in (rest - rest % unit, rest % unit) if x]
    out, at = [], 0
    for x in lengths:
        out.append((at, x))
        at += x
    return out


def pieces(docs: DataFrame, encode: Callable[[list[str]], list[bytes]], end_id: int, key: str = "doc_id", text: str = "text", budget: int = BUDGET, unit: int = UNIT, emit_ids: bool = True) -> DataFrame:
    """The pieces of every document, with the task that cut them and their rank there among pieces of their length."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, task int, task_rank long" + ", ids binary" * emit_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        ranks: Counter = Counter()
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                keys = part.column(0).to_pylist()
                rows = []
                for doc, ids in zip(keys, encode(texts), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start, length in cut(n, budget, unit):
                        own = ids[4 * start : 4 * (start + length)]
                        rows.append((doc, start, length, zlib.crc32(own), n, task, ranks[length], own))
                        ranks[length] += 1
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [part.column(0).type, *[pa.int64()] * 4, pa.int32(), pa.int64(), *[pa.binary()] * emit_ids], strict=False)]
                if rows:
                    yield pa.RecordBatch.from_arrays(cols, names=[key, "start", "length", "ids_crc32", "doc_tokens", "task", "task_rank", *["ids"] * emit_ids])

    return docs.select(docs[key].alias(key), docs[text].alias("_text")).mapInArrow(run, schema)


def pack(docs: DataFrame, encode: Callable[[list[str]], list[bytes]], end_id: int, key: str = "doc_id", text: str = "text", budget: int = BUDGET, unit: int = UNIT, emit_ids: bool = True) -> DataFrame:
    """Pack whole documents into sequences of at most budget tokens.

    Returns a row for each piece: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with emit_ids, its ids (little-endian unsigned
    32-bit). Each token lies in exactly one piece; offsets in a sequence have no
    gaps; sequences are numbered from 0 without gaps.

    A null or empty text has the end id alone. A null key is kept as null, and
    repeated rows are packed each by itself. Ties in length are ranked by where
    they were read, which changes who is where but not how many sequences there
    are. An empty table gives an empty result. Texts of any length are cut.
    Further columns aren't read, whatever their names.
    """
    spark = docs.sparkSession
    cutouts, _ = materialize(pieces(docs, encode, end_id, key, text, budget, unit, emit_ids), "pieces")
    by_task = cutouts.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranked = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), "n")
    ranked, _ = materialize(ranked, "ranks")
    totals = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(plan_sequences(totals, budget, unit).slots())  # bounded by the lengths

    out_schema = [f for f in cutouts.schema.fields if f.name not in ("task", "task_rank")]
    names = [f.name for f in out_schema]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out_schema) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = plan.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), "i8"), np.zeros(len(rank), "i8")
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                first, copies, sequences, offsets = slots[int(n)]
                run = np.searchsorted(first, rank[at], "right") - 1
                k, j = np.divmod(rank[at] - first[run], copies[run])
                sequence[at], offset[at] = sequences[run] + k, offsets[run] + j * n
            cols = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    placed = cutouts.join(ranked.drop("n"), ["task", "length"]).withColumn("rank", F.col("before") + F.col("task_rank"))
    return placed.select(*names, "rank").mapInArrow(place, schema)
