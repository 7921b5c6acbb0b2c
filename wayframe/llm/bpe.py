"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a byte string there is exactly one token with which the
BPE encoding of that prefix ends. The table of these last tokens is built from
left to right: a token that is a suffix of the prefix is the last one if and
only if it may follow the last token of what stands before it. Reading the
table backwards gives the encoding; a longer string only extends the table, and
an edit leaves the part before it as it is. The time is linear in the length
whatever the input, so a run of one character of any length is no special case.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wayframe.llm.common import text_rows

MEMO = 1_000_000
PIECES = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixBPE:
    """Exact BPE over ranks (token bytes to id; a lower id is merged first)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.tokens[i] = t
        # Every suffix of a token: its id, or -1 where it is no token itself.
        self.suffixes: dict[bytes, int] = {}
        for t, i in ranks.items():
            for k in range(1, len(t)):
                self.suffixes.setdefault(t[k:], -1)
        self.suffixes.update(ranks)
        self._memo: dict[tuple[int, int], bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._whole: dict[int, bool] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self._halves:
            data = self.tokens[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
                if self.ranks.get(parts[best] + parts[best + 1], 1 << 60) >= token:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether encoding the bytes of both gives exactly these two tokens."""
        key = (left, right)
        if (known := self._memo.get(key)) is None:
            if len(self._memo) >= MEMO:
                self._memo.clear()
            known = self._memo[key] = self._follows(left, right)
        return known

    def _follows(self, left: int, right: int) -> bool:
        # Undo merges on both sides of the border, the latest first. As long as
        # both pieces existed, a merge across the border that comes before the
        # one undone would have been taken instead.
        ceiling_id, ceiling_right = 1 << 60, False
        while True:
            across = self.ranks.get(self.tokens[left] + self.tokens[right])
            if across is not None and (across < ceiling_id or (across == ceiling_id and ceiling_right)):
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                ceiling_id, ceiling_right, left = left, False, a[1]
            else:
                ceiling_id, ceiling_right, right = right, True, b[0]

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Append to the table of last tokens (last[0] stands for the empty prefix) until it covers data."""
        suffixes, memo = self.suffixes, self._memo
        for i in range(len(last), len(data) + 1):
            for j in range(i - 1, -1, -1):
                t = suffixes.get(data[j:i])
                if t is None:
                    raise ValueError("a byte that has no token")
                if t >= 0:
                    if j == 0:
                        break
                    known = memo.get((last[j], t))
                    if self.may_follow(last[j], t) if known is None else known:
                        break
            last.append(t)
        return last

    def read(self, last: list[int], end: int | None = None) -> list[int]:
        out, i = [], len(last) - 1 if end is None else end
        while i > 0:
            out.append(last[i])
            i -= len(self.tokens[last[i]])
        return out[::-1]

    def encode_bytes(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None and self._is_own(whole):
            return [whole]
        return self.read(self.extend(data, [-1])) if data else []

    def _is_own(self, token: int) -> bool:
        """Whether a token's own bytes encode to it (so in any vocabulary made by merges)."""
        if token not in self._whole:
            halves = self.halves(token)
            self._whole[token] = len(self.tokens[token]) == 1 or halves is not None and self.may_reach(*halves)
        return self._whole[token]

    def may_reach(self, left: int, right: int) -> bool:
        return self._is_own(left) and self._is_own(right)

    def decode(self, ids: Iterable[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


class Editable:
    """A byte string with its table: appends and edits encode only what they change."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, data, bpe.extend(data, [-1])

    def ids(self, end: int | None = None) -> list[int]:
        """The exact encoding of the first end bytes."""
        return self.bpe.read(self.last, end)

    def append(self, more: bytes) -> list[int]:
        self.data += more
        self.bpe.extend(self.data, self.last)
        return self.ids()

    def replace(self, start: int, end: int, by: bytes) -> list[int]:
        self.data = self.data[:start] + by + self.data[end:]
        del self.last[start + 1 :]
        self.bpe.extend(self.data, self.last)
        return self.ids()


class _Pieces(dict):
    """From pieces of text to their ids as little-endian unsigned 32-bit integers."""

    def __init__(self, bpe: PrefixBPE):
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        found = np.array(self.bpe.encode_bytes(piece.encode("utf-8")), dtype="<u4").tobytes()
        if len(piece) < 64:
            self[piece] = found
        return found


class TextEncoder:
    """Splits text by a pattern, as the public vocabularies ask for, and encodes each match by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = PrefixBPE(ranks)
        self.split = regex.compile(pattern)
        self.pieces = _Pieces(self.bpe)

    def encode(self, text: str) -> np.ndarray:
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split.findall(text))), dtype="<u4")


_LOADED: dict[tuple[str, str], TextEncoder] = {}


def loaded(path: str, pattern: str) -> TextEncoder:
    """One encoder for each Python worker; its size is that of the vocabulary."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = TextEncoder(read_ranks(path), pattern)
    return _LOADED[path, pattern]


def encode_table(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", key: str = "doc_id", digests: bool = False) -> DataFrame:
    """Encode the text column: key, n_tokens and ids (array), or with digests their SHA-256 and that of the decoded bytes.

    One row out for each row in, in any order; a null text counts as empty and
    a null key stays null; repeated rows are encoded each by itself. Only the
    two columns named are read, whatever others there are.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(ranks_path, pattern)
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                ids = [encoder.encode(t) for t in texts]
                cols = [part.column(0), pa.array([len(x) for x in ids], pa.int64())]
                if digests:
                    sha = hashlib.sha256
                    cols.append(pa.array([sha(x.tobytes()).hexdigest() for x in ids]))
                    cols.append(pa.array([sha(encoder.bpe.decode(x.tolist())).hexdigest() for x in ids]))
                    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    cols.append(pa.array([x.astype("i4") for x in ids], pa.list_(pa.int32())))
                    names = [key, "n_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(docs[key].alias(key), docs[text].alias("_text")).mapInArrow(run, schema)


def decode_column(ranks_path: str) -> Callable[[list[int]], bytes]:
    """A function from ids to bytes for use in workers."""
    return lambda ids: loaded(ranks_path, "").bpe.decode(ids)
