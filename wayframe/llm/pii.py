"""Personal data: exact base patterns, and credentials found by weak supervision.

Four kinds have patterns whose matches are taken as they are. Further candidate
tokens (those with a digit or an at sign, or assigned to a cue word, outside of the base matches) get votes
from labelers: patterns, a gazetteer of cue words, and context. Expectation
maximisation over the counts of vote patterns in the whole corpus estimates how
reliable each labeler is, without labels. The posteriors train a logistic
classifier over the candidates' features, which decides on the added spans.

Both models see only counts of (votes, features) patterns, which are summed in
every task before the shuffle. The votes follow from few of the features and
length, so of 2^14 feature patterns a few thousand occur, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayframe.llm.common import text_rows

KINDS = ("email", "ip", "card", "phone", "secret")
ORDER = {k: i for i, k in enumerate(KINDS)}
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARKED = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
WORD_BEFORE = re.compile(r"([^\W\d_]+)[^\w]*\Z")

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    """Leftmost matches of the pattern, found from each at sign, so in linear time."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        at = text.find("@", m.end() if m else at + 1)
    return out


def addresses(text: str) -> list[Span]:
    """Dotted runs of digits, four numbers at a time, dropped where one is over 255."""
    out = []
    for m in DOTTED.finditer(text):
        if "." not in m.group():
            continue
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    double = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(double)) % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    return out


def phones(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m.group()) <= 15]


def base_spans(text: str) -> list[Span]:
    if not MARKED.search(text):
        return []
    found = emails(text) + addresses(text) + cards(text) + phones(text)
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


# --- candidates, votes and features ---

#: Gazetteers of words that name credentials, and of words before plain numbers.
CUES = frozenset("password passwd pwd passphrase passcode pass secret token key apikey accesskey privatekey auth authorization credential credentials bearer login pin otp ssn passport iban account cvv passwort kennwort geheimnis schlüssel zugang contraseña clave mot clé jeton identifiant".split())
PLAIN = frozenset("version v page pages chapter section cc by nc sa license licence figure fig table volume vol no number year since article part edition seite kapitel abschnitt band jahr version chapitre tome numéro année isbn doi rfc iso".split())
ASSIGNED = re.compile(r"([A-Za-z_]+)\s*[=:]\s*[\"']?\Z")
INSIDE = re.compile(r"([A-Za-z_]{1,40})[=:](?=[\"']?[A-Za-z0-9+/_-]{6,})")
KEY_ID = re.compile(r"[A-Z]{4}[0-9A-Z]{16}\Z")
HEX = re.compile(r"[0-9a-f]{16,}\Z")
NUMBER = re.compile(r"[0-9]{1,6}(?:[.,:/%-][0-9]{0,6})*[%.]?\Z")
VOWELS = frozenset("aeiouyAEIOUY")
NAMED = re.compile(r"([^\W\d_]{3,20})[\"']?\s{0,2}[:=]\s{0,2}(?=\S{6})")
VOTERS, FEATURES = 6, 14
EDGE = "\"'()[]{}<>.,;:!?"


def marked(text: str) -> Iterator[tuple[int, int]]:
    """Runs without white space that hold a digit or an at sign."""
    end, m = 0, MARKED.search(text)
    while m:
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        after = SPACE.search(text, m.end())
        end = after.start() if after else len(text)
        yield start, end
        m = MARKED.search(text, end)


def tokens(text: str) -> list[tuple[int, int]]:
    """The marked runs, and those that a cue word is assigned to or followed by, in order and without overlaps."""
    found = list(marked(text))
    if ":" in text or "=" in text:
        for m in NAMED.finditer(text):
            if m.group(1).lower() in CUES:
                after = SPACE.search(text, m.end())
                found.append((m.end(), after.start() if after else len(text)))
        found.sort()
    out: list[tuple[int, int]] = []
    for start, end in found:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int, tuple[int, ...], int]]:
    """(start, end, votes, features) of each candidate token; votes are -1, 0 or 1."""
    k = 0
    for start, end in tokens(text):
        while k < len(base) and base[k][2] <= start:
            k += 1
        if any(s < end and start < e for _, s, e in base[k : k + 4]):
            continue
        before = text[max(0, start - 40) : start]
        name = ""
        if inside := INSIDE.search(text, start, end):
            name, start = inside.group(1).lower(), inside.end()
        elif assigned := ASSIGNED.search(before):
            name = assigned.group(1).lower()
        while start < end and text[start] in EDGE:
            start += 1
        while end > start and text[end - 1] in EDGE:
            end -= 1
        if end - start < 2:
            continue
        value = text[start:end]
        word = (w := WORD_BEFORE.search(before)) and w.group(1).lower() or ""
        letters, digits = any(c.isalpha() for c in value), any(c.isdigit() for c in value)
        mixed = letters and digits
        votes = (
            1 if KEY_ID.match(value) else 0,  # pattern: the form of an access key
            1 if HEX.match(value) and mixed else -1 if NUMBER.match(value) else 0,  # pattern: hexadecimal, or a plain number
            1 if name in CUES else 0,  # gazetteer: assigned to a cue word
            1 if word in CUES else -1 if word in PLAIN else 0,  # context: the word before
            1 if mixed and len(value) >= 14 else -1 if len(value) < 8 else 0,  # form: long and mixed
            -1 if not letters and not name else 0,  # form: no letters, not assigned
        )
        capitals, small = any(c.isupper() for c in value), any(c.islower() for c in value)
        share = sum(c.isdigit() for c in value) / len(value)
        signs = (
            mixed, len(value) >= 8, len(value) >= 14, len(value) >= 24, name in CUES, word in CUES, word in PLAIN, bool(name),
            capitals and small, value.isupper(), share >= 0.3, any(c in "+/=_-" for c in value), sum(c in VOWELS for c in value) < 0.2 * len(value), bool(HEX.match(value)),
        )
        features = sum(bool(bit) << i for i, bit in enumerate(signs))
        yield start, end, votes, features


class Votes:
    """Class-conditional vote tables fitted by expectation maximisation on pattern counts.

    Labelers are taken to be better than chance, as PRIOR rows' worth of votes
    say beforehand; so a corpus with one vote pattern alone is decided too.
    """

    PRIOR = np.array([[3.0, 6.0, 1.0], [1.0, 6.0, 3.0]])

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 1000):
        total = patterns.sum(1)
        p = np.where(total > 0, 0.9, np.where(total < 0, 0.1, 0.5))
        for _ in range(rounds):
            weight = np.stack([counts * (1 - p), counts * p])
            self.prior = (weight.sum(1) + 1) / (weight.sum() + 2)
            self.table = np.stack([[[(w * (patterns[:, j] == v)).sum() + before[v + 1] for v in (-1, 0, 1)] for j in range(patterns.shape[1])] for w, before in zip(weight, self.PRIOR, strict=True)])
            self.table /= self.table.sum(2, keepdims=True)
            last, p = p, self.posterior(patterns)
            if np.abs(p - last).max() < 1e-7:
                break

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = np.log(self.prior)[:, None] + sum(np.log(self.table[:, j, :][:, patterns[:, j] + 1]) for j in range(patterns.shape[1]))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 25) -> np.ndarray:
    """Weights (the last for the constant) by Newton steps; y may be probabilities."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, weight = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (p - y)) + ridge * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def bits(features: np.ndarray) -> np.ndarray:
    return (features[:, None] >> np.arange(FEATURES) & 1).astype(float)


def fit(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """The probability of each feature pattern, from counts over all documents; None without candidates."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for _, texts in text_rows(batch, "_text"):
                for t in texts:
                    found.update((v, f) for _, _, v, f in candidates(t, base_spans(t)))
        rows = [(sum((x + 1) * 3**j for j, x in enumerate(v)), f, n) for (v, f), n in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["votes", "features", "n"])

    rows = docs.select(docs[text].alias("_text")).mapInArrow(count, "votes long, features long, n long").groupBy("votes", "features").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return None
    rows.sort()
    votes = np.array([[r.votes // 3**j % 3 - 1 for j in range(VOTERS)] for r in rows])
    features, counts = np.array([r.features for r in rows]), np.array([r.n for r in rows], float)
    posterior = Votes(votes, counts).posterior(votes)
    w = logistic(bits(features), posterior, counts, ridge=max(1 / counts.sum(), 1e-9))
    return 1 / (1 + np.exp(-np.clip(np.hstack([bits(np.arange(1 << FEATURES)), np.ones((1 << FEATURES, 1))]) @ w, -30, 30)))


def spans_of(text: str, chance: np.ndarray | None) -> list[Span]:
    base = base_spans(text)
    added = [] if chance is None else [("secret", s, e) for s, e, _, f in candidates(text, base) if chance[f] >= 0.5]
    return sorted(base + added, key=lambda s: (s[1], ORDER[s[0]]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def masked(text: str, spans: list[Span]) -> str:
    """Each run of overlapping spans becomes the name of its first kind in brackets."""
    out, at = [], 0
    for k, s, e in spans:
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), mask: bool = True) -> DataFrame:
    """The columns in keep, counts by base kind, base_sha256, spans and, with mask, the text with its spans masked.

    One row for each row. A null text counts as empty in the counts and stays
    null when masked. Repeated rows are each searched by themselves; columns not
    named aren't read. Offsets are code points. Texts of any length count whole,
    in linear time. An empty table gives no rows.
    """
    chance = fit(docs, text)
    fields = [docs.schema[k] for k in keep]
    schema = ", ".join(f"`_keep{i}` {f.dataType.simpleString()}" for i, f in enumerate(fields))
    schema += ", n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string" + ", _masked string" * mask
    names = [*(f"_keep{i}" for i in range(len(keep))), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", *["_masked"] * mask]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                found = [spans_of(t, chance) for t in texts]
                base = [[s for s in x if s[0] != "secret"] for x in found]
                cols = [part.column(i) for i in range(len(keep))]
                cols += [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in KINDS[:4]]
                cols += [pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base]), pa.array([joined(x) for x in found])]
                if mask:
                    there = part.column(len(keep)).is_valid().to_pylist()
                    cols.append(pa.array([masked(t, x) if ok else None for t, x, ok in zip(texts, found, there, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    out = docs.select(*(docs[k].alias(f"_keep{i}") for i, k in enumerate(keep)), docs[text].alias("_text")).mapInArrow(run, schema)
    out = out.withColumnsRenamed({f"_keep{i}": k for i, k in enumerate(keep)})
    return out.withColumnRenamed("_masked", "masked_text") if mask else out
