"""Near duplicates by MinHash bands, odd sketches and exact confirmation.

A document's set is its distinct word shingles (64-bit hashes). Documents with
the same set are one node. K MinHash samples give BANDS band keys, under which
nodes meet, and an odd sketch: each sample flips one of BITS bits, so that the
XOR of two sketches counts the samples in which they differ, precisely where
similarity is high. Pairs whose sketches differ too much are dropped; the others
are confirmed on their full sets.

A bucket of m nodes isn't paired off. First every node meets the bucket's pivot
alone: m - 1 pairs. Only buckets that the confirmed links leave in several
components go on: their nodes outside of the bucket's largest component meet
all others, in blocks of BLOCK that confirm in place and give joining links
alone: pairs that pass the sketch may be as many as the square of the bucket, so
they are never written. No link between nodes that share a bucket, and that the
components need, is lost; a pair at the threshold shares none with a chance of
(1 - 0.8^4)^32 = 5e-8. Buckets, pivots and classes of any size are split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayframe.llm.common import components, drop_path, materialize, spread_join, text_rows

K, BANDS, BITS = 128, 32, 512
ROWS = K // BANDS
#: XOR bits of odd sketches at an estimated similarity of 0.55: six deviations from 0.8.
MOST_BITS = 92
BLOCK = 512
WORDS = 400_000
BROADCAST_NODES = 500_000

_RNG = np.random.default_rng(20_240_601)
_A = _RNG.integers(0, 1 << 32, K, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, K, dtype=np.uint32)
_M = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RNG.integers(0, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """Word bytes to a 64-bit hash, for the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words between space, tab, line feed, vertical tab, form feed and return; A-Z lower-cased, other letters as they are."""
    return text.encode("utf-8").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_HASHES) > WORDS:
        _HASHES.clear()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of size words; of the whole text where it has fewer; empty without words."""
    h = word_hashes(words_of(text))
    n = len(h)
    if not n:
        return h
    if n < size:
        return mix((h * _M[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    s = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        s += h[j : n - size + 1 + j] * _M[j]
    return np.unique(mix(s))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(K, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(best, (_A[:, None] * x[None, i : i + 2048] + _B[:, None]).min(1), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    """(documents, BANDS) keys as signed 64-bit integers."""
    keys = (samples.astype(np.uint64) * _BAND[None, :]).reshape(len(samples), BANDS, ROWS).sum(2, dtype=np.uint64)
    return mix(keys + np.arange(BANDS, dtype=np.uint64)[None, :]).view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """(documents, BITS / 64) bitmaps: the parity of samples that fall on each bit."""
    n = len(samples)
    bit = (mix(samples.astype(np.uint64) + _BAND[None, :]) % np.uint64(BITS)).astype(np.int64)
    parity = np.bincount((bit + BITS * np.arange(n)[:, None]).ravel(), minlength=n * BITS).reshape(n, BITS) & 1
    return np.packbits(parity.astype(np.uint8), axis=1).view(np.int64)


def sketch_similarity(differing: float) -> float:
    """The similarity for which so many bits of the XOR are expected to be set."""
    return 1 + BITS / (4 * K) * float(np.log(1 - 2 * differing / BITS))


def signatures(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Per row: key, n_shingles, node (hash of the set, null for an empty one), bands and sketch."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                sets = [shingle_set(t, size) for t in texts]
                samples = np.stack([minhashes(s) for s in sets])
                node = [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
                flat = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype="i4") * a.shape[1]), pa.array(a.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.int64()), flat(band_keys(samples)), flat(odd_sketches(samples))],
                    names=["id", "n_shingles", "node", "bands", "sketch"],
                )

    return docs.select(docs[key].alias("id"), docs[text].alias("_text")).mapInArrow(run, f"id {kind}, n_shingles long, node long, bands array<long>, sketch array<long>")


def _full_sets(docs: DataFrame, text: str, nodes: DataFrame, ids: DataFrame, key: str, size: int) -> DataFrame:
    """(node, set) of the nodes asked for, from the text of one document each: that of the node's row in ids."""
    wanted = ids.join(nodes, "node").groupBy("id").agg(F.collect_set("node").alias("nodes"))
    if wanted.count() <= BROADCAST_NODES:  # else both sides are shuffled by id
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_rows(batch, "_text"):
                rows = []
                for t, nodes in zip(texts, part.column(0).to_pylist(), strict=True):
                    s = shingle_set(t, size)
                    node = xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63)
                    if node in nodes:
                        rows.append((node, s.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["node", "set"])

    texts = docs.select(docs[key].alias("id"), docs[text].alias("_text")).join(wanted, "id").select("nodes", "_text")
    return texts.mapInArrow(run, "node long, set array<long>").dropDuplicates(["node"])


def _alike(a: str, b: str) -> F.Column:
    """Whether two sketches differ in few enough bits."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64)), F.lit(0)) <= MOST_BITS


def _confirmed(pairs: DataFrame, docs: DataFrame, text: str, ids: DataFrame, key: str, size: int, share: tuple[int, int]) -> tuple[DataFrame, list[str]]:
    """The pairs (a, b) whose full sets are similar enough."""
    pairs, p0 = materialize(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets, p1 = materialize(_full_sets(docs, text, nodes, ids, key, size), "sets")
    # A pivot may have any number of pairs; b has one for each band at most.
    pivots, p2 = materialize(pairs.groupBy("a").agg(F.count("*").alias("n")).join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a"), "pivot-sets")
    both = spread_join(pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"), pivots, ["a"], "n", "b")
    common = F.size(F.array_intersect("sa", "sb"))
    links = both.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb")).alias("n")).where(F.col("i") * share[1] >= (F.col("n") - F.col("i")) * share[0])
    links, p3 = materialize(links.select("a", "b"), "confirmed")
    drop_path(pairs.sparkSession, p0, p1, p2)
    return links, [p3]


def _meet(share: tuple[int, int]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Confirms a block's probes against its other rows; gives links that join components, not all pairs."""

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        sketch = np.stack(block["sketch"].to_numpy()).astype(np.int64).view(np.uint64)
        node, root, probe = (block[c].to_numpy() for c in ("node", "root", "probe"))
        sets = [np.asarray(s, np.int64) for s in block["set"]]
        size = np.array([len(s) for s in sets])
        names, codes = np.unique(np.concatenate(sets), return_inverse=True)
        start = np.concatenate([[0], np.cumsum(size)])
        base, here = np.flatnonzero(~probe), np.zeros(len(names), bool)
        parent = {r: r for r in root.tolist()}

        def find(r: int) -> int:
            while parent[r] != r:
                parent[r] = r = parent[parent[r]]
            return r

        links = []
        for i in np.flatnonzero(probe):
            other = base[root[base] != root[i]]
            near = other[np.bitwise_count(sketch[other] ^ sketch[i]).sum(1, dtype=np.int64) <= MOST_BITS]
            if not len(near):
                continue
            own = codes[start[i] : start[i + 1]]
            here[own] = True
            common = np.array([np.count_nonzero(here[codes[start[j] : start[j + 1]]]) for j in near])
            here[own] = False
            for j in near[common * share[1] >= (size[near] + size[i] - common) * share[0]]:
                x, y = find(int(root[i])), find(int(root[j]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((node[i], node[j]))
        return pd.DataFrame(links or {"a": [], "b": []}, columns=["a", "b"], dtype="int64")

    return meet


def _open_links(rooted: DataFrame, open_: DataFrame, reps: DataFrame, docs: DataFrame, text: str, ids: DataFrame, key: str, size: int, share: tuple[int, int]) -> DataFrame:
    """Links (a, b) that join components within the open buckets, found in blocks of bounded size."""
    rows = spread_join(rooted, open_, ["band"], "n", "node")
    rows, _ = materialize(rows, "open")
    sets, _ = materialize(_full_sets(docs, text, rows.select("node").distinct(), ids, key, size), "open-sets")
    rows = rows.join(reps.select("node", "sketch").join(sets, "node"), "node")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    base = rows.select("band", "node", "root", "sketch", "set", own("blocks").alias("i"), each("probe_blocks").alias("j"), F.lit(False).alias("probe"))
    probes = rows.where("root <> main").select("band", "node", "root", "sketch", "set", each("blocks").alias("i"), own("probe_blocks").alias("j"), F.lit(True).alias("probe"))
    return base.union(probes).groupBy("band", "i", "j").applyInPandas(_meet(share), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of at least share of their shingle sets.

    One row for each row of docs: key, n_shingles, component_id (the smallest
    key reachable by links, its own included) and kept (key = component_id).

    Null or empty texts, and those of white space, have an empty set and are
    linked with nothing. Rows with a null key take no part: component_id is
    null and kept true. Rows that share a key are each judged by their own text.
    Texts of any length count whole. An empty table gives no rows. Equal sets
    are one node, so copies never meet in pairs. Further columns aren't read,
    whatever their names.
    """
    spark = docs.sparkSession
    marks, marks_path = materialize(signatures(docs, key, text, size), "signatures")
    known = marks.where("id is not null and node is not null")
    reps, reps_path = materialize(known.groupBy("node").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.min("id").alias("id"), F.count("*").alias("n")), "nodes")
    in_bands = reps.select("node", F.explode("bands").alias("band"))
    shared, shared_path = materialize(in_bands.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1").withColumn("m", F.col("n")), "bands")
    buckets, buckets_path = materialize(spread_join(in_bands, shared, ["band"], "n", "node"), "buckets")
    ids = reps.select("node", "id")

    first_pairs, first_path = materialize(buckets.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "first-pairs")
    pivots, pivots_path = materialize(first_pairs.groupBy("a").agg(F.count("*").alias("n")).join(reps.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a"), "pivots")
    pairs = spread_join(first_pairs.join(reps.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b"), pivots, ["a"], "n", "b").where(_alike("sa", "sb")).select("a", "b")
    links, paths = _confirmed(pairs, docs, text, ids, key, size, share)

    # Buckets of three or more nodes that aren't yet one component.
    roots, roots_path = materialize(components(links), "roots")
    root = F.coalesce("component", F.col("node")).alias("root")
    rooted, rooted_path = materialize(buckets.where("m > 2").select("band", "node").join(roots, "node", "left").select("band", "node", root), "rooted")
    sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("n")).groupBy("band").agg(F.count("*").alias("parts"), F.sum("n").alias("m"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("main"))
    rest = F.col("m") - F.col("most")
    open_, open_path = materialize(sizes.where("parts > 1").select("band", "main", F.col("m").alias("n"), F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"), F.ceil(rest / BLOCK).cast("int").alias("probe_blocks")), "open-bands")
    drop = [buckets_path, shared_path, first_path, pivots_path, rooted_path]
    if not open_.isEmpty():
        more, more_path = materialize(_open_links(rooted, open_, reps, docs, text, ids, key, size, share), "more")
        drop += [roots_path, more_path]
        roots, roots_path = materialize(components(links.union(more)), "roots")
    drop_path(spark, open_path, *drop, *paths)

    # Nodes get their class first; a node's copies, like a class's nodes, may be any number.
    placed = reps.select("node", "id", "n").join(roots, "node", "left").select("node", "id", "n", F.coalesce("component", F.col("node")).alias("root"))
    first, first_path = materialize(placed.groupBy("root").agg(F.min("id").alias("component"), F.count("*").alias("m")), "firsts")
    classes, _ = materialize(spread_join(placed, first, ["root"], "m", "node").select("node", "component", "n"), "classes")
    drop_path(spark, reps_path, roots_path, first_path)
    out = spread_join(known.select("id", "n_shingles", "node"), classes, ["node"], "n", "id").select("id", "n_shingles", "component")
    out = out.union(marks.where("id is null or node is null").select("id", "n_shingles", F.col("id").alias("component")))
    return out.select(F.col("id").alias(key), "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
