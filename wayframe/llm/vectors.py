"""Exact top-k search by a Voronoi join, and embedding near duplicates by cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayframe.llm.common import components, drop_path, materialize, spread_join

QUERIES_IN_GROUP, ROWS_IN_BLOCK, PIVOTS = 512, 8192, 512


def usable(vector: str) -> Column:
    """Neither null nor with a null, infinite or not-a-number component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def matrix(lists: list) -> np.ndarray:
    """Rows of equal or, filled up with zeros, unequal length."""
    width = max(map(len, lists), default=0)
    if all(len(x) == width for x in lists):
        return np.array(lists, np.float64).reshape(len(lists), width)
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def fitted(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of integral rows: in floating point where that is exact, else in integers."""
    width = max(a.shape[1], b.shape[1])
    a, b = fitted(a, width), fitted(b, width)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) < 2**53:
        return np.rint(a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def column_matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(name))
    sizes = np.diff(col.offsets.to_numpy())
    if len(sizes) and (sizes == sizes[0]).all():
        return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), sizes[0])
    return matrix(col.to_pylist())


def _best(query: np.ndarray, row: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query row the k best columns: (row, column) indices; ties to the smaller id, a row never finds itself."""
    by_id = np.lexsort((row, vec))
    own = query[:, None] == row[by_id][None, :]
    score = score[:, by_id]
    rows, cols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(len(query)):
        others = np.flatnonzero(~own[i])
        s = score[i, others]
        if len(s) > k:
            near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
            others, s = others[near], s[near]
        top = others[np.lexsort((others, -s))][:k]
        rows.append(np.full(len(top), i))
        cols.append(by_id[top])
    return np.concatenate(rows), np.concatenate(cols)


def _far_bound(p: np.ndarray, r: float, q: float, c: np.ndarray, far: np.ndarray, size: np.ndarray) -> np.ndarray:
    """No inner product of a vector within r of p, of length q at most, with one within far of c, of length size at most, exceeds this."""
    apart = np.sqrt(np.maximum(((c - p) ** 2).sum(1), 0))
    by_length = (q**2 + size**2 - np.maximum(apart - r - far, 0) ** 2) / 2
    by_product = c @ p + r * np.sqrt((c**2).sum(1)) + far * (np.sqrt((p**2).sum()) + r)
    bound = np.minimum(by_length, by_product)
    return bound + 1e-9 * np.abs(bound) + 1e-3


def _blocks(cells: dict[int, int], near: np.ndarray) -> tuple[dict[int, tuple[int, int]], int]:
    """The first block and the number of blocks of each cell; small neighbouring cells share one."""
    at, room, out = -1, 0, {}
    for c in sorted(cells, key=lambda c: (int(near[c]), c)):
        if cells[c] > ROWS_IN_BLOCK:
            parts = -(-cells[c] // ROWS_IN_BLOCK)
            out[c] = (at + 1, parts)
            at, room = at + parts, 0
            continue
        if cells[c] > room:
            at, room = at + 1, ROWS_IN_BLOCK
        out[c] = (at, 1)
        room -= cells[c]
    return out, at + 1


def top_k(vectors: DataFrame, query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Exact best partners by the integer inner product of floor(scale * x): query_id, rank from 1, vec_id, score.

    A Voronoi join. Pivots are PIVOTS rows (fewer, if there are) with the
    smallest hash of their row. Every row belongs to the cell of its nearest
    pivot; queries also to the group of their nearest one among the first pivots.
    Summaries are the size, radius and greatest length of each cell and group,
    and the least k-th best score that a group's queries have among the pivots. A
    group's bound for a cell follows from the two summaries: where it is below
    that score, nothing of the cell is sent to the group; of the other cells only
    the rows whose own bound reaches it are. Cells fill blocks of bounded size,
    large ones several, and a group's queries go to the blocks of its cells
    alone. Blocks are solved by themselves and their best are merged, so neither
    a hot cell nor an unselective bound fills one task.

    Vectors that are null or hold null or non-finite components, and rows with a
    null id, take no part; shorter vectors count as filled up with zeros. Rows
    that share an id or are wholly equal are rows by themselves: each that is
    asked has its own ranks, and finds the others. Ties go to the smaller id.
    With fewer candidates there are fewer ranks; an empty table gives none.
    Further columns aren't read, whatever their names. Scores are exact while
    they fit in 64 bits.
    """
    spark = vectors.sparkSession
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.where(F.col(key).isNotNull() & usable(vector)).select(vectors[key].cast("long").alias("id"), ints.alias("v"), F.coalesce(query, F.lit(False)).alias("asked"))
    data, path = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    total, n = data.agg(F.count("*"), F.count_if("asked")).first()
    pivots = data.orderBy(F.xxhash64("row", "id"), "row").limit(PIVOTS).collect()  # bounded by PIVOTS
    p_rows, p = np.array([r.row for r in pivots], np.int64), matrix([r.v for r in pivots])
    groups = max(1, min(len(pivots), -(-n // QUERIES_IN_GROUP)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, row = column_matrix(batch, "v"), batch.column(3).to_numpy()
            width = max(x.shape[1], p.shape[1])
            a, c = fitted(x, width), fitted(p, width)
            apart = np.maximum((a**2).sum(1)[:, None] - 2 * a @ c.T + (c**2).sum(1)[None, :], 0)
            cell, grp = apart.argmin(1), apart[:, :groups].argmin(1)
            exact = lambda near: np.sqrt(((a - c[near]) ** 2).sum(1))
            asked = batch.column(2).to_numpy(zero_copy_only=False)
            least = np.full(len(a), -np.inf)
            if len(p_rows) > k and asked.any():
                score = products(x[asked], p).astype(np.float64)
                score[row[asked][:, None] == p_rows[None, :]] = -np.inf
                least[asked] = np.partition(score, len(p_rows) - k, 1)[:, len(p_rows) - k]
            cols = [pa.array(cell.astype("i4")), pa.array(exact(cell)), pa.array(grp.astype("i4")), pa.array(exact(grp)), pa.array(least), pa.array(np.sqrt((a**2).sum(1)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=["id", "v", "asked", "row", "cell", "cell_far", "grp", "grp_far", "least", "size"])

    placed, placed_path = materialize(data.mapInArrow(assign, "id long, v array<long>, asked boolean, row long, cell int, cell_far double, grp int, grp_far double, least double, size double"), "cells")
    drop_path(spark, path)
    # At most PIVOTS rows each.
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("cell_far").alias("far"), F.max("size").alias("size")).collect()
    asked = {r.grp: r for r in placed.where("asked").groupBy("grp").agg(F.count("*").alias("n"), F.max("grp_far").alias("far"), F.max("size").alias("size"), F.min("least").alias("least")).collect()}
    nearest = np.array([int(((p[:groups] - c) ** 2).sum(1).argmin()) for c in p]) if len(p) else np.zeros(0, int)
    block_of, blocks = _blocks({r.cell: r.n for r in cells}, nearest)
    which, far, size = np.array([r.cell for r in cells], np.int64), np.array([r.far for r in cells]), np.array([r.size for r in cells])
    live, parts, goes = {}, {}, {}
    for g, r in asked.items():
        live[g] = np.zeros(len(p), bool)
        live[g][which[_far_bound(p[g], r.far, r.size, p[which], far, size) >= r.least]] = True
        parts[g] = -(-r.n // (2 * QUERIES_IN_GROUP))
        goes[g] = sorted({b for c in which[live[g][which]] for b in range(block_of[c][0], sum(block_of[c]))})
    first, many = np.zeros(len(p), np.int64), np.ones(len(p), np.int64)
    for c, (at, number) in block_of.items():
        first[c], many[c] = at, number
    names = ["grp", "part", "block", "row", "id", "v"]

    def out(g: int, part: pa.Array, block: pa.Array, batch: pa.RecordBatch) -> pa.RecordBatch:
        pick = lambda c: batch.column(batch.schema.get_field_index(c))
        return pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, g, "i4")), part, block, pick("row"), pick("id"), pick("v")], names=names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cell, row = column_matrix(batch, "v"), batch.column(4).to_numpy(), batch.column(3).to_numpy()
            width = max(x.shape[1], p.shape[1])
            x, c = fitted(x, width), fitted(p, width)
            length = np.sqrt((x**2).sum(1))
            block = (first[cell] + row % many[cell]).astype("i4")
            for g, r in asked.items():
                own = np.flatnonzero(live[g][cell])
                own = own[_far_bound(c[g], r.far, r.size, x[own], np.zeros(len(own)), length[own]) >= r.least]
                if len(own):
                    taken = batch.take(pa.array(own))
                    for j in range(parts[g]):
                        yield out(g, pa.array(np.full(len(own), j, "i4")), pa.array(block[own]), taken)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, grp = batch.column(3).to_numpy(), batch.column(6).to_numpy()
            for g in np.unique(grp).tolist():
                own = np.flatnonzero(grp == g)
                taken, part = batch.take(pa.array(own)), pa.array((row[own] % parts[g]).astype("i4"))
                for b in goes[g]:
                    yield out(g, part, pa.array(np.full(len(own), b, "i4")), taken)

    schema = "grp int, part int, block int, row long, id long, v array<long>"

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if q.empty or x.empty:
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        ids, vec, q_row, x_row = q["id"].to_numpy(np.int64), x["id"].to_numpy(np.int64), q["row"].to_numpy(np.int64), x["row"].to_numpy(np.int64)
        score = products(matrix(q["v"].tolist()), matrix(x["v"].tolist()))
        rows, cols = _best(q_row, x_row, vec, score, k)
        return pd.DataFrame({"row": q_row[rows], "query_id": ids[rows], "vec_id": vec[cols], "score": score[rows, cols]})

    keys = ["grp", "part", "block"]
    found = placed.where("asked").mapInArrow(ask, schema).groupBy(*keys).cogroup(placed.mapInArrow(send, schema).groupBy(*keys)).applyInPandas(solve, "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")).cast("int")
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    best, _ = materialize(best.select("query_id", "rank", F.col("vec_id").alias(key), "score"), "best")
    drop_path(spark, placed_path)
    return best


# --- near duplicates ---

TABLES, HASHES, PROBES = 8, 2, 2
BUCKET_BLOCK, SUPER = 1024, 6000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def cross_polytope(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and second nearest vertices (signed axes) after three rounds of random signs and transforms."""
    width = 1 << max(1, int(x.shape[1] - 1).bit_length())
    x = fitted(x, width)
    rng = np.random.default_rng([9_173, seed])
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], width)[None, :])
    two = np.argpartition(-np.abs(x), 1, axis=1)[:, :2]
    size = np.abs(np.take_along_axis(x, two, 1))
    two = np.where((size[:, :1] >= size[:, 1:]), two, two[:, ::-1])
    vertex = 2 * two + (np.take_along_axis(x, two, 1) < 0)
    return vertex[:, 0].astype(np.int64), vertex[:, 1].astype(np.int64)


BASE = 1 << 20


def vertices(x: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """(rows, tables, 4): the nearest and second vertex of each table's two hashes."""
    return np.stack([v for t in range(2 * tables) for v in cross_polytope(x, t)], 1).reshape(len(x), tables, 4)


def bucket_keys(v: np.ndarray) -> np.ndarray:
    """(rows, tables, 1 + PROBES): the bucket of each row in each table, and those to probe besides."""
    a, a2, b, b2 = (v[:, :, i].astype(np.int64) for i in range(4))
    return np.stack([a * BASE + b, a2 * BASE + b, a * BASE + b2], 2)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; divided by the largest component first, squares neither overflow nor vanish."""
    x = x.astype(np.float64) / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1))[:, None]


def _first_here(table: int, x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, probing: bool) -> np.ndarray:
    """Whether this meeting of the pairs (x met y in y's bucket) is the one that counts.

    x, y: (pairs, tables, 1 + PROBES) keys. Of all meetings of two rows the one
    in the first table counts: in the bucket of both, else where one probes the
    other's bucket, the smaller node if both do.
    """
    same = x[:, :, 0] == y[:, :, 0]
    x_probes = (x[:, :, 1:] == y[:, :, :1]).any(2)
    y_probes = (y[:, :, 1:] == x[:, :, :1]).any(2)
    first = (same | x_probes | y_probes).argmax(1) == table
    s, xp, yp = same[:, table], x_probes[:, table], y_probes[:, table]
    if probing:
        return first & ~s & xp & (~yp | (nx < ny))
    return first & s & (nx < ny)


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, tables: int = TABLES) -> DataFrame:
    """Vectors linked by a cosine of at least least, in double precision: key, n_links, component_id, kept.

    Equal vectors are one node with a number of copies. Each table hashes a node
    by two cross-polytope hashes to a bucket, and probes two neighbouring ones.
    Buckets are cut into bounded blocks that meet pairwise; a pair of rows that
    meets in several tables counts in the first, so links are counted and
    components joined without listing pairs. Every link is verified; one is
    missed only if its rows meet in no table.

    One row for each row. Vectors that are null, zero or hold null or non-finite
    components link with nothing: n_links 0, their own component. Rows with a
    null key take no part: component_id is null and kept true. Copies of a vector
    are linked with each other. Shorter vectors count as filled up with zeros.
    Rows that share a key are rows by themselves. An empty table gives no rows.
    Further columns aren't read, whatever their names.
    """
    spark = vectors.sparkSession
    # Components travel as they are, in four bytes where they are floats.
    single = vectors.schema[vector].dataType.elementType.simpleString() == "float"
    numbers = "<f4" if single else "<f8"
    doubles = F.transform(vector, lambda x: x.cast("double"))
    whole = usable(vector) & F.exists(vector, lambda x: x != 0) & F.col(key).isNotNull()
    node = F.when(whole, F.xxhash64(doubles, F.size(vector)))
    rows, rows_path = materialize(vectors.select(vectors[key].alias("id"), node.alias("node"), F.when(whole, F.col(vector) if single else doubles).alias("v")), "rows")
    nodes = rows.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.first("v").alias("v"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = column_matrix(batch, "v")
            at = vertices(unit_rows(x), tables)
            keys = bucket_keys(at)
            flat = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype="i4") * a.shape[1]), pa.array(a.ravel()))
            bytes_of = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), bytes_of(x.astype(numbers)), bytes_of(at.astype("<u4")), flat(keys[:, :, 0]), flat(keys[:, :, 1:].reshape(len(x), -1))], names=["node", "copies", "raw", "at", "own", "probes"]
            )

    nodes, nodes_path = materialize(nodes.select("node", "copies", "v").mapInArrow(place, "node long, copies long, raw binary, at binary, own array<long>, probes array<long>"), "nodes")
    # Buckets and their sizes move as keys alone; a node's components join those of its places where it can meet another.
    spots = F.concat(
        F.transform("own", lambda b, t: F.struct(t.alias("t"), b.alias("bucket"), F.lit(False).alias("probing"))),
        F.transform("probes", lambda b, i: F.struct(F.floor(i / PROBES).cast("int").alias("t"), b.alias("bucket"), F.lit(True).alias("probing"))),
    )
    places, places_path = materialize(nodes.select("node", F.inline(spots)), "places")
    sizes = places.groupBy("t", "bucket").agg(F.count("*").alias("n"), F.count_if(~F.col("probing")).alias("base")).where("n > 1 and base > 0").drop("base")
    sizes, sizes_path = materialize(sizes.withColumn("g", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int")), "sizes")
    supers = max(1, -(-(sizes.agg(F.sum(F.col("n") * F.col("g"))).first()[0] or 0) // SUPER))
    met, met_path = materialize(spread_join(places, sizes, ["t", "bucket"], "n", "node"), "met")
    block = F.pmod(F.xxhash64("node"), F.col("g")).cast("int")
    every = F.sequence(F.lit(0), F.col("g") - 1)
    # A single block holds each row once; of several, base rows go to a line of blocks and all rows to a column.
    lines = F.when(~F.col("probing") & (F.col("g") > 1), F.transform(every, lambda j: F.struct(block.alias("i"), j.alias("j"), F.lit(1).alias("role"))))
    columns = F.transform(every, lambda i: F.struct(i.alias("i"), block.alias("j"), F.when(F.col("probing"), 3).when(F.col("g") > 1, 2).otherwise(0).alias("role")))
    spread = met.withColumn("cell", F.explode(F.concat(F.coalesce(lines, F.array().cast("array<struct<i:int,j:int,role:int>>")), columns)))
    spread = spread.select("t", "bucket", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), F.col("cell.role").alias("role"), "node")
    spread = spread.withColumn("super", F.pmod(F.xxhash64("t", "bucket", "i", "j"), F.lit(supers))).join(nodes.select("node", "copies", "raw", "at"), "node")

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["t", "bucket", "i", "j"], kind="stable")
        t, bucket, i, j, role, node, copies = (frame[c].to_numpy() for c in ("t", "bucket", "i", "j", "role", "node", "copies"))
        change = np.flatnonzero(np.concatenate([[True], (np.diff(t) != 0) | (np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0), [True]]))
        width = max(len(u) for u in frame["raw"])
        unit = unit_rows(np.frombuffer(b"".join(u.ljust(width, b"\0") for u in frame["raw"]), numbers).reshape(len(frame), -1))
        keys = bucket_keys(np.frombuffer(b"".join(frame["at"]), "<u4").reshape(len(frame), tables, 4))
        out_a, out_b, out_wa, out_wb = [], [], [], []
        for s, e in zip(change[:-1], change[1:], strict=True):
            if e - s < 2:
                continue
            r = role[s:e]
            base = s + np.flatnonzero(r <= 1)
            for who, probing in ((s + np.flatnonzero((r == 0) | (r == 2)), False), (s + np.flatnonzero(r == 3), True)):
                if not len(base) or not len(who):
                    continue
                a, b = np.nonzero(unit[who] @ unit[base].T >= least)
                a, b = who[a], base[b]
                other = node[a] != node[b]
                a, b = a[other], b[other]
                if len(a):
                    counts = _first_here(int(t[s]), keys[a], keys[b], node[a], node[b], probing)
                    a, b = a[counts], b[counts]
                    out_a.append(node[a]), out_b.append(node[b]), out_wa.append(copies[a]), out_wb.append(copies[b])
        if not out_a:
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        a, b, wa, wb = (np.concatenate(x) for x in (out_a, out_b, out_wa, out_wb))
        names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        links = np.bincount(at, np.concatenate([wb, wa]), len(names)).astype(np.int64)
        left, right = at[: len(a)], at[len(a) :]
        root = np.arange(len(names))
        while True:
            low = np.minimum(root[left], root[right])
            new = root.copy()
            np.minimum.at(new, left, low), np.minimum.at(new, right, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({"node": names, "links": links, "root": names[root]})

    found, found_path = materialize(spread.groupBy("super").applyInPandas(meet, "node long, links long, root long"), "found")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots, _ = materialize(components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))), "roots")
    per_node = nodes.select("node", "copies").join(counted, "node", "left").join(roots, "node", "left").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", F.col("node")).alias("root"))
    copies = nodes.select("node", F.col("copies").alias("n")).join(per_node, "node")
    copies, copies_path = materialize(copies, "copies")
    full, full_path = materialize(spread_join(rows.select("id", "node"), copies, ["node"], "n", "id"), "linked")
    first, _ = materialize(full.groupBy("root").agg(F.min("id").alias("first"), F.count("*").alias("n")), "firsts")
    out = spread_join(full, first, ["root"], "n", "id").select("id", "links", F.col("first").alias("component"))
    alone, _ = materialize(rows.where("node is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component")), "alone")
    drop_path(spark, rows_path, nodes_path, places_path, sizes_path, met_path, found_path, copies_path)
    return out.union(alone).select(F.col("id").alias(key), F.col("links").alias("n_links"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
