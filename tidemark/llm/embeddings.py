"""Embedding near-duplicates: a hierarchical navigable small-world graph per shard, every shard queried.

1. Vectors are checked and scaled to length one in double precision; equal vectors become one class
   of which only the smallest id goes on, with its number of copies.
2. A hash deals the classes out to shards (by dimension; at least ``MIN_SHARDS``, more when a shard would
   pass ``SHARD_BYTES``), and each shard's task builds its graph: geometric levels, batches of
   points inserted by beam search, diverse neighbours first.
3. Every block of queries meets every shard, by a product of the two stored tables that moves neither of them through a
   shuffle. A beam search keeps the nearest ``BEAM`` points; a query whose beam
   holds nothing but links is repeated with a wider beam, so no group is cut off. Some queries of each block are
   audited against all vectors of the shard, and the beam of the whole block widens until the audit finds
   ``TARGET`` of the true links. A beam that would hold a ``DENSE``-th of the shard is replaced by the products with all of it.
4. Links are those with cosine >= 0.9 in double precision. A task counts each query's links and gives
   a spanning forest of them, never all pairs; counts are summed and forests unioned by components.

A task holds one shard, one block of queries and a few arrays of about ``CELLS`` numbers, whatever the table and the groups in it.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
have no links and are their own component; vectors of different dimensions never link; a null id is kept
and links with nothing; rows that repeat an id are one vector (the first by its bytes if they
differ); an empty table gives an empty result. Only the id and vector columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch
from .words import raw

COSINE = 0.9
MIN_SHARDS = 6
SHARD_BYTES = 16 << 20
QUERY_BLOCK = 4096
BLOCK_BYTES = 8 << 20
NEIGHBOURS = 16
BUILD_BEAM = 48
BEAM = 32
AUDITED = 48
TARGET = 0.98
EXPAND = 4
STEP_QUERIES = 256
DENSE = 64
#: Numbers in the largest arrays of a task that aren't its shard or its queries.
CELLS = 4 << 20
ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, array<double> -> vec_id, dim, unit: the vector over its length as float64 bytes, null if it can't link."""
    for b in batches:
        units, dims = [], []
        for lo in range(0, b.num_rows, 4096):
            for v in b.column(1).slice(lo, 4096).to_pylist():
                unit = None
                if v and None not in v:
                    x = np.array(v, np.float64)
                    if np.isfinite(x).all() and np.abs(x).max() > 0:
                        x = x / np.abs(x).max()  # no overflow of the length
                        unit = (x / math.sqrt(float(x @ x))).tobytes()
                units.append(unit)
                dims.append(len(v) if unit else 0)
        yield pa.record_batch([b.column(0), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], names=["vec_id", "dim", "unit"])


class Graph:
    """``vectors``: unit rows. ``levels[l][i]``: neighbours of point i on level l, -1 where there are fewer."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray], entry: int):
        self.x, self.levels, self.entry = vectors, levels, entry

    def _beam(self, q: np.ndarray, start: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest points found on one level from each query's start points: (points or -1, cosines), nearest first."""
        near, n, rows = self.levels[level], len(self.x), len(q)
        ids = np.full((rows, width), -1, np.int64)
        cos = np.full((rows, width), -np.inf, np.float32)
        k = min(width, start.shape[1])
        ids[:, :k] = start[:, :k]
        cos[:, :k] = np.where(ids[:, :k] >= 0, np.matmul(self.x[ids[:, :k]], q[:, :, None])[:, :, 0], -np.inf)
        order = np.argsort(-cos, 1)
        ids, cos = np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)
        done = ids < 0
        seen = np.zeros((rows, n + 1), bool)
        np.put_along_axis(seen, ids, True, 1)
        live = np.arange(rows)
        while len(live):
            open_at = np.argsort(done[live], 1, kind="stable")[:, :EXPAND]  # the nearest that aren't expanded yet
            pick = np.where(np.take_along_axis(done[live], open_at, 1), -1, np.take_along_axis(ids[live], open_at, 1))
            more = (pick >= 0).any(1)
            live, open_at, pick = live[more], open_at[more], pick[more]
            if not len(live):
                break
            done[live[:, None], open_at] = True
            found = np.where(pick[:, :, None] >= 0, near[pick], -1).reshape(len(live), -1)
            found.sort(1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            found[seen[live[:, None], found]] = -1
            seen[live[:, None], found] = True
            new = np.where(found >= 0, np.matmul(self.x[found], q[live][:, :, None])[:, :, 0], -np.inf)
            all_cos, all_ids = np.concatenate([cos[live], new], 1), np.concatenate([ids[live], found], 1)
            all_done = np.concatenate([done[live], found < 0], 1)
            best = np.argpartition(-all_cos, width - 1, 1)[:, :width] if all_cos.shape[1] > width else np.argsort(-all_cos, 1)
            best = np.take_along_axis(best, np.argsort(-np.take_along_axis(all_cos, best, 1), 1), 1)
            cos[live], ids[live], done[live] = (np.take_along_axis(a, best, 1) for a in (all_cos, all_ids, all_done))
        return np.where(np.isfinite(cos), ids, -1), cos

    def search(self, q: np.ndarray, width: int, down_to: int = 0) -> tuple[np.ndarray, np.ndarray]:
        start = np.full((len(q), 1), self.entry, np.int64)
        for level in range(len(self.levels) - 1, down_to, -1):
            start = self._beam(q, start, level, min(8, width))[0]
        return self._beam(q, start, down_to, width)


def _diverse(x: np.ndarray, near: np.ndarray, cos: np.ndarray, m: int) -> np.ndarray:
    """Up to m of each row's candidates (nearest first): one that is nearer to a chosen one than to the point waits until the end."""
    rows, n = near.shape
    step = max(1, CELLS // max(1, n * (n + x.shape[1])))
    if rows > step:
        return np.concatenate([_diverse(x, near[lo:lo + step], cos[lo:lo + step], m) for lo in range(0, rows, step)])
    pair = np.matmul(x[near], np.swapaxes(x[near], 1, 2))
    chosen, count = np.zeros((rows, n), bool), np.zeros(rows, int)
    for k in range(n):
        clash = ((pair[:, k, :] > cos[:, k, None]) & chosen).any(1)
        ok = (near[:, k] >= 0) & ~clash & (count < m)
        chosen[:, k] = ok
        count += ok
    rank = np.argsort(np.where(near < 0, 2, np.where(chosen, 0, 1)), 1, kind="stable")[:, :m]
    return np.take_along_axis(near, rank, 1)


def build(vectors: np.ndarray, seed: int = 0) -> Graph:
    """The graph of unit vectors, inserted in growing batches."""
    n, m = len(vectors), NEIGHBOURS
    x = np.ascontiguousarray(vectors, np.float32)
    height = np.minimum((-np.log(np.random.default_rng(seed).random(n) + 1e-12) / math.log(m)).astype(int), 8)
    order = np.argsort(-height, kind="stable")  # higher levels are complete before lower points come
    x, height = x[order], height[order]
    levels = [np.full((n + 1, 2 * m if level == 0 else m), -1, np.int64) for level in range(int(height.max(initial=0)) + 1)]
    g = Graph(x, levels, 0)
    at = min(n, 1)
    while at < n:
        size = min(n - at, max(16, min(at, 512)))
        q, new = x[at:at + size], np.arange(at, at + size)
        for level in range(len(levels) - 1, -1, -1):
            here = new[height[at:at + size] >= level]
            if not len(here):
                continue
            inside = q[here - at]
            ids, cos = g.search(inside, BUILD_BEAM, level) if at else (np.zeros((len(here), 0), int), np.zeros((len(here), 0)))
            ok = (ids >= 0) & (height[np.maximum(ids, 0)] >= level)
            among = inside @ inside.T
            np.fill_diagonal(among, -np.inf)
            k = min(m, len(here) - 1)
            if k > 0:
                top = np.argpartition(-among, k - 1, 1)[:, :k]
                ids, cos, ok = np.concatenate([ids, here[top]], 1), np.concatenate([cos, np.take_along_axis(among, top, 1)], 1), np.concatenate([ok, np.ones(top.shape, bool)], 1)
            _connect(g, level, here, np.where(ok, ids, -1), np.where(ok, cos, -np.inf))
        at += size
    back = np.append(order, -1)
    place = np.empty(n + 1, np.int64)
    place[back] = np.arange(n + 1)  # from the caller's order; the last row stands for "none"
    return Graph(np.ascontiguousarray(vectors, np.float32), [back[np.where(t < 0, n, t)][place] for t in levels], int(order[0]) if n else -1)


def _connect(g: Graph, level: int, points: np.ndarray, ids: np.ndarray, cos: np.ndarray) -> None:
    near, m = g.levels[level], NEIGHBOURS
    order = np.argsort(-cos, 1)[:, :BUILD_BEAM]
    ids, cos = np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)
    chosen = _diverse(g.x, ids, cos, m)
    near[points, :chosen.shape[1]] = chosen
    # The other direction: neighbours gain the new points, and choose again where they have too many.
    a, b = np.repeat(points, chosen.shape[1]), chosen.ravel()
    a, b = a[b >= 0], b[b >= 0]
    order = np.argsort(b, kind="stable")
    a, b = a[order], b[order]
    owners, first, size = np.unique(b, return_index=True, return_counts=True)
    if not len(owners):
        return
    limit, most = near.shape[1], 64
    gained = np.full((len(owners), most), -1, np.int64)
    row = np.repeat(np.arange(len(owners)), size)
    place = np.arange(len(b)) - np.repeat(first, size)
    gained[row[place < most], place[place < most]] = a[place < most]
    both = np.concatenate([near[owners], gained], 1)
    both.sort(1)
    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
    step = max(1, CELLS // (both.shape[1] * g.x.shape[1]))
    sim = np.concatenate([np.matmul(g.x[both[lo:lo + step]], g.x[owners[lo:lo + step]][:, :, None])[:, :, 0] for lo in range(0, len(owners), step)])
    sim = np.where(both >= 0, sim, -np.inf)
    order = np.argsort(-sim, 1)[:, :BUILD_BEAM + limit]
    both, sim = np.take_along_axis(both, order, 1), np.take_along_axis(sim, order, 1)
    few = (both >= 0).sum(1) <= limit
    near[owners[few]] = both[few][:, :limit]
    if (~few).any():
        near[owners[~few]] = _diverse(g.x, both[~few], sim[~few], limit)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return raw(column)[0].view(np.float64).reshape(-1, dim)


def _build_shard(key: tuple, t: pa.Table) -> pa.Table:
    t = t.sort_by("vec_id")
    x = _matrix(t["unit"], t["dim"][0].as_py())
    g = build(x)
    levels = [x.astype(np.int32).tobytes() for x in g.levels]
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "dim": t["dim"].slice(0, 1), "ids": pa.array([t["vec_id"].to_numpy().tobytes()], pa.binary()),
                     "copies": pa.array([t["copies"].to_numpy().tobytes()], pa.binary()), "units": pa.array([x.tobytes()], pa.binary()),
                     "levels": pa.array([levels], pa.list_(pa.binary())), "entry": pa.array([g.entry], pa.int64())})


def _pack_block(key: tuple, t: pa.Table) -> pa.Table:
    t = t.sort_by("vec_id")
    return pa.table({"q_dim": pa.array([key[0].as_py()], pa.int32()), "q_ids": pa.array([t["vec_id"].to_numpy().tobytes()], pa.binary()),
                     "q_units": pa.array([raw(t["unit"])[0].tobytes()], pa.binary())})


def dense(width: int, n: int) -> bool:
    """Whether a beam is so wide, of n points, that the products with all of them cost no more; they miss no link."""
    return width >= n or width > BEAM and width * DENSE >= n


def links_found(g: Graph, exact: np.ndarray, q: np.ndarray, skip: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) of every link that beams of ``width`` find, wider where a beam is all links. ``skip``: each query's own point or -1."""
    out = list(link_steps(g, exact, q, skip, width))
    return tuple(np.concatenate([np.zeros(0, int), *x]) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int))


def link_steps(g: Graph, exact: np.ndarray, q: np.ndarray, skip: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``links_found`` in parts of bounded size; every query's links are in one of them."""
    def sure(a: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep, step = np.zeros(len(a), bool), max(1, CELLS // q.shape[1])
        for lo in range(0, len(a), step):
            keep[lo:lo + step] = (q[a[lo:lo + step]] * exact[p[lo:lo + step]]).sum(1) >= COSINE  # double precision
        return a[keep], p[keep]

    for lo in range(0, len(q), STEP_QUERIES):
        todo, w = np.arange(lo, min(len(q), lo + STEP_QUERIES)), min(width, len(exact))
        while len(todo):
            if dense(w, len(exact)):
                step = max(1, CELLS // max(1, len(exact)))
                for at in range(0, len(todo), step):
                    these = todo[at:at + step]
                    row, p = np.nonzero(q[these].astype(np.float32) @ g.x.T >= COSINE - 1e-3)
                    a = these[row]
                    other = p != skip[a]
                    yield sure(a[other], p[other])
                break
            wider, step = [], max(1, STEP_QUERIES * BEAM // max(BEAM, w))
            for at in range(0, len(todo), step):
                these = todo[at:at + step]
                ids, cos = g.search(q[these].astype(np.float32), w)
                full = (cos[:, -1] >= COSINE - 1e-3) & (w < len(exact))
                hit = (cos >= COSINE - 1e-3) & (ids >= 0) & ~full[:, None] & (ids != skip[these][:, None])
                yield sure(these[np.nonzero(hit)[0]], ids[hit])
                wider.append(these[full])
            todo, w = np.concatenate(wider), min(4 * w, len(exact))


class Forest:
    """Spanning links of a block's queries (0 to n_queries - 1) and a shard's points (from n_queries on), added part by part."""

    def __init__(self, n_queries: int, n_points: int):
        self.first, self.root = n_queries, np.arange(n_queries + n_points)
        self.a: list[int] = []
        self.p: list[int] = []

    def _find(self, v: int) -> int:
        while self.root[v] != v:
            self.root[v] = self.root[self.root[v]]
            v = int(self.root[v])
        return v

    def add(self, a: np.ndarray, p: np.ndarray) -> None:
        new = self.root[a] != self.root[self.first + p]
        a, p = a[new], p[new]
        if not len(a):
            return
        # Of the links to one group of points each needs one, and of a query's links to what was one group before.
        _, some = np.unique(a * len(self.root) + self.root[self.first + p], return_index=True)
        a, p = a[some], p[some]
        order = np.argsort(p, kind="stable")
        a, p = a[order], p[order]
        head = np.diff(p, prepend=-1) > 0
        holder = a[np.maximum.accumulate(np.where(head, np.arange(len(p)), 0))]  # the first query of each point
        _, pairs = np.unique(np.where(head, -1 - np.arange(len(p)), a * self.first + holder), return_index=True)
        for u, v in zip(a[pairs].tolist(), p[pairs].tolist(), strict=True):
            x, y = self._find(u), self._find(self.first + v)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.a.append(u)
                self.p.append(v)
        while ((up := self.root[self.root]) != self.root).any():
            self.root = up


def block_links(row: dict) -> pa.RecordBatch:
    """One shard, one block of queries -> counts (b is null) and links that span what they join (n is null)."""
    dim = row["dim"]
    ids, copies, exact = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["copies"], np.int64), np.frombuffer(row["units"], np.float64).reshape(-1, dim)
    g = Graph(exact.astype(np.float32), [np.frombuffer(x, np.int32).reshape(len(ids) + 1, -1).astype(np.int64) for x in row["levels"]], row["entry"])
    own, q = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_units"], np.float64).reshape(-1, dim)
    at = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
    skip = np.where(ids[at] == own, at, -1)

    width, audited = BEAM, np.zeros(0, int)
    rng = np.random.default_rng(len(own))
    while True:
        forest, count, found = Forest(len(own), len(ids)), np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for a, p in link_steps(g, exact, q, skip, width):
            count += np.bincount(a, copies[p], len(own)).astype(np.int64)
            found += np.bincount(a, minlength=len(own))
            forest.add(a, p)
        if dense(width, len(ids)):
            break
        # Audit: random queries and random ones among those with links, against every vector of the shard.
        linked = np.flatnonzero(found)
        audited = np.union1d(rng.choice(len(own), min(AUDITED, len(own)), replace=False), rng.choice(linked, min(AUDITED, len(linked)), replace=False) if len(linked) else audited)
        true = q[audited] @ exact.T >= COSINE
        true[np.flatnonzero(skip[audited] >= 0), skip[audited][skip[audited] >= 0]] = False
        if found[audited].sum() >= TARGET * true.sum():
            break
        width *= 2
    some = np.flatnonzero(count)
    us, vs = own[np.array(forest.a, np.int64)], ids[np.array(forest.p, np.int64)]
    return pa.record_batch([pa.array(np.concatenate([own[some], us])), pa.array([None] * len(some) + vs.tolist(), pa.int64()),
                            pa.array(count[some].tolist() + [None] * len(us), pa.int64())], names=["a", "b", "n"])


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            yield block_links({c: b.column(c)[k].as_py() for c in b.schema.names})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``."""
    spark = vectors.sparkSession
    s = Scratch(spark, "embeddings")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    units = s.save(rows.mapInArrow(_unit, "vec_id long, dim int, unit binary"), "units")
    known = units.where("unit is not null and vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("dim", "unit")).alias("x")).select("vec_id", "x.*")
    keyed = known.select("vec_id", F.xxhash64("unit").alias("k1"), F.xxhash64(F.lit(1), F.reverse(F.hex("unit"))).alias("k2"))
    classes = keyed.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    member = s.save(keyed.join(classes, ["k1", "k2"]).select("vec_id", "rep", "copies"), "members")
    reps = known.join(member.where("vec_id = rep").select("vec_id", "copies"), "vec_id")
    n, width = reps.agg(F.count("*"), F.max("dim")).first()
    shards = max(MIN_SHARDS, math.ceil((n or 0) * 8 * (width or 0) / SHARD_BYTES))
    blocks = max(1, math.ceil((n or 0) / QUERY_BLOCK), math.ceil((n or 0) * 8 * (width or 0) / BLOCK_BYTES))
    reps = s.save(reps.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(shards))).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks))), "reps")

    # One shard or block a file: what reads them holds one at a time.
    index = s.save(reps.withColumn("shard", F.col("dim") * F.lit(shards).cast("long") + F.col("part")).groupBy("shard").applyInArrow(
        _build_shard, "shard long, dim int, ids binary, copies binary, units binary, levels array<binary>, entry long"), "index", large_rows=True)
    packed = s.save(reps.groupBy("dim", "block").applyInArrow(_pack_block, "q_dim int, q_ids binary, q_units binary"), "blocks", large_rows=True)
    s.drop(reps)
    # No equality, which would gather all rows of a dimension in one task.
    pairs = index.drop("shard").join(packed, (F.col("dim") <= F.col("q_dim")) & (F.col("dim") >= F.col("q_dim")))
    rows_at_once = spark.conf.get(ROWS_AT_ONCE)
    spark.conf.set(ROWS_AT_ONCE, 1)  # a row is a shard and a block
    try:
        found = s.save(pairs.mapInArrow(_query_blocks, "a long, b long, n long"), "found")
    finally:
        spark.conf.set(ROWS_AT_ONCE, rows_at_once)

    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    comps = components(found.where("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v")), s)
    of = (member.join(counts, "rep", "left").join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
          .select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    return (units.select("vec_id").join(of, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.expr("vec_id <=> component_id")))
