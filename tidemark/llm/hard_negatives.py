"""Hard negatives by Kronecker-packed products: many exact inner products from one multiplication per component.

1. A component c becomes x = floor(256 * c). Rows are dealt out to blocks of at most about ``BLOCK_BYTES``; a task meets one
   block after the other and, behind each, all anchors, which stream by in batches. Each row is sent once, each
   anchor once per block.
2. A block packs its rows: component k of up to ``FIELDS`` rows, biased to be non-negative, stands in fields of one wide
   integer. An anchor multiplies its own biased component k with that integer and adds up over k; each
   field of the sum then holds the biased inner product with one row, and fields are wide enough that none runs into the next.
   Unpacking takes the biases off again.
3. A first search gives each anchor its best rows of the same label, a second one, for each of their scores, the best
   rows of other labels between that score's ``FLOOR`` per cent and itself. A block keeps the best few per anchor, and a
   ranking over the blocks' findings (cut short before the shuffle) the best of all. Nothing is estimated.

Defined results: rows with a null id, a null label, a null vector or any null or non-finite component take no part; vectors of different
lengths don't meet; an empty vector scores 0 with other empty ones; scaled components beyond +-2**24 count as that bound;
rows that repeat an id are rows of their own, also as anchors, and a row isn't its own positive; ties go to the smaller id; an anchor without
positives, and a positive without negatives (each with a negative score among them), give no row; an empty table gives an empty
result; only the id, label and vector columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

SCALE = 256
MOST = 2.0**24
EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: A negative has at least this many hundredths of the positive's score.
FLOOR = 80
BLOCK_BYTES = 16 << 20
MIN_BLOCKS = 16
FIELDS = 4096

ROW = "vec_id long, label long, dim int, x binary, low long, high long"
FOUND = "anchor long, ceiling long, vec_id long, score long"
_LEAST = np.iinfo(np.int64).min


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, array<double> -> ``ROW``: x as 32-bit integers with their least and greatest, for rows that take part."""
    for b in batches:
        vectors = b.column(2)
        size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        c = vectors.flatten().to_numpy(zero_copy_only=False)  # null components become NaN
        row = np.repeat(np.arange(len(size)), size)
        ok = (np.bincount(row, ~np.isfinite(c), len(size)) == 0) & ~np.array(vectors.is_null())
        x = np.floor(SCALE * c[ok[row]].clip(-MOST, MOST)).clip(-MOST, MOST).astype("<i4")
        size, held = size[ok], b.filter(pa.array(ok))
        at = np.concatenate([[0], np.cumsum(size)])
        full = np.flatnonzero(size)
        low, high = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        if len(full):
            low[full], high[full] = np.minimum.reduceat(x, at[full]), np.maximum.reduceat(x, at[full])
        data = x.tobytes()
        yield pa.record_batch([held.column(0), held.column(1), pa.array(size, pa.int32()), pa.array([data[4 * i:4 * j] for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                               pa.array(low), pa.array(high)], names=["vec_id", "label", "dim", "x", "low", "high"])


class Block:
    """Rows in the order of their ids, packed: ``scores`` gives their inner products with one anchor."""

    def __init__(self, x: np.ndarray, bias: int, high: int):
        n, d = x.shape
        self.n, self.bias = n, bias
        self.kind = np.dtype("<u4" if d * (high + bias) ** 2 < 1 << 32 else "<u8")
        held = (x + bias).astype(self.kind)
        self.wide = [[int.from_bytes(c.tobytes(), "little") for c in np.ascontiguousarray(held[i:i + FIELDS].T)] for i in range(0, n, FIELDS)]
        self.off = bias * x.sum(1, dtype=np.int64) + d * bias * bias

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        biased = [int(a) + self.bias for a in anchor]
        out = []
        for k, wide in enumerate(self.wide):
            total = 0
            for column, a in zip(wide, biased, strict=True):
                total += column * a
            fields = min(FIELDS, self.n - k * FIELDS)
            out.append(np.frombuffer(total.to_bytes(fields * self.kind.itemsize, "little"), self.kind).astype(np.int64))
        return np.concatenate(out) - self.off - self.bias * int(anchor.sum(dtype=np.int64))


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, the highest first, the earlier first of equal ones."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        over = np.flatnonzero(scores > least)
        pick = np.concatenate([over, np.flatnonzero(scores == least)[:k - len(over)]])
    else:
        pick = np.arange(len(scores))
    return pick[np.lexsort((pick, -scores[pick]))]


class Shelf:
    """A block's rows as they arrive, and the search for anchors once they are complete."""

    def __init__(self, bias: int, high: int):
        self.bias, self.high, self.parts, self.block = bias, high, [], None

    def add(self, rows: pa.RecordBatch) -> None:
        self.parts.append(rows)

    def _ready(self) -> bool:
        if self.block is None and self.parts:
            t = pa.Table.from_batches(self.parts).sort_by([("vec_id", "ascending"), ("at", "ascending")])
            self.parts = []
            self.at, self.ids, labels = (t[c].to_numpy() for c in ("at", "vec_id", "label"))
            self.block = Block(_components(t["x"]), self.bias, self.high)
            kinds, which = np.unique(labels, return_inverse=True)
            order = np.argsort(which, kind="stable")
            self.of = dict(zip(kinds.tolist(), np.split(order, np.cumsum(np.bincount(which))[:-1]), strict=True))
        return self.block is not None

    def positives(self, at: int, label: int, x: np.ndarray, _: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(ceiling, places, scores): the best other rows of the anchor's label; the ceiling means nothing."""
        same = self.of.get(label)
        if same is not None:
            same = same[self.at[same] != at]
            scores = self.block.scores(x)[same]
            pick = best(scores, POSITIVES)
            yield 0, same[pick], scores[pick]

    def negatives(self, at: int, label: int, x: np.ndarray, ceilings: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(ceiling, places, scores): the best rows of other labels under each ceiling and over its ``FLOOR`` per cent."""
        scores = self.block.scores(x)
        if label in self.of:
            scores[self.of[label]] = _LEAST
        for c in ceilings:
            some = np.flatnonzero((scores <= c) & (scores >= -(-FLOOR * c // 100)))
            pick = some[best(scores[some], NEGATIVES)]
            yield c, pick, scores[pick]

    def search(self, anchors: pa.RecordBatch, how: str) -> pa.RecordBatch:
        out = []
        if self._ready():
            x = _components(anchors.column("x"))
            for i, (at, label, ceilings) in enumerate(zip(*(anchors.column(c).to_pylist() for c in ("at", "label", "ceilings")), strict=True)):
                for ceiling, places, scores in getattr(self, how)(at, label, x[i], ceilings):
                    out.append((np.full(len(places), at), np.full(len(places), ceiling), self.ids[places], scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        return pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], names=["anchor", "ceiling", "vec_id", "score"])


def _components(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), -1).astype(np.int64)


def _searched(rows: DataFrame, anchors: DataFrame, blocks: int, bias: int, high: int, how: str) -> DataFrame:
    """What ``how`` of ``Shelf`` finds for each anchor in each block of rows of its dimension."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf, now = None, None
        for b in batches:
            block, side = (b.column(c).to_numpy() for c in ("block", "side"))
            cut = np.flatnonzero((block[1:] != block[:-1]) | (side[1:] != side[:-1])) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows], strict=True):
                if i == j:
                    continue
                if block[i] != now:
                    shelf, now = Shelf(bias, high), block[i]
                if side[i]:
                    yield shelf.search(b.slice(i, j - i), how)
                else:
                    shelf.add(b.slice(i, j - i))

    place = F.col("dim") * F.lit(blocks).cast("long")
    left = rows.select((place + F.pmod(F.xxhash64("at"), F.lit(blocks))).alias("block"), F.lit(0).alias("side"), "at", "vec_id", "label", "x", F.lit(None).cast("array<long>").alias("ceilings"))
    right = (anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
             .select((place + F.col("part")).alias("block"), F.lit(1).alias("side"), "at", "vec_id", "label", "x", "ceilings"))
    return left.union(right).repartition(2 * blocks, "block").sortWithinPartitions("block", "side", "at").mapInArrow(walk, FOUND)


def mine(vectors: DataFrame, every: int = EVERY, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors are rows whose id ``every`` divides."""
    s = Scratch(vectors.sparkSession, "negatives")
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = s.save(given.where("vec_id is not null and label is not null and v is not null").mapInArrow(_scaled, ROW)
                  .withColumn("at", F.monotonically_increasing_id()), "rows")
    n, low, high, dim = rows.agg(F.count("*"), F.min("low"), F.max("high"), F.max("dim")).first()
    bias = max(0, -(low or 0))
    blocks = max(MIN_BLOCKS, math.ceil(n * 8 * (dim or 0) / BLOCK_BYTES))
    top = lambda found, k, *key: (found.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k))

    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("ceilings", F.lit(None).cast("array<long>"))
    found = _searched(rows, anchors, blocks, bias, high or 0, "positives")
    positives = s.save(top(found, POSITIVES, "anchor").select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # At most POSITIVES scores for each anchor; nothing lies between a negative score and a part of it.
    ceilings = positives.where("positive_score >= 0").groupBy(F.col("anchor").alias("at")).agg(F.collect_set("positive_score").alias("ceilings"))
    found = _searched(rows, anchors.drop("ceilings").join(ceilings, "at"), blocks, bias, high or 0, "negatives")
    negatives = top(found, NEGATIVES, "anchor", "ceiling").select("anchor", F.col("ceiling").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select(F.col("at").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (positives.join(negatives, ["anchor", "positive_score"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def relabelled(every: int, labels: int, id_col: str = "vec_id", label_col: str = "label") -> Callable[[DataFrame], DataFrame]:
    """Labels of rows whose id ``every`` divides move on by one, modulo ``labels``."""
    return lambda df: df.withColumn(label_col, F.when(F.col(id_col) % every == 0, (F.col(label_col).cast("long") + 1) % labels).otherwise(F.col(label_col)))
