"""Whitening of embeddings by shifted CholeskyQR: distributed Gram passes, triangular solves, SVD of the small R.

1. Entries become the longs x = floor(1024 * c) + 100000; one aggregate gives n and the sum S of each dimension, exactly.
2. Each pass takes the centred rows y = x - S/n through the triangular solve with the R composed so far, sums the Gram
   matrix of the result over all rows and factors it by Cholesky on the driver (with a shift where it is not safely
   positive definite: always at first). R grows by that factor. Passes end when the Gram matrix is the identity on all
   directions that the data have.
3. The SVD of R has the unit eigenvectors of the covariance as its right vectors and sqrt(n * eigenvalue) as its values.
   A last pass projects every centred row on the leading ones; two more measure the result's mean and covariance.

A task holds one batch of rows and one d x d matrix, and the driver d x d doubles (8 MB at 1,024 dimensions), whatever
the number of rows.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are dropped; so are rows of
another length than the most frequent one (the shorter of equally frequent ones); rows that repeat an id and rows without id each count and return; entries beyond
+-2**30 count as that bound; directions without variance (all of them for a single row or equal rows) give no component;
``deviation`` is null where it doesn't fit a long; an empty table gives an empty result; only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

SCALE = 1024
OFFSET = 100_000
MOST = 2.0**30
COMPONENTS = 8
#: Passes at most; well-conditioned rows take three.
PASSES = 8
#: Part of the largest eigenvalue below which a direction has no variance (the rounding of a sum of squares).
NOTHING = 1e-13
ROWS = 4096

WHITE = "vec_id long, component int, n long, deviation long, whitened double"
_EPS = np.finfo(np.float64).eps


def _longs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, array<double> -> vec_id, dim, x as longs, for rows that take part."""
    for b in batches:
        size = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
        c = b.column(1).flatten().to_numpy(zero_copy_only=False)  # null entries become NaN
        row = np.repeat(np.arange(len(size)), size)
        ok = (size > 0) & (np.bincount(row, ~np.isfinite(c), len(size)) == 0)
        x = np.floor(SCALE * c[ok[row]].clip(-MOST, MOST)).astype(np.int64) + OFFSET
        at = np.concatenate([[0], np.cumsum(size[ok])]).astype(np.int32)
        yield pa.record_batch([b.column(0).filter(pa.array(ok)), pa.array(size[ok], pa.int32()), pa.ListArray.from_arrays(pa.array(at), pa.array(x))], names=["vec_id", "dim", "x"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def solve(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The q with q @ r = y for an upper triangular r."""
    q = np.empty_like(y)
    for j in range(len(r)):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def factor(gram: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """The upper Cholesky factor of ``gram``, with a shift of the size of its rounding errors if asked for or needed."""
    d = len(gram)
    s = 11 * (n * d + d * (d + 1)) * _EPS * np.linalg.norm(gram, 2) if shift else 0.0
    for _ in range(60):
        try:
            return np.linalg.cholesky(gram + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            s = max(2 * s, d * _EPS * np.linalg.norm(gram, 2), np.finfo(np.float64).tiny)
    raise np.linalg.LinAlgError("a Gram matrix has no Cholesky factor")


def summed(rows: DataFrame, dim: int, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` (a matrix of ``width`` columns for some rows x) over all rows: a task adds up its own, Spark the tasks'."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                got = part(_matrix(b.column(0).slice(lo, ROWS), dim))
                total = got if total is None else total + got
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["k", "v"])

    got = rows.select("x").mapInArrow(add, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").toArrow()
    return got["v"].to_numpy().reshape(-1, width)


def compose(rows: DataFrame, dim: int, n: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The upper triangular R for which the centred rows times its inverse have orthonormal columns."""
    r = np.eye(dim)
    for k in range(PASSES):
        whole, first = r, k == 0

        def gram(x: np.ndarray, whole: np.ndarray = whole, first: bool = first) -> np.ndarray:
            q = centred(x) if first else solve(centred(x), whole)
            return q.T @ q

        g = summed(rows, dim, dim, gram)
        if first and not g.any():
            return np.zeros((dim, dim))
        if not first:
            found = np.linalg.eigvalsh(g)
            found = found[found > 0.5]  # the others are directions without variance
            if len(found) and np.abs(found - 1).max() < 100 * dim * _EPS:
                break
        r = factor(g, n, first) @ r
    return r


def components(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors as columns, eigenvalues, their parts of the trace) of the covariance, largest first."""
    _, values, right = np.linalg.svd(r)
    e = values * values / n
    real = np.flatnonzero(e > NOTHING * e[0]) if e[0] > 0 else np.zeros(0, int)
    kept = real[:most]
    return right[kept].T, e[kept], e[kept] / e.sum() if len(kept) else e[kept]


def whiten(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each row that takes part and up to ``most`` components."""
    spark = vectors.sparkSession
    s = Scratch(spark, "whitening")
    rows = s.save(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
                  .mapInArrow(_longs, "vec_id long, dim int, x array<long>"), "longs")
    found = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if found is None:
        return spark.createDataFrame([], f"{WHITE}, explained double, identity_error double")
    dim, n = found["dim"], found["count"]
    rows = rows.where(F.col("dim") == dim)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim  # Python's integers: exact at any size
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                total = [a + int(v) for a, v in zip(total, _matrix(b.column(0).slice(lo, ROWS), dim).sum(0), strict=True)]
        yield pa.record_batch([pa.array(range(dim), pa.int32()), pa.array([str(t) for t in total])], names=["k", "s"])

    got = rows.select("x").mapInArrow(sums, "k int, s string").groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")).orderBy("k").collect()
    total = [int(g["s"]) for g in got]
    # S/n as a whole part and a rest, so that x - S/n loses nothing of a large x.
    mean, rest = np.array([t // n for t in total], np.int64), np.array([t % n / n for t in total])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - mean) - rest

    r = compose(rows, dim, n, centred)
    axes, e, explained = components(r, n, most)
    k = len(e)
    if not k:
        return spark.createDataFrame([], f"{WHITE}, explained double, identity_error double")
    to = axes / np.sqrt(e)
    middle = summed(rows, dim, k, lambda x: (centred(x) @ to).sum(0, keepdims=True))[0] / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ to - middle
        return w.T @ w

    error = float(np.abs(summed(rows, dim, k, spread) / n - np.eye(k)).max())
    left = [t % n for t in total]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                x = _matrix(part.column(1), dim)
                y = centred(x)
                far = float((n * n * (y * y).sum(1)).max(initial=0))
                if far < 2.0**62:  # and so every n * x - S, by way of the whole part of S/n, and its square fit a long
                    z = (x - mean) * n - np.array(left, np.int64)
                    deviation = (z * z).sum(1).tolist()
                else:
                    deviation = [sum((int(v) * n - m) ** 2 for v, m in zip(one, left, strict=True)) for one in x - mean]
                deviation = pa.array([v if v < 2**63 else None for v in deviation], pa.int64())
                w = y @ to
                which = np.repeat(np.arange(len(x)), k)
                yield pa.record_batch([part.column(0).take(which), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(which), n)),
                                       deviation.take(which), pa.array(w.ravel())], names=["vec_id", "component", "n", "deviation", "whitened"])

    share = F.element_at(F.array(*[F.lit(float(v)) for v in explained]), F.col("component"))
    return rows.select("vec_id", "x").mapInArrow(project, WHITE).withColumn("explained", share).withColumn("identity_error", F.lit(error))
