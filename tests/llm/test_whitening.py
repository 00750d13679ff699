"""Whitening against numpy's eigenvectors, and its defined edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm.queries import QUERIES
from tidemark.llm.whitening import factor, solve, whiten

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(rows, most=8):
    """{(id, component): (n, deviation, |whitened|, explained)} by one eigen decomposition."""
    kept = [(i, v) for i, v in rows if v and None not in v and all(math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in kept]
    n, total = len(x), [sum(c) for c in zip(*x, strict=True)]
    y = np.array(x, float) - np.array([t / n for t in total])
    e, axes = np.linalg.eigh(y.T @ y / n)
    e, axes = e[::-1], axes[:, ::-1]
    out = {}
    for (i, _), one, centred in zip(kept, x, y, strict=True):
        deviation = sum((n * a - t) ** 2 for a, t in zip(one, total, strict=True))
        for k in range(min(most, len(e))):
            if e[k] > 1e-9 * e[0]:
                out.setdefault((i, k + 1), []).append((n, deviation, centred @ axes[:, k] / math.sqrt(e[k]), e[k] / e.sum()))
    return out


def check(got, want):
    assert sorted((r.vec_id, r.component) for r in got) == sorted(k for k, v in want.items() for _ in v)
    for component in {r.component for r in got}:
        mine = {r.vec_id: r for r in got if r.component == component}
        sign = None
        for i, r in mine.items():
            n, deviation, w, explained = want[i, component][0]
            assert (r.n, r.deviation) == (n, deviation if deviation < 2**63 else None)
            assert r.explained == pytest.approx(explained, rel=1e-9)
            assert abs(r.whitened) == pytest.approx(abs(w), abs=1e-6)
            if abs(w) > 1e-3:
                sign = sign or math.copysign(1, w * r.whitened)
                assert w * r.whitened * sign > 0
    assert all(r.identity_error <= 1e-9 for r in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    got = QUERIES["op12_embedding_whitening"](spark, f"/root/testdata/{sf}")
    assert got.columns == COLUMNS
    check(got.collect(), plain(rows))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, x string, dim int")


def random_rows(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, [float(c) for c in rng.normal(size=d) * np.linspace(1, 0.2, d)]) for i in range(n)]


def test_badly_conditioned_and_dependent_dimensions(spark):
    rows = [(i, [*v, 5.0, 2 * v[0], v[1] * 1e-3 + 1e4 * v[2]]) for i, v in random_rows(200, 4)]
    got = whiten(frame(spark, rows)).collect()
    want = plain(rows)
    assert {r.component for r in got} >= {1, 2, 3, 4} and {r.component for r in got} <= set(range(1, 8))
    check([r for r in got if r.component <= 4], {k: v for k, v in want.items() if k[1] <= 4})


def test_rows_without_a_place(spark):
    rows = [*random_rows(50, 3), (100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]), (104, [float("inf"), 1.0, 1.0])]
    odd = [(105, [1.0, 2.0]), (106, [1.0])]
    check(whiten(frame(spark, rows + odd)).collect(), plain(rows))


def test_repeated_ids_null_ids_and_large_values(spark):
    rows = [(i, [c * 1e5 for c in v]) for i, v in random_rows(30, 3)]
    got = whiten(frame(spark, [*rows, (0, rows[1][1]), (None, rows[2][1])])).collect()
    assert sum(r.vec_id == 0 for r in got) == 6 and sum(r.vec_id is None for r in got) == 3
    far = whiten(frame(spark, [(i, [v[0] * 2.0**29]) for i, v in random_rows(2000, 1)])).collect()
    want = plain([(i, [min(2.0**30, max(-2.0**30, v[0] * 2.0**29))]) for i, v in random_rows(2000, 1)])
    for r in far:
        exact = want[r.vec_id, 1][0][1]
        assert r.deviation == (exact if exact < 2**63 else None)
    assert any(r.deviation is None for r in far) and all(r.identity_error < 1e-9 for r in far)


def test_no_rows_and_no_variance(spark):
    assert whiten(frame(spark, [])).collect() == [] and whiten(frame(spark, [])).columns == COLUMNS
    assert whiten(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(9)])).collect() == []
    assert whiten(frame(spark, [(1, None), (2, [])])).collect() == []


def test_triangular_solve_and_shift():
    rng = np.random.default_rng(4)
    r = np.triu(rng.normal(size=(6, 6))) + 5 * np.eye(6)
    y = rng.normal(size=(9, 6))
    assert np.allclose(solve(y, r) @ r, y)
    flat = np.outer([1.0, 2, 3], [1, 2, 3])  # rank one: plain Cholesky fails
    f = factor(flat, 10, False)
    assert np.allclose(f.T @ f, flat, atol=1e-10) and (np.diag(f) > 0).all()
