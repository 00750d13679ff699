"""Hard negatives against brute force, and their defined edge cases."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest

from tidemark.llm import hard_negatives
from tidemark.llm.hard_negatives import FIELDS, Block, best, mine, relabelled
from tidemark.llm.queries import ORACLES, QUERIES


def brute(rows, every=100):
    kept = [(i, label, [max(-2**24, min(2**24, math.floor(256 * c))) for c in v]) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, (i, label, x) in enumerate(kept):
        if i % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), j, other) for b, (j, other, y) in enumerate(kept) if b != a and len(y) == len(x)]
        for p, pid, _ in sorted(s for s in scored if s[2] == label)[:5]:
            some = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [(i, pid, k + 1, j, -p, -n) for k, (n, j, _) in enumerate(some)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v, 1, "s") for i, label, v in rows], "vec_id long, label int, embedding array<double>, rank int, score string")


def rows_of(n, d, seed, labels=3, spread=1.0):
    rng = random.Random(seed)
    return [(i, rng.randrange(labels), [rng.gauss(0.3, spread) for _ in range(d)]) for i in range(n)]


def test_packed_products_are_exact():
    rng = np.random.default_rng(3)
    for n, d, most in ((1, 1, 5), (7, 3, 300), (FIELDS + 9, 5, 200), (50, 64, 2**24), (9, 2, 0)):
        x, a = rng.integers(-most, most + 1, (n, d)), rng.integers(-most, most + 1, d)
        assert (Block(x, most, most).scores(a) == x @ a).all()
    assert (Block(np.zeros((4, 0), np.int64), 0, 0).scores(np.zeros(0, np.int64)) == 0).all()


def test_best_with_ties():
    assert best(np.array([3, 9, 9, 1, 9]), 2).tolist() == [1, 2]
    assert best(np.array([3, 9]), 5).tolist() == [1, 0]
    assert best(np.array([], np.int64), 5).tolist() == []


def test_random_rows_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 1024)  # more blocks than MIN_BLOCKS
    rows = rows_of(400, 6, 1)
    assert sorted(map(tuple, mine(frame(spark, rows), every=20).collect())) == brute(rows, 20)


def test_ties_copies_and_repeated_ids(spark):
    rng = random.Random(8)
    rows = [(i, i % 2, [float(rng.randrange(2)), float(rng.randrange(2))]) for i in range(120)]
    rows += [(40 + i % 3, 1, [1.0, 1.0]) for i in range(60)] + [(0, 0, [1.0, 0.0]), (100, 5, [1.0, 1.0]), (100, 5, [1.0, 1.0])]
    assert sorted(map(tuple, mine(frame(spark, rows), every=50).collect())) == brute(rows, 50)


def test_rows_that_take_no_part_and_odd_lengths(spark):
    rows = rows_of(60, 3, 4, spread=0.2)
    odd = [(None, 1, [1.0, 1.0, 1.0]), (200, None, [1.0, 1.0, 1.0]), (300, 1, None), (400, 1, [1.0, None, 1.0]), (500, 1, [1.0, float("nan"), 1.0]), (600, 1, [float("inf"), 1.0, 1.0]),
           (700, 1, [0.5]), (701, 1, [0.6]), (702, 2, [0.55]), (800, 1, []), (801, 1, []), (802, 2, []), (900, 9, [1.0, 1.0, 1.0]), (1000, 1, [1e300, 1.0, -1e300]), (-100, 0, [0.4, 0.4, 0.4])]
    got = sorted(map(tuple, mine(frame(spark, rows + odd)).collect()))
    assert got == brute(rows + odd)
    assert {g[0] for g in got} & {200, 300, 400, 500, 600, 900} == set() and (800, 801, 1, 802, 0, 0) in got and any(g[0] == 700 for g in got)


def test_no_rows(spark):
    got = mine(frame(spark, []))
    assert got.collect() == [] and got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_labels_move_on(spark):
    got = frame(spark, [(7, 9, []), (8, 9, []), (14, None, []), (None, 3, [])]).transform(relabelled(7, 10)).collect()
    assert [r.label for r in got] == [0, 9, None, 3]


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_whole_table_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    got = QUERIES["op11_hard_negatives"](spark, f"/root/testdata/{sf}")
    want = con.execute(ORACLES["op11_hard_negatives"])
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want.fetchall())
