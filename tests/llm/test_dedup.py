"""Near-duplicates, repeated passages and vectors against plain versions, and their defined edge cases."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.embeddings import Forest, build, link_steps, links_found, near_vectors
from tidemark.llm.ids import maybe_in, one_of_equal, without
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.scratch import Scratch
from tidemark.llm.substrings import recall, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, component_id string, rep int"
SMALL = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_near(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    roots = union(pairs, ids)
    return {i: (len(sets[i]), roots[i], roots[i] == i) for i in ids}


def text_of(rng, n):
    return " ".join(rng.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split()) + str(rng.randrange(400)) for _ in range(n))


def near_docs(n_groups=6, size=12, seed=3):
    """Groups of copies with a few words changed, so that some similarities lie on either side of 0.75."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        base = text_of(rng, 120).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    return rows


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)]
    links = [*chain, *star, (7, 7), (9, 8), (8, 9), (9, 8), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long"), Scratch(spark, "t")).collect()}
    want = union([x for x in links if x[0] is not None], {n for x in links for n in x if n is not None})
    assert got == {n: c for n, c in want.items() if n != c}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "t")).count() == 0


def test_minhash_equals_brute_force_on_groups_around_the_threshold(spark):
    rows = near_docs()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_near(rows)


def test_minhash_edge_cases(spark):
    long_text = text_of(random.Random(1), 60_000)
    rows = [(1, None, "en", "x", 1), (2, "", "en", "x", 1), (3, " \t\n", "en", "x", 1), (4, "One two", None, None, None), (5, "one TWO", None, None, None),
            (6, "one two three", "a", "b", 2), (7, long_text, "", "", 3), (8, long_text + " end", "", "", 3), (9, "É a b c d", "", "", 0), (10, "é a b c d", "", "", 0),
            (7, long_text, "", "", 3), (None, "one two", "", "", 0)]
    out = near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out}
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False) and got[6] == (1, 6, True)
    assert got[7][1:] == (7, True) and got[8][1:] == (7, False)
    assert got[9][1] == 9 and got[10][1] == 10  # only A-Z are lower-cased
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_repeated_passages_go_from_all_but_the_first(spark):
    rng = random.Random(5)
    passage = text_of(rng, 60)
    own = [text_of(rng, 80) for _ in range(7)]
    rows = [(10 + k, f"{own[k]} {passage} {own[k + 3]}") for k in range(3)] + [(1, own[6])]
    got = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[10]["text"] == rows[0][1] and got[1]["text"] == own[6]
    for k in (1, 2):
        assert got[10 + k]["text"] == f"{own[k]} {own[k + 3]}" and got[10 + k]["n_removed_words"] == 60


def test_small_edits_within_a_passage_are_bridged(spark):
    rng = random.Random(6)
    words = text_of(rng, 120).split()
    edited = words[:50] + ["changed"] + words[51:]
    rows = [(1, " ".join(words)), (2, text_of(rng, 40) + " " + " ".join(edited))]
    got = {r["doc_id"]: r["n_removed_words"] for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 120}


def test_a_cut_passage_stays_in_one_document(spark):
    """Document 1 of each group holds an excerpt with an edit of the passage that 2 and 3 hold in full; so bands differ in who is first."""
    rng = random.Random(8)
    rows, passages = [], []
    for g in range(12):
        words = text_of(rng, 200).split()
        part = words[70:130]
        part[30] = "changed"
        passages.append(words)
        rows += [(10 * g + k, f"{text_of(rng, 40)} {' '.join(x)} {text_of(rng, 40)}") for k, x in ((1, part), (2, words), (3, words))]
    got = [f" {r['text']} " for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    for words in passages:
        for k in [*range(0, 65, 5), *range(135, 195, 5)]:
            assert sum(f" {' '.join(words[k:k + 5])} " in t for t in got) == 1


def test_passages_around_a_frequent_line_are_found(spark):
    """The line of 40 words is in eight documents of each group, six words more on each side in two that aren't first."""
    rng = random.Random(9)
    rows = []
    for g in range(40):
        line, left, right = (text_of(rng, n) for n in (40, 6, 6))
        rows += [(100 * g + k, f"{text_of(rng, 40)} {f'{left} {line} {right}' if k in (6, 8) else line} {text_of(rng, 40)}") for k in range(1, 9)]
    got = {r["doc_id"]: r["n_removed_words"] for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: n for i, n in got.items() if n} == {100 * g + 8: 52 for g in range(40)}


def test_edited_copies_behind_a_shorter_excerpt_are_found(spark):
    rng = random.Random(10)
    rows = []
    for g in range(40):
        words = text_of(rng, 60).split()
        edited = [*words[:30], "changed", *words[31:]]
        rows += [(10 * g + k, f"{text_of(rng, 40)} {' '.join(x)} {text_of(rng, 40)}") for k, x in ((1, words[10:50]), (2, words), (3, edited))]
    found = lambda rows: {r["doc_id"] for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["n_removed_words"]}
    alone = found([r for r in rows if r[0] % 10 > 1])
    assert len(alone) >= 28 and found(rows) >= alone


def test_substring_edge_cases(spark):
    rng = random.Random(7)
    long_text, inside = text_of(rng, 30_000), text_of(rng, 70)
    rows = [(1, None, "x", None, 1), (2, "", "x", "c", 1), (3, "short", "x", "c", 1), (4, long_text, "x", "c", 1), (5, long_text, "x", "c", 1), (5, long_text, "x", "c", 1),
            (None, long_text, "x", "c", 1), (6, f"{inside} {inside}", "x", "c", 1)]
    out = remove_repeats(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "text", "lang", "component_id", "rep", "n_removed_words"]
    got = [(r["doc_id"], r["text"], r["n_removed_words"]) for r in out.collect()]
    assert sorted(x[0] or 0 for x in got) == [0, 1, 2, 3, 4, 5, 5, 6]
    by = {x[0]: x[1:] for x in got}
    assert by[1] == (None, 0) and by[2] == ("", 0) and by[3] == ("short", 0)
    assert by[4] == (long_text, 0) and by[None] == (long_text, 0) and by[6] == (f"{inside} {inside}", 0)
    assert all(x[1].strip() == "" and x[2] == 30_000 for x in got if x[0] == 5)
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    assert recall(0.75) > 0.9 and recall(1.0) == 1.0


def test_repeats_in_the_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    seen: dict[tuple, set] = {}
    for r in remove_repeats(docs).collect():
        w = WORD.findall(lower(r["text"]))
        for k in range(len(w) - 60):
            seen.setdefault(tuple(w[k:k + 61]), set()).add(r["doc_id"])
    assert not [g for g, ids in seen.items() if len(ids) > 1]


def brute_vectors(rows):
    good = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    ids = sorted(good)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9]
    roots = union(pairs, [i for i, _ in rows])
    return {i: (sum(i in p for p in pairs), roots[i], roots[i] == i) for i, _ in rows}


def test_vectors_equal_brute_force_and_edge_cases(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 16))
    rows = [(i, (centres[i % 20] + 0.25 * rng.standard_normal(16)).tolist()) for i in range(300)]
    rows += [(1000, rows[0][1]), (1001, [2 * x for x in rows[0][1]]), (1002, None), (1003, []), (1004, [0.0] * 16), (1005, [None, 1.0]), (1006, [float("nan")] * 16),
             (1007, [float("inf")] * 16), (1008, [1.0, 0.0]), (1009, [1.0, 0.01]), (1010, [1e300] * 16)]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, n_links string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(frame).collect()}
    assert got == brute_vectors(rows)
    assert near_vectors(frame.limit(0)).count() == 0
    odd = near_vectors(spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")).collect()
    assert len(odd) == 3 and all(r["n_links"] == 0 for r in odd)


def test_graph_search_finds_what_brute_force_finds():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 32))
    x[1500:] = x[:1500] + 0.2 * rng.standard_normal((1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, p = links_found(build(x), x, x[:500], np.arange(500), 32)
    true = (x[:500] @ x.T >= 0.9).sum() - 500
    assert len(a) >= 0.97 * true


def test_one_large_group_of_links_takes_little_memory_and_loses_none():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((9000, 8))
    x[:6000] = x[0] + 0.02 * rng.standard_normal((6000, 8))   # 6,000 vectors that all link
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g, q = build(x), x[:1024]
    tracemalloc.start()
    forest, n = Forest(len(q), len(x)), np.zeros(len(q), int)
    for a, p in link_steps(g, x, q, np.arange(len(q)), 32):
        n += np.bincount(a, minlength=len(q))
        forest.add(a, p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.tolist() == [int((x @ v >= 0.9).sum()) - 1 for v in q]
    linked = np.flatnonzero((x[0] @ x.T >= 0.9))
    assert len(set(forest.root[len(q) + linked].tolist()) | set(forest.root[:len(q)].tolist())) == 1
    assert len(forest.a) <= len(q) + len(linked) and (q[forest.a] * x[forest.p]).sum(1).min() >= 0.9
    assert peak < 300 << 20


def test_id_filter_is_exact_after_the_join(spark):
    rows = spark.createDataFrame([(i, "x") for i in range(50)] + [(None, "x"), (3, "x"), (4, "y")], "k long, v string")
    gone = spark.createDataFrame([(i,) for i in range(0, 50, 5)] + [(None,)], "k long")
    assert sorted(r["k"] or -1 for r in without(rows, gone, "k").collect()) == sorted([-1, 3, 4, *(i for i in range(50) if i % 5)])
    assert rows.where(maybe_in(gone, "k")("k")).where(F.col("k") % 5 == 0).count() == 10
    assert sorted((-1 if r["k"] is None else r["k"], r["v"]) for r in one_of_equal(rows, "k").collect()) == sorted([(-1, "x"), (4, "y"), *((i, "x") for i in range(50))])


@pytest.mark.parametrize("n", [0, 1])
def test_id_filter_of_none_or_one(spark, n):
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    assert without(rows, rows.limit(n), "k").count() == 2 - n
