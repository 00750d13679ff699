"""Token counts against the tokenizer library, and their defined edge cases."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm.queries import QUERIES
from tidemark.llm.token_counts import FREQUENT, PROBES, SLOTS, Table, count_tokens, library, token_slices

FILE = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
PARTS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "''", " ", "  ", "\n", "\t", " ", " ", "　", "\x85", "\x1c", "​", "\r\n",
         "a", "B", "é", "ß", "1", "٣", "²", "ⅷ", "!", "?", "-", "日本", "́", "😀", "re", "lls", "don't", "we've", "'S", "l", "v", "e"]


def by_library(texts):
    t = Tokenizer.from_file(FILE)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_pre_tokens_are_those_of_the_library():
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(5000)]
    lib = library(FILE)
    classes, split, seen = lib.classes(), lib.tokenizer.pre_tokenizer.pre_tokenize_str, 0
    for i, j, data, begin, end, first in token_slices(pa.array(texts), classes):
        for k in range(i, j):
            at = slice(first[k - i], first[k - i + 1])
            assert [data[a:b].tobytes().decode() for a, b in zip(begin[at], end[at], strict=True)] == [texts[k][a:b] for _, (a, b) in split(texts[k])], texts[k]
            seen += 1
    assert seen == len(texts)


def test_the_table_finds_what_it_holds_and_nothing_else():
    h = np.unique(np.random.default_rng(1).integers(1, 2**63, FREQUENT + 9, dtype=np.uint64))[:FREQUENT]
    n = np.arange(1, len(h) + 1) % 65_000 + 1
    table = Table(h, n)
    got = table.find(h)
    assert ((got == n) | (got == 0)).all() and (got == 0).mean() < 0.01 and PROBES > 1 and len(table.keys) == SLOTS
    assert (table.find(h + np.uint64(1 << 40)) == 0).all()


def test_counts_equal_the_library_on_whole_tables(spark):
    for sf in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
        want = dict(zip((r.doc_id for r in docs), by_library([r.text for r in docs]), strict=True))
        got = QUERIES["op13_token_counts"](spark, f"/root/testdata/{sf}")
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        rows = got.collect()
        assert {r.doc_id: r.n_tokens for r in rows} == want and len(rows) == len(docs)
        assert {r.doc_id: r.n_bytes for r in rows} == {r.doc_id: len((r.text or "").encode()) for r in docs}
        assert all(r.over_limit == (r.n_tokens > 512) for r in rows)


def test_edge_cases(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh é 1'\n") for _ in range(400_000))
    rows = [(1, None), (2, ""), (3, " "), (4, "\n \n"), (5, "one<|endoftext|>two <|endoftext|>"), (6, "<|endoftext|"), (7, long), (8, "same"), (8, "same"), (8, "other 'em"),
            (None, "no id"), (9, "x" * 100_000), (10, "\x00퟿\U0010ffff"), (11, "a" * 512), (12, "it's we'll 'tis 'Re don't'"), (13, " " * 5000 + "z")]
    docs = spark.createDataFrame([(i, t, 5, "clash") for i, t in rows], "doc_id long, text string, n_tokens int, h string")
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, FILE).collect())
    want = [(i or -1, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, by_library([t for _, t in rows]), strict=True)]
    assert got == sorted(want)
    assert [r.n_tokens for r in count_tokens(docs.where("doc_id = 5"), FILE, limit=3).collect()] == by_library(["one<|endoftext|>two <|endoftext|>"])
    assert count_tokens(docs.where("false"), FILE).collect() == []


def test_the_table_never_changes_a_count(spark, monkeypatch):
    from tidemark.llm import token_counts

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    usual = sorted(map(tuple, count_tokens(docs, FILE).collect()))
    monkeypatch.setattr(token_counts, "SAMPLE_DOCS", 0)  # an empty sample: every pre-token is a miss
    assert sorted(map(tuple, count_tokens(docs, FILE).collect())) == usual


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'6162FF6364' AS STRING) AS text")
    row = count_tokens(docs, FILE).collect()[0]
    assert row.n_bytes == 5 and row.n_tokens == by_library(["ab�cd"])[0]


def test_other_tokenizer_files_are_an_error(spark):
    with pytest.raises(ValueError):
        count_tokens(spark.createDataFrame([(1, "a")], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"))
