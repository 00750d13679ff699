"""The pipeline's stages on the smallest documents, held against plain rules."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import decontamination
from tidemark.llm.words import word_slices

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, kept, SMALL).write.parquet(f"file://{tmp_path}/{name}")
        kept = spark.read.parquet(f"file://{tmp_path}/{name}")
        assert kept.columns == columns and kept.dtypes == docs.dtypes
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    items = [" ".join(WORD.findall(r["text"].lower())) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert left and set(left) <= set(rows)
    assert not [d for d, t in left.items() if any(i in " ".join(WORD.findall(t.lower())) for i in items)]
    assert len({" ".join(WORD.findall(t.lower())) for t in left.values()}) == len(left)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL).collect()
    assert {r["doc_id"] for r in packed} == set(left)


def test_stages_on_no_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_a_document_of_which_white_space_is_left_goes(spark):
    passage = " ".join(f"word{i * 7919 % 4001}" for i in range(80))
    rows = [(1, "begin " + passage, "en", "a"), (2, passage + "\n", "en", "a"), (3, "\n\t", "en", "a"), (4, passage + "\n kept", "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    left = {r.doc_id: r.text for r in corpus_pipeline.substring_dedup(spark, docs, "").collect()}
    assert set(left) == {1, 3, 4} and left[4].strip() == "kept"   # what had no words before stays as it was


def test_leaks_are_sought_with_all_items_and_counts_of_all_documents(spark, tmp_path, monkeypatch):
    rng, size = random.Random(2), 5000
    say = lambda n: " ".join(f"word{rng.randrange(2000)}" for _ in range(n))
    items = {k: say(20) for k in range(60)}
    texts = {**{i: say(12) for i in range(size)}, **{size + k: say(5) + " " + t for k, t in items.items()}}
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    seen, plain = {}, decontamination.latent_basis

    def noted(spark, fitted, *rest):
        seen["fitted"], seen["idf"] = [r["text"] for r in fitted.select("text").collect()], rest[-1]
        return plain(spark, fitted, *rest)

    monkeypatch.setattr(decontamination, "latent_basis", noted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    left = {r["doc_id"] for r in corpus_pipeline.benchmark_decontamination(spark, docs, f"file://{tmp_path}").collect()}
    assert left == set(range(size))
    assert sorted(seen["fitted"]) == sorted(items.values())  # no document, and every item once
    held = Counter(t for _, _, w in word_slices(pa.array(texts.values(), pa.string())) for k in range(len(w.first) - 1) for t in set(decontamination.terms(w.text(k)).tolist()))
    want = [np.log((len(texts) + 1) / (held[t] + 1)) + 0.01 for t in sorted(held)]
    np.testing.assert_allclose(seen["idf"][sorted(held)], want, rtol=1e-6)


def test_the_latent_space_is_that_of_all_documents_and_items(spark):
    rng = random.Random(4)
    say = lambda n, kinds: " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))
    items, texts = [say(30, 60) for _ in range(8)], [say(rng.randrange(1, 300), 90) for _ in range(150)] + [None, ""]
    frame = lambda x: spark.createDataFrame([(t,) for t in x], "text string")
    idf = np.linspace(0.5, 3, decontamination.TERMS).astype(np.float32)
    used = np.unique(np.concatenate([decontamination.terms(w.hash) for _, _, w in word_slices(pa.array(items + texts, pa.string()))]))
    documents = frame(texts).mapInArrow(decontamination._held_terms, "terms binary")
    got = decontamination.latent_basis(spark, frame(items), documents, used, idf)

    def passages(texts):
        for _, _, w in word_slices(pa.array(texts, pa.string())):
            t = decontamination.terms(w.hash)
            for of, lo in zip(*decontamination.passages_of(w.first), strict=True):
                row = np.bincount(t[lo:min(lo + decontamination.PASSAGE, w.first[of + 1])], minlength=decontamination.TERMS)[used] * idf[used]
                yield row / np.sqrt((row * idf[used]).sum())

    docs, asked = np.array(list(passages(texts))), np.array(list(passages(items)))
    gram = docs.T @ docs + decontamination.ITEM_WEIGHT * len(docs) / len(asked) * (asked.T @ asked)
    value, vector = np.linalg.eigh(gram)
    first = vector[:, np.argsort(-value)[:8]]
    np.testing.assert_allclose(np.linalg.norm(got.T @ first, axis=0), 1, atol=2e-2)   # the leading directions lie in the space
    assert np.allclose(got.T @ got, np.eye(got.shape[1]), atol=1e-4)


def test_the_share_is_that_of_the_best_match(spark):
    item = " ".join(f"word{i}" for i in range(40))
    text = " ".join(["word0x", *item.split()[1:]]) + " " + " ".join(f"other{i}" for i in range(200)) + " " + item
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = decontamination.decontaminate(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r["leaked"], r["item_ids"], r["share"]) for r in got] == [(True, [7], 1.0)]
