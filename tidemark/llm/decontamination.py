"""Benchmark decontamination by latent semantic retrieval.

1. Every text's hashed words, stored once as two bytes a word, and their document frequencies, over all documents.
2. A randomised singular value decomposition of the TF-IDF passages of all documents and of all benchmark items, which weigh
   ``ITEM_WEIGHT`` times as much in all, so that the space is one in which items differ; nothing in it comes from a sample. Each of its
   passes is a Spark job that multiplies all passages held by a task with the current basis and back; blocks of the product
   are summed by key. Only the basis (the terms that occur x ``RANK``) comes to the driver.
3. Every document, whole, is cut into overlapping windows of several lengths and folded into the latent
   space. A window's score for an item of that length is the cosine of the window's TF-IDF vector with the item's latent
   image, over the cosine that the item itself has with it: 1 for the item alone.
4. A candidate is confirmed by the longest common subsequence of words: 75 % of the item within a stretch of
   twice its length, or half of it if the item's answer (its last words, or what follows "answer:") is there too. It is
   computed where the stretch holds enough of the item's words in any order, without which it can't be that long.

All letters are lower-cased first. Benchmark items are the fixed query set: they are compared in blocks with every window.

Defined results: null or empty texts are clean; empty items match nothing; items of fewer than
``SHORT_ITEM`` words must occur in full; every input row gives one row, also when ids repeat; rows with the same
benchmark id are separate texts of one item; an empty table on either side leaves all documents clean.
Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import Words, raw, slices, word_slices

TERMS = 1 << 16
RANK, OVERSAMPLE, ROUNDS = 48, 8, 2
PASSAGE = 64
#: Passages multiplied at once: their counts of the terms that they hold are one dense matrix in the processor's cache.
PASSAGES = 32
ITEM_WEIGHT = 20.0
BLOCK = 4096
#: Bytes of stored words a task multiplies at least; each task sends one block of the basis' size.
TASK_BYTES = 64 << 20
SLICE = 256 << 10
#: Window lengths in words; the last one grows with the longest item.
SHORTEST, GROWTH = 12, 2**0.5
SCORE = 0.15
COPIED, PARAPHRASED, ANSWER = 0.75, 0.5, 0.8
SHORT_ITEM = 8
#: An item's repeats of one term are told apart up to here; of one that it holds more often every occurrence counts.
REPEATS = 15


def terms(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.int64)


def _held_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> terms: those of its words in order, two bytes each."""
    for b in batches:
        for _, _, w in word_slices(b.column(0), SLICE):
            held = terms(w.hash).astype(np.uint16)
            yield pa.record_batch([pa.Array.from_buffers(pa.binary(), len(w.first) - 1, [None, pa.py_buffer((2 * w.first).astype(np.int32)), pa.py_buffer(held)])], names=["terms"])


def _term_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, their terms, first term of each row and the end) a few texts at a time."""
    data, at = raw(column)
    for i, j in slices(at, SLICE):
        yield i, j, np.frombuffer(data[at[i]:at[j]].tobytes(), np.uint16), (at[i:j + 1] - at[i]) // 2


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(TERMS, np.int64)
    for b in batches:
        for _, _, t, first in _term_slices(b.column(0)):
            key = np.sort(np.repeat(np.arange(len(first) - 1), np.diff(first)) * TERMS + t)
            total += np.bincount(key[np.diff(key, prepend=-1) > 0] % TERMS, minlength=TERMS)
    used = np.flatnonzero(total)
    yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["term", "n"])


def passages_of(first: np.ndarray, length: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(text, first word) of every passage of ``length`` words."""
    count = -(-np.diff(first) // length)
    of = np.repeat(np.arange(len(count)), count)
    return of, first[of] + length * (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))


def _gram_product(held):
    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """terms, weight -> blocks of A^T (A basis) for the weighted TF-IDF passages A of this task."""
        used, idf, basis = held.value
        idf = idf[used]
        basis = basis * idf[:, None]
        place = np.zeros(TERMS, np.int32)
        place[used] = np.arange(len(used), dtype=np.int32)
        total = np.zeros_like(basis)
        seen, slot = np.zeros(len(used), bool), np.zeros(len(used), np.int32)
        for b in batches:
            weights = b.column(1).to_numpy()
            for i, _, t, first in _term_slices(b.column(0)):
                of, cut = passages_of(first)
                if not len(cut):
                    continue
                t, edge = place[t], np.append(cut, first[-1])
                factor = (weights[i + of] ** 2 / np.add.reduceat(idf[t] ** 2, cut)).astype(np.float32)
                passage = np.repeat(np.arange(len(cut)), np.diff(edge))
                for lo in range(0, len(cut), PASSAGES):
                    hi = min(lo + PASSAGES, len(cut))
                    x = t[edge[lo]:edge[hi]]
                    seen[x] = True
                    kinds = np.flatnonzero(seen)
                    seen[kinds] = False
                    slot[kinds] = np.arange(len(kinds), dtype=np.int32)
                    counts = np.bincount((passage[edge[lo]:edge[hi]] - lo) * len(kinds) + slot[x], minlength=(hi - lo) * len(kinds)).reshape(hi - lo, -1).astype(np.float32)
                    total[kinds] += counts.T @ (counts @ basis[kinds] * factor[lo:hi, None])
        total *= idf[:, None]
        for k in range(0, len(total), BLOCK):
            if total[k:k + BLOCK].any():
                yield pa.record_batch([pa.array([k // BLOCK], pa.int32()), pa.array([total[k:k + BLOCK].tobytes()], pa.binary())], names=["block", "part"])
    return product


def _sum_blocks(key: tuple, parts: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in parts["part"].to_pylist())
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def latent_basis(spark: SparkSession, texts: DataFrame, documents: DataFrame, used: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Right singular vectors (terms in ``used`` x at most RANK) of the TF-IDF passages of the items' ``texts`` and of the ``documents``' terms by randomised subspace iteration."""
    width = min(RANK + OVERSAMPLE, len(used))
    items = texts.select("text").mapInArrow(_held_terms, "terms binary")
    passages = lambda rows: rows.agg(F.sum(F.ceil(F.length("terms") / (2 * PASSAGE))), F.sum(F.length("terms"))).first()
    (n, size), (asked, _) = passages(documents), passages(items)
    weight = math.sqrt(ITEM_WEIGHT * max(1, n or 0) / max(1, asked or 0))
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil((size or 0) / TASK_BYTES))
    rows = documents.select("terms", F.lit(1.0).alias("weight")).union(items.select("terms", F.lit(weight).alias("weight"))).coalesce(tasks)
    salts = min(16, math.ceil(tasks / 16))

    def multiply(basis: np.ndarray) -> np.ndarray:
        held = spark.sparkContext.broadcast((used, idf, basis.astype(np.float32)))
        blocks = (rows.mapInArrow(_gram_product(held), "block int, part binary")
                  .groupBy("block", F.pmod(F.hash("part"), F.lit(salts)).alias("_salt")).applyInArrow(_sum_blocks, "block int, part binary")
                  .transform(lambda x: x.groupBy("block").applyInArrow(_sum_blocks, "block int, part binary") if salts > 1 else x).toArrow())  # the basis, BLOCK terms a row
        held.destroy()
        out = np.zeros((len(used), width))
        for k, part in zip(blocks["block"].to_pylist(), blocks["part"].to_pylist(), strict=True):
            out[k * BLOCK:(k + 1) * BLOCK] = np.frombuffer(part, np.float32).reshape(-1, width)
        return out

    image = np.random.default_rng(11).standard_normal((len(used), width))
    for k in range(ROUNDS):
        basis = np.linalg.qr(image)[0] if k else image
        image = multiply(basis)
    # The best vectors within the last image, without another pass: G ~ image (basis^T image)^-1 image^T.
    value, vector = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    some = value > 1e-6 * max(0.0, value.max(initial=0))
    root = image @ (vector[:, some] / np.sqrt(value[some]))
    value, vector = np.linalg.eigh(root.T @ root)
    top = np.argsort(-value)[:RANK]
    top = top[value[top] > 0]
    return root @ (vector[:, top] / np.sqrt(value[top]))


def common_subsequence(item: dict[int, int], words: list[int]) -> int:
    """Length of the longest common subsequence; ``item``: for each word, the bits of its places in the item."""
    row = every = (1 << item[0]) - 1
    for w in words:
        m = item.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & every
    return item[0] - row.bit_count()


def places(words: list[int]) -> dict[int, int]:
    """For each word the bits of its places; the number of words is held under 0, which no word's hash is."""
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    out[0] = len(words)
    return out


class Items:
    """The benchmark's texts, folded into the latent space and ordered by the window length they are sought with."""

    def __init__(self, ids: list[int], texts: list[str | None], folded: np.ndarray, idf: np.ndarray):
        self.ids, self.words, self.answer, vectors = [], [], [], []
        at = 0
        for _, j, w in word_slices(pa.array(texts, pa.string())):
            for k in range(j - at):
                h = w.text(k)
                if len(h):
                    raw = [w.data[s:e].tobytes() for s, e in zip(w.start[w.first[k]:w.first[k + 1]], w.end[w.first[k]:w.first[k + 1]], strict=True)]
                    mark = next((n + 1 for n in range(len(raw) - 1, -1, -1) if raw[n] in (b"answer:", b"answer", b"a:")), 0)
                    tail = mark if 0 < mark < len(raw) else len(raw) - max(3, len(raw) // 5)
                    self.ids.append(ids[at + k])
                    self.words.append(h.tolist())
                    self.answer.append(h[max(0, tail):].tolist())
                    kinds, n = np.unique(terms(h), return_counts=True)
                    image = n @ folded[kinds].astype(np.float64)
                    vectors.append(image * np.linalg.norm(n * idf[kinds]) / max(float(image @ image), 1e-9))
            at = j
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.vectors = np.array(vectors, np.float32).reshape(-1, folded.shape[1])
        self.masks, self.answers = [places(w) for w in self.words], [places(w) for w in self.answer]
        own = [np.unique(terms(np.array(w, np.uint64)), return_counts=True) for w in self.words]
        self.used = np.unique(np.concatenate([np.zeros(0, np.int64), *(t for t, _ in own)]))
        self.folded = np.ascontiguousarray(folded.T)
        self.slot = np.full(TERMS, -1, np.int32)
        self.slot[self.used] = np.arange(len(self.used))
        #: How often each item holds each term.
        self.held = np.zeros((len(self.words), len(self.used)), np.int8)
        for k, (t, c) in enumerate(own):
            self.held[k, self.slot[t]] = np.minimum(c, REPEATS + 1)
        #: Fewer words in common than this, and the item isn't leaked.
        self.least = np.array([len(w) if len(w) < SHORT_ITEM else PARAPHRASED * len(w) for w in self.words])
        self.by_length: dict[int, list[int]] = {}
        for k, w in enumerate(self.words):
            self.by_length.setdefault(window_length(len(w)), []).append(k)

    def leaked(self, k: int, seen: list[int]) -> float:
        """Share of item k that these words hold in order if they leak it, else 0."""
        n = len(self.words[k])
        share = common_subsequence(self.masks[k], seen) / n
        if n < SHORT_ITEM:
            return share if share == 1 else 0.0
        if share >= COPIED:
            return share
        answer = self.answers[k]
        return share if share >= PARAPHRASED and common_subsequence(answer, seen) >= ANSWER * answer[0] else 0.0


def window_length(n: int) -> int:
    """The window length with which an item of n words is sought: the next of a geometric series."""
    return SHORTEST if n <= SHORTEST else math.ceil(SHORTEST * GROWTH ** math.ceil(math.log(n / SHORTEST, GROWTH)))


def _windows(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, last word + 1) of the windows of every text, a quarter of a window apart; the last one ends the text."""
    step, n = max(1, length // 4), np.diff(first)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - length) // step)), 0)
    of = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(place * step, np.maximum(0, n[of] - length)) + first[of]
    return of, start, np.minimum(start + length, first[of + 1])


def _earlier(slot: np.ndarray) -> np.ndarray:
    """Row c: for each place, that of the c-th last occurrence of its term before it, -1 if there is none; row 0: after all places."""
    order = np.argsort(slot, kind="stable")
    previous = np.full(len(slot) + 1, -1, np.int32)
    same = slot[order[1:]] == slot[order[:-1]]
    previous[order[1:][same]] = order[:-1][same]
    out = np.full((REPEATS + 2, len(slot)), -1, np.int32)
    out[0], at = len(slot), np.arange(len(slot))
    for c in range(1, REPEATS + 1):
        out[c] = at = previous[at]  # previous[-1] is -1
    return out


def _stretch(w: Words, text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, last word + 1) around each window a..b in which an item of ``size`` words is confirmed."""
    slack = np.minimum(length // 2, np.maximum(0, 2 * size - (b - a)) // 2)
    return np.maximum(w.first[text], a - slack), np.minimum(w.first[text + 1], b + slack)


def _in_common(items: Items, slot: np.ndarray, earlier: np.ndarray, k: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many terms of item k, counted with repeats, each stretch a..b holds: no common subsequence is longer."""
    out, size = np.zeros(len(k), np.int64), b - a
    for lo in range(0, len(k), 8192):
        n = size[lo:lo + 8192]
        edge = np.concatenate([[0], np.cumsum(n)])
        which = np.repeat(np.arange(lo, lo + len(n)), n)
        at = np.arange(edge[-1]) + (a[lo:lo + 8192] - edge[:-1])[which - lo]
        counts = np.concatenate([[0], np.cumsum(earlier[items.held[k[which], slot[at]], at] < a[which])])
        out[lo:lo + 8192] = counts[edge[1:]] - counts[edge[:-1]]
    return out


def matches(w: Words, items: Items, idf: np.ndarray) -> list[tuple[int, int, float]]:
    """(text, item number, share) of every leak in these texts, each pair once with its largest share."""
    if not len(w.hash) or not items.ids:
        return []
    t = terms(w.hash)
    slot = items.slot[t]
    some = slot >= 0
    before = np.concatenate([[0], np.cumsum(some)])  # of the words that items hold
    slot = slot[some]
    sums = np.zeros((len(items.folded), len(t) + 1))
    np.cumsum(np.take(items.folded, t, 1), 1, out=sums[:, 1:])
    squares = np.concatenate([[0], np.cumsum(idf[t].astype(np.float64) ** 2)])
    earlier = _earlier(slot)
    best: dict[tuple[int, int], float] = {}
    for length, ks in items.by_length.items():
        of, start, end = _windows(w.first, length)
        own, number = items.vectors[ks], np.array(ks)
        for lo in range(0, len(of), 16_384):
            a, b = start[lo:lo + 16_384], end[lo:lo + 16_384]
            v = (np.take(sums, b, 1) - np.take(sums, a, 1)).astype(np.float32)
            c, r = np.nonzero(own @ v >= SCORE * np.sqrt(squares[b] - squares[a]))
            text, k = of[lo + r], number[c]
            a, b = _stretch(w, text, a[r], b[r], length, items.sizes[k])
            for i in np.flatnonzero(_in_common(items, slot, earlier, k, before[a], before[b]) >= items.least[k]).tolist():
                pair = int(text[i]), int(k[i])
                if best.get(pair, 0) < 1:
                    share = items.leaked(pair[1], w.hash[a[i]:b[i]].tolist())
                    if share > best.get(pair, 0):
                        best[pair] = share
    return [(t, k, s) for (t, k), s in best.items()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, leaked, item_ids (sorted), share (of the best match) of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col).cast("string")).alias("text"))
    documents = Scratch(spark, "decontamination").save(rows.select("text").mapInArrow(_held_terms, "terms binary"), "terms")
    frequency = documents.mapInArrow(_document_frequency, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # at most TERMS rows
    n_docs = rows.count()
    idf = np.full(TERMS, math.log(n_docs + 1) + 1)
    idf[frequency["term"].to_numpy()] = np.log((n_docs + 1) / (frequency["n"].to_numpy() + 1)) + 0.01
    idf = np.maximum(idf, 0.01).astype(np.float32)

    queries = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.lower(F.col(item_text_col).cast("string")).alias("text")).where("item_id is not null")
    asked = [(r["item_id"], r["text"]) for r in queries.orderBy("item_id", "text").toLocalIterator()]  # the fixed query set
    own = np.unique(np.concatenate([np.zeros(0, np.int64), *(terms(w.hash) for _, _, w in word_slices(pa.array([a[1] for a in asked], pa.string())))]))
    used = np.union1d(own, frequency["term"].to_numpy()) if len(own) else own  # without items there is nothing to seek
    basis = latent_basis(spark, queries.where("text is not null").select("text"), documents, used, idf) if len(used) else np.zeros((0, RANK))
    held = spark.sparkContext.broadcast((used, (basis * idf[used][:, None]).astype(np.float32), idf, [a[0] for a in asked], [a[1] for a in asked]))
    kind = dict(rows.dtypes)["doc_id"]

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, images, idf, ids, texts = held.value
        folded = np.zeros((TERMS, images.shape[1]), np.float32)
        folded[used] = images
        items = Items(ids, texts, folded, idf)
        for b in batches:
            for i, j, w in word_slices(b.column(1), SLICE):
                found: list[set[int]] = [set() for _ in range(j - i)]
                share = np.zeros(j - i)
                for t, k, x in matches(w, items, idf):
                    found[t].add(items.ids[k])
                    share[t] = max(share[t], x)
                yield pa.record_batch([b.column(0).slice(i, j - i), pa.array([bool(f) for f in found]), pa.array([sorted(f) for f in found], pa.list_(pa.int64())), pa.array(share)],
                                      names=["doc_id", "leaked", "item_ids", "share"])

    return rows.mapInArrow(seek, f"doc_id {kind}, leaked boolean, item_ids array<long>, share double")
