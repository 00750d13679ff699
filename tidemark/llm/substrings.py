"""Substring deduplication: paragraphs found by MinHash banding, verified on the words, cut link by link.

A passage may sit anywhere in a line, so paragraphs are cut by content: every word pair
whose hash is the least within ``RADIUS`` words is an anchor, and the ``WIDTH`` words
around it are a paragraph. Two texts that share a passage share its anchors.

1. Each paragraph gets ``BANDS`` keys of ``ROWS`` MinHash minima over its five-word shingles. Paragraphs
   of one slice of texts with the same key travel as one row, so that a key that a
   third of all texts share doesn't become a hot group.
2. Per key, all members are paired with the first one (a star). Both texts are joined to
   the pairs, and the common stretch is followed from each pair to both sides along equal
   words, bridging small edits. Stretches of ``MIN_WORDS`` words or more that agree
   in 75 % of their words are links. Where the first one doesn't confirm all members, the members share
   less with it than they may share with each other. Their ``MIN_WORDS``-word windows around the paragraph, but those
   within a stretch found, are compared by all their words, which finds every exact repeat, and by their first and last
   words, which finds copies with edits between them. A line of less than ``MIN_WORDS`` words is in no such window alone,
   so a frequent one makes no pairs.
3. Every link points to a document with a smaller id, and its stretch goes from the larger one only. So a word
   goes only where a smaller document has it, and the smallest that has it keeps it; only the few words by which a bridged
   edit differs go without being held elsewhere.

Defined results: null text stays null, an empty or short text stays as it is; rows with a
null id are kept as they are; repeated rows with the same id are one document, and all
its rows are cut alike; passages that repeat only within one document stay; white space before a
removed stretch goes with it; all input columns are kept; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ids import maybe_in
from .scratch import Scratch
from .words import SHINGLE, Words, mix, word_slices

RADIUS = 7
WIDTH = 25
BANDS, ROWS = 3, 2
MIN_WORDS = 50
BRIDGE = 8

_rng = np.random.default_rng(4_242)
_PLACE = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SEED = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)
_KEY = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)
_BASE = 0xD1342543DE82EF95
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def recall(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that two paragraphs of this similarity share a key."""
    return 1 - (1 - similarity**rows) ** bands


def anchors(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, word) of every anchor whose paragraph lies within its text; ties go to the left."""
    n = len(h)
    if n < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    rank = mix(h + np.append(h[1:], np.uint64(0)) * _PAIR)
    good = np.ones(n, bool)
    for d in range(1, RADIUS + 1):
        other = of[d:] != of[:-d]
        good[d:] &= (rank[d:] < rank[:-d]) | other
        good[:-d] &= (rank[:-d] <= rank[d:]) | other
    at = np.flatnonzero(good)
    t = of[at]
    inside = (at - WIDTH // 2 >= first[t]) & (at + WIDTH - WIDTH // 2 <= first[t + 1])
    return t[inside], at[inside]


def band_keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One key per paragraph and band."""
    part = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        part += h[j:j + len(part)] * _PLACE[j]
    part = mix(part)
    lo, count = at - WIDTH // 2, WIDTH - SHINGLE + 1
    keys = np.empty((len(at), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(at), _KEY[b])
        for r in range(ROWS):
            x = mix(part ^ _SEED[b * ROWS + r])
            least = x[lo]
            for k in range(1, count):
                np.minimum(least, x[lo + k], out=least)
            key = mix(key ^ least)
        keys[:, b] = key
    return keys


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> key, doc, pos, others: one row per key and slice, its first member apart from the others."""
    for batch in batches:
        ids_all = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j, w in word_slices(batch.column(1)):
            t, at = anchors(w.hash, w.first)
            if not len(t):
                continue
            key = band_keys(w.hash, at).ravel()
            doc = np.repeat(ids_all[i:j][t], BANDS)
            pos = np.repeat(at - w.first[t], BANDS)
            order = np.lexsort((pos, doc, key))
            key, doc, pos = key[order], doc[order], pos[order]
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(new, len(key)))
            both = np.stack([doc, pos], 1).astype("<i8")
            others = np.full(len(new), None, object)
            for k in np.flatnonzero(size > 1):
                others[k] = both[new[k] + 1:new[k] + size[k]].tobytes()
            yield pa.record_batch([pa.array(key[new].view(np.int64)), pa.array(doc[new]), pa.array(pos[new].astype(np.int32)),
                                   pa.array(others, pa.binary())], names=["key", "doc", "pos", "others"])


def _star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, pos, others, rdoc, rpos -> (doc, pos, rdoc, rpos) for every member in another text than the first."""
    for b in batches:
        if not b.num_rows:
            continue
        doc, pos, rdoc, rpos = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1, 3, 4))
        held = b.column(2).to_pylist()
        n = np.array([0 if x is None else len(x) // 16 for x in held])
        more = np.frombuffer(b"".join(x for x in held if x), "<i8").reshape(-1, 2)
        out = [np.concatenate(x) for x in ((doc, more[:, 0]), (pos, more[:, 1]), (rdoc, np.repeat(rdoc, n)), (rpos, np.repeat(rpos, n)))]
        keep = out[0] != out[2]
        yield pa.record_batch([pa.array(x[keep]) for x in out], names=["doc", "pos", "rdoc", "rpos"])


def stretches(a: np.ndarray, b: np.ndarray, seeds: np.ndarray) -> list[tuple[int, int, int, int, list[int]]]:
    """Common stretches (start, end in a; start, end in b; seeds within) around (place in a, place in b)."""
    runs: dict[tuple[int, int], tuple[int, int, list[int]]] = {}
    for k, (p, q) in enumerate(seeds.tolist()):
        if p >= len(a) or q >= len(b):
            continue
        lo, hi = min(p, q, WIDTH // 2), min(len(a) - p, len(b) - q, WIDTH - WIDTH // 2)
        same = np.flatnonzero(a[p - lo:p + hi] == b[q - lo:q + hi])
        if not len(same):
            continue
        m = p - lo + int(same[np.abs(same - lo).argmin()])  # the equal word nearest to the anchor
        d = p - q
        found = next((x for x, r in runs.items() if x[0] == d and r[0] <= m < r[1]), None)
        if found:
            runs[found][2].append(k)
            continue
        left = min(m, m - d)
        back = a[m - left:m + 1][::-1] != b[m - d - left:m - d + 1][::-1]
        s = m + 1 - (int(back.argmax()) if back.any() else left + 1)
        right = min(len(a) - m, len(b) - (m - d))
        ahead = a[m:m + right] != b[m - d:m - d + right]
        e = m + (int(ahead.argmax()) if ahead.any() else right)
        if (d, s) in runs:
            runs[d, s][2].append(k)
        else:
            runs[d, s] = (s, e, [k])
    out, chain = [], None
    for (d, _), (s, e, ks) in sorted(runs.items(), key=lambda x: (x[1][0], x[0][0])):
        if chain and s - chain[1] <= BRIDGE and abs(d - chain[4]) <= BRIDGE and e > chain[1]:
            chain = (chain[0], e, chain[2], e - d, d, chain[5] + e - max(s, chain[1]), chain[6] + ks)
        else:
            out.append(chain)
            chain = (s, e, s - d, e - d, d, e - s, list(ks))
    return [(c[0], c[1], c[2], c[3], c[6]) for c in [*out, chain]
            if c and c[1] - c[0] >= MIN_WORDS and 4 * c[5] >= 3 * max(c[1] - c[0], c[3] - c[2])]


def _hashes(texts: pa.Array) -> list[np.ndarray]:
    return [w.text(k).copy() for i, j, w in word_slices(texts) for k in range(j - i)]


_LINK = ["doc", "pos", "s", "e", "rdoc", "rpos"]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, rdoc, at, text, rtext -> one row per seed; s is null where no stretch confirms it."""
    held: OrderedDict[int, np.ndarray] = OrderedDict()
    for b in batches:
        for lo in range(0, b.num_rows, 128):
            part = b.slice(lo, 128)
            docs, rdocs = part.column(0).to_pylist(), part.column(1).to_pylist()
            new = {r: k for k, r in enumerate(rdocs) if r not in held}
            if new:
                held.update(zip(new, _hashes(part.column(4).take(pa.array(list(new.values()), pa.int64()))), strict=True))
            rows: list[tuple] = []
            for doc, rdoc, at, a in zip(docs, rdocs, part.column(2).to_pylist(), _hashes(part.column(3)), strict=True):
                seeds = np.frombuffer(at, "<i8").reshape(-1, 2)
                found: dict[int, tuple] = {}
                for s, e, _, _, ks in stretches(a, held[rdoc], seeds):
                    found.update((k, (s, e)) for k in ks)
                rows += [(doc, p, *found.get(k, (None, None)), rdoc, q) for k, (p, q) in enumerate(seeds.tolist())]
            while len(held) > 64:
                held.popitem(last=False)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(_LINK))], names=_LINK)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from every place on."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    up, down = (np.multiply.accumulate(np.append(np.uint64(1), np.full(len(h) - 1, b, np.uint64))) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    total = np.append(np.uint64(0), np.cumsum(h * up, dtype=np.uint64))
    return mix((total[size:] - total[:-size]) * down[:len(h) - size + 1])


def _lists(values: np.ndarray, held: np.ndarray) -> pa.Array:
    """The values that are held, as one list a row."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(held.sum(1))), pa.int32()), pa.array(values[held].view(np.int64)))


_WINDOWS = "doc long, before long, after long, start array<long>, exact array<long>, ends array<long>"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, at, spans, text -> the keys of the windows around each paragraph that lie in none of the spans.

    ``before`` and ``after`` are keys of the paragraph with half of a window's other words on one side: equal windows have one of them equal.
    """
    spare, back, ahead = MIN_WORDS - WIDTH, WIDTH // 2, WIDTH - WIDTH // 2
    half = (spare + 1) // 2
    for b in batches:
        docs, ats, spans = (b.column(c).to_pylist() for c in range(3))
        for i, j, w in word_slices(b.column(3)):
            for k in range(i, j):
                h, at = w.text(k - i), np.array(ats[k], np.int64)
                n = len(h)
                if n < MIN_WORDS:
                    continue
                first = at[:, None] - back - np.arange(spare + 1)
                held = (first >= 0) & (first + MIN_WORDS <= n)
                for x in spans[k]:
                    held &= (first < x["s"]) | (first + MIN_WORDS > x["e"])
                some = held.any(1)
                if not some.any():
                    continue
                at, first, held = at[some], np.clip(first[some], 0, n - MIN_WORDS), held[some]
                whole, part, five = window_hashes(h, MIN_WORDS), window_hashes(h, WIDTH + half), window_hashes(h, SHINGLE)
                ends = mix(five[first] + five[first + MIN_WORDS - SHINGLE] * _PAIR)
                sides = []
                for lo in (at - back - half, at - back):
                    ok = (lo >= 0) & (lo < len(part))
                    sides.append(pa.array(part[np.clip(lo, 0, len(part) - 1)].view(np.int64), mask=~ok))
                yield pa.record_batch([pa.array(np.full(len(at), docs[k], np.int64)), *sides, _lists(first, held), _lists(whole[first], held), _lists(ends, held)],
                                      names=["doc", "before", "after", "start", "exact", "ends"])


def among_members(first: DataFrame, texts: DataFrame, s: Scratch) -> DataFrame:
    """Seeds (doc, pos, rdoc, rpos) between members of the keys whose first member didn't confirm all of them."""
    head = first.withColumn("r", F.xxhash64("rdoc", "rpos"))
    mixed = maybe_in(head.where("s is null").select("r"), "r")
    members = s.save(head.where(mixed("r")).groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("at"),
                                                               F.collect_set(F.when(F.col("s").isNotNull(), F.struct("s", "e"))).alias("spans")), "members")
    texts = texts.where(maybe_in(members.select("doc"), "doc")("doc_id")).select(F.col("doc_id").alias("doc"), "text")
    windows = s.save(members.join(texts.hint("merge"), "doc").select("doc", "at", "spans", "text").mapInArrow(_windows, _WINDOWS), "windows")
    several = lambda keys: maybe_in(keys.groupBy("x").count().where("count > 1").select("x"), "x")
    side = several(windows.select(F.explode(F.array("before", "after")).alias("x")).where("x is not null"))
    keyed = lambda rows, key: rows.select("doc", F.explode(F.arrays_zip("start", F.col(key).alias("x"))).alias("w")).select("doc", F.col("w.start").alias("pos"), "w.x")
    keys = keyed(windows.where(side("before") | side("after")), "exact").union(keyed(windows, "ends"))
    keys = s.save(keys.where(several(keys.select("x"))("x")).distinct(), "keys")
    heads = keys.groupBy("x").agg(F.min(F.struct("doc", "pos")).alias("r"), F.max("doc").alias("last")).where("last <> r.doc")
    pairs = heads.join(keys, "x").where("doc <> r.doc").select("doc", "pos", F.col("r.doc").alias("rdoc"), F.col("r.pos").alias("rpos")).distinct()
    # A stretch is followed from a seed up to an edit, so there are seeds on either side of one.
    step = F.explode(F.array(*(F.lit(x).cast("long") for x in range(0, MIN_WORDS, SHINGLE)))).alias("x")
    return pairs.select("doc", "pos", "rdoc", "rpos", step).select("doc", (F.col("pos") + F.col("x")).alias("pos"), "rdoc", (F.col("rpos") + F.col("x")).alias("rpos"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.record_batch([b.column(0), b.column(1), pa.array(
            [np.array([(x["pos"], x["rpos"]) for x in v], "<i8").tobytes() for v in b.column(2).to_pylist()], pa.binary())], names=["doc", "rdoc", "at"])


def verified(seeds: DataFrame, texts: DataFrame, s: Scratch) -> tuple[DataFrame, DataFrame]:
    """Seeds (doc, pos, rdoc, rpos) with their stretches, or nulls; and the texts used."""
    pairs = (seeds.groupBy("doc", "rdoc").agg(F.sort_array(F.collect_set(F.struct("pos", "rpos"))).alias("at"))
             .mapInArrow(_pack, "doc long, rdoc long, at binary"))
    pairs = s.save(pairs, "pairs")
    needed = maybe_in(pairs.select("doc").union(pairs.select("rdoc")), "doc")
    texts = s.save(texts.where(needed("doc_id")).dropDuplicates(["doc_id"]), "texts")
    both = (pairs.join(texts.select(F.col("doc_id").alias("doc"), "text").hint("merge"), "doc")
            .join(texts.select(F.col("doc_id").alias("rdoc"), F.col("text").alias("rtext")).hint("merge"), "rdoc"))
    return s.save(both.select("doc", "rdoc", "at", "text", "rtext").mapInArrow(_verify, ", ".join(f"{c} long" for c in _LINK)), "verified"), texts


def repeated_spans(docs: DataFrame, s: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: the word ranges of each document to remove, as one array."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null")
    rows = texts.mapInArrow(_paragraphs, "key long, doc long, pos int, others binary")
    same = Window.partitionBy("key")
    starred = (rows.withColumn("r", F.min(F.struct("doc", "pos")).over(same)).withColumn("n", F.count("*").over(same))
               .where("n > 1 or others is not null")
               .select("doc", "pos", "others", F.col("r.doc").alias("rdoc"), F.col("r.pos").alias("rpos"))
               .mapInArrow(_star, "doc long, pos long, rdoc long, rpos long"))
    first, texts = verified(starred, texts, s)
    second, _ = verified(among_members(first, texts, s), texts, s)
    links = first.union(second).where("s is not null")
    return links.select(F.col("doc").alias("doc_id"), F.struct("s", "e").alias("x")).groupBy("doc_id").agg(F.sort_array(F.collect_set("x")).alias("spans"))


def cut(text: str | None, spans: list[tuple[int, int]], w: Words, k: int) -> tuple[str | None, int]:
    """The text without these word ranges, and the number of words that went."""
    if text is None or not spans:
        return text, 0
    start, end = w.start[w.first[k]:w.first[k + 1]] - w.text_at[k], w.end[w.first[k]:w.first[k + 1]] - w.text_at[k]
    data, out, at, gone, word = text.encode(), [], 0, 0, 0
    for s, e in sorted(spans):
        s, e = max(s, word), min(e, len(start))
        if s >= e:
            continue
        out.append(data[at:end[s - 1] if s else 0])
        at, word, gone = int(end[e - 1]), e, gone + e - s
    return b"".join([*out, data[at:]]).decode(), gone


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from the text, and n_removed_words (long)."""
    s = Scratch(docs.sparkSession, "substrings")
    spans = s.save(repeated_spans(docs, s, id_col, text_col), "spans")
    columns = docs.columns
    i, t = columns.index(id_col), columns.index(text_col)
    flat = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)])
    maybe = maybe_in(spans, "doc_id")(f"c{i}")
    joined = flat.where(maybe).join(spans.withColumnRenamed("doc_id", "_id"), F.col(f"c{i}").cast("long") == F.col("_id"), "left").drop("_id")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans_of, texts = b.column(b.num_columns - 1).to_pylist(), b.column(t)
            out, gone = [], []
            for lo, hi, w in word_slices(texts):
                for k in range(lo, hi):
                    if not spans_of[k]:
                        out.append(texts[k].as_py())
                        gone.append(0)
                        continue
                    x, n = cut(texts[k].as_py(), [(v["s"], v["e"]) for v in spans_of[k]], w, k - lo)
                    out.append(x)
                    gone.append(n)
            yield pa.record_batch([pa.array(out, pa.string()) if c == t else b.column(c) for c in range(len(columns))] + [pa.array(gone, pa.int64())],
                                  names=[*b.schema.names[:-1], "n_removed_words"])

    schema = "".join(f"c{k} {docs.schema[k].dataType.simpleString()}, " for k in range(len(columns)))
    done = joined.mapInArrow(apply, schema + "n_removed_words long").union(flat.where(~maybe).withColumn("n_removed_words", F.lit(0).cast("long")))
    return done.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], "n_removed_words")
