"""Log-likelihood of texts under a subword lattice.

The pieces of an existing subword vocabulary span a lattice over the bytes of every
word (a word starts with a space; single bytes are pieces too, so every word has a
path). All segmentations count: a forward recursion in log space sums them.
Piece weights start from the vocabulary's own order and are re-estimated from all
training words by expectation-maximisation over the same lattice, in every round, once
per training group (every value of ``group_col``). A word of the training texts is one
more arc from its start to its end, weighted by its count; the pieces share the mass of
the arcs seen for the first time (Witten-Bell: one for each distinct word).
A text's probability is the sum over groups of the group's share times the probability
of its words and the end under the group's weights. The score uses the text alone.

Training counts are one ``groupBy`` over the words of all texts, where those of held-out texts count
zero times. Every distinct word is scored once. The words counted most often (at most ``HEAVY``, fewer if there are more
than ``GROUPS`` groups, chosen by a count threshold) are broadcast with their scores, which bounds the broadcast; a join brings
all other words' scores to the texts that hold them.

Defined results: a null or empty text is the end token alone; a null id counts as a
training row; every input row is scored, also when ids repeat; an empty table gives an
empty result; without training rows all weights stay as in the vocabulary. Only the id,
text and group columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import SLICE_BYTES, Words, mix, raw, word_slices

HEAVY = 1 << 18
#: Words whose arcs are held at once: a few MB, which stay in the processor's cache.
WORDS = 2048
#: Up to here all groups' figures go through a task at full width; with more of them fewer words at once, and fewer broadcast.
GROUPS = 6
ROUNDS = 3
SMOOTHING = 0.1
FOLDS, HELD_OUT = 7, 2
#: Zipf-like start: weight 1 / (place in the vocabulary + this).
START = 50

_BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(path: str) -> list[bytes]:
    """The vocabulary's pieces in its order: those a lower-case word can hold, and after them the 256 bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    order = sorted((k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))),
                   key=lambda k: (-model.get_score(k), k))
    pieces = [model.id_to_piece(k).replace("▁", " ") for k in order]
    return [p.encode() for p in pieces if p and " " not in p[1:] and not any("A" <= c <= "Z" for c in p)]


class Lattice:
    """``weight``: natural logarithms, one row per piece and then per byte, one column per group."""

    def __init__(self, pieces: list[bytes], weight: np.ndarray):
        self.weight, self.share, self.n = weight, np.exp(weight), len(pieces)
        by_size: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            by_size.setdefault(len(p), []).append(k)
        self.tables = {}
        for size, ks in sorted(by_size.items()):
            data = np.frombuffer(b"".join(pieces[k] for k in ks), np.uint8).reshape(-1, size)
            h = np.zeros(len(ks), np.uint64)
            for j in range(size):
                h = h * _BASE + data[:, j].astype(np.uint64) + np.uint64(1)
            h, first = np.unique(h, return_index=True)
            self.tables[size] = h, np.array(ks)[first]

    def arcs(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """(word, from, to, piece) of every piece that occurs in the words at data[start:end]; places count from the word's space."""
        size = end - start + 1
        at = np.cumsum(size) - size
        word = np.repeat(np.arange(len(start)), size)
        place = np.arange(int(size.sum())) - at[word]
        flat = np.where(place == 0, 32, data[np.minimum(start[word] + place - 1, len(data) - 1)]).astype(np.uint8)
        left = size[word] - place
        out = [(word, place, place + 1, self.n + flat.astype(np.int64))]
        live, h = np.arange(len(flat)), np.zeros(len(flat), np.uint64)
        for n in range(1, max(self.tables, default=0) + 1):
            keep = left[live] >= n
            live, h = live[keep], h[keep]
            if not len(live):
                break
            h = h * _BASE + flat[live + n - 1].astype(np.uint64) + np.uint64(1)
            if n in self.tables:
                keys, ids = self.tables[n]
                k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[k] == h
                w = live[hit]
                out.append((word[w], place[w], place[w] + n, ids[k[hit]]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _sweep(self, nodes: int, words: int, word: np.ndarray, step: np.ndarray, here: np.ndarray, there: np.ndarray,
               weight: np.ndarray, piece: np.ndarray, roots: np.ndarray, logs: bool) -> np.ndarray:
        """Sums into ``there`` from ``here`` along arcs, one ``step`` after the other; ``logs``: of logarithms, else of probabilities."""
        total = np.full((nodes, *weight.shape[1:]), -np.inf if logs else 0.0)
        total[roots] = 0 if logs else 1
        order = np.argsort(step * words + word)
        step, here, there, cost = step[order], here[order], there[order], weight[piece[order]]
        bound = np.concatenate([[0], np.flatnonzero(np.diff(step)) + 1, [len(step)]]) if len(step) else [0]
        for lo, hi in zip(bound[:-1], bound[1:], strict=True):
            to = there[lo:hi]
            cut = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1])
            if not logs:
                total[to[cut]] = np.add.reduceat(total[here[lo:hi]] * cost[lo:hi], cut)
                continue
            v = total[here[lo:hi]] + cost[lo:hi]
            most = np.maximum.reduceat(v, cut)
            v -= np.repeat(most, np.diff(np.append(cut, hi - lo)), 0)
            total[to[cut]] = most + np.log(np.add.reduceat(np.exp(v), cut))
        return total

    def _halves(self, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
        """Words whose probability a double can hold, and the longer ones, whose logarithm is summed."""
        logs = (end - start + 1) * -self.weight.min(initial=0) > 600
        for part, x in ((np.flatnonzero(~logs), False), (np.flatnonzero(logs), True)):
            for lo in range(0, len(part), WORDS):
                yield part[lo:lo + WORDS], x

    def score(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability, summed over all segmentations, per group."""
        out = np.zeros((len(start), self.weight.shape[1]))
        for part, logs in self._halves(start, end):
            word, a, b, piece = self.arcs(data, start[part], end[part])
            size = end[part] - start[part] + 2
            node = np.cumsum(size) - size
            weight = self.weight if logs else self.share
            last = self._sweep(int(size.sum()), len(part), word, b, node[word] + a, node[word] + b, weight, piece, node, logs)[node + size - 1]
            out[part] = last if logs else np.log(last)
        return out

    def expected(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected use of each piece per group, ``count`` (words x groups) times each word; words a group doesn't hold cost it nothing."""
        groups = self.weight.shape[1]
        out = np.zeros(self.weight.size)
        kind, group = np.nonzero(count)
        start, end, times = start[kind], end[kind], count[kind, group]
        for part, logs in self._halves(start, end):
            word, a, b, piece = self.arcs(data, start[part], end[part])
            piece = piece * groups + group[part][word]
            size = end[part] - start[part] + 2
            node, weight = np.cumsum(size) - size, (self.weight if logs else self.share).ravel()
            here, there, last = node[word] + a, node[word] + b, node + size - 1
            forward = self._sweep(int(size.sum()), len(part), word, b, here, there, weight, piece, node, logs)
            backward = self._sweep(int(size.sum()), len(part), word, size[word] - 1 - a, there, here, weight, piece, last, logs)
            if logs:
                share = np.exp(forward[here] + weight[piece] + backward[there] - forward[last][word]) * times[part][word]
            else:
                share = forward[here] * weight[piece] * backward[there] * (times[part] / forward[last])[word]
            out += np.bincount(piece, share, len(out))
        return out.reshape(-1, groups)


def start_weights(n_pieces: int, groups: int) -> np.ndarray:
    w = np.concatenate([1 / (np.arange(n_pieces) + START), np.full(256, 1e-3 / max(1, n_pieces + START))])
    return np.repeat(np.log(w / w.sum())[:, None], groups, 1)


def _spans(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(w) for w in words], np.int64)
    end = np.cumsum(size)
    return np.frombuffer(b"".join(words) or b" ", np.uint8), end - size, end


def _bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as a binary array."""
    at = np.concatenate([[0], np.cumsum(end - start)])
    held = data[np.repeat(start - at[:-1], end - start) + np.arange(at[-1])]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(held))])


def _counts(groups: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """text, group (-1: held out) -> h, word, g, c: the words of each slice of texts."""
        for b in batches:
            group = b.column(1).to_numpy(zero_copy_only=False)
            for i, j, w in word_slices(b.column(0)):
                g = np.repeat(group[i:j], np.diff(w.first))
                _, first, c = np.unique(w.hash ^ mix(g.astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
                yield pa.record_batch([pa.array(w.hash[first].view(np.int64)), _bytes(w.data, w.start[first], w.end[first]),
                                       pa.array(g[first].astype(np.int32)), pa.array(c.astype(np.int64))], names=["h", "word", "g", "c"])
    return count


def _batches_of_words(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[tuple[pa.RecordBatch, tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]]:
    """Rows h, word, c, g0, ... a few thousand at a time: (rows, the words' bytes and spans, groups' counts)."""
    for b in batches:
        size = max(500, 20_000 * GROUPS // max(GROUPS, groups))
        for lo in range(0, b.num_rows, size):
            part = b.slice(lo, size)
            data, at = raw(part.column(1))
            yield part, (data if len(data) else np.zeros(1, np.uint8), at[:-1], at[1:]), np.stack([part.column(3 + g).to_numpy() for g in range(groups)], 1)


def re_estimate(spark: SparkSession, words: DataFrame, pieces: list[bytes], weight: np.ndarray) -> np.ndarray:
    """One round of expectation-maximisation over the distinct words of each group."""
    groups = weight.shape[1]
    held = spark.sparkContext.broadcast((pieces, weight))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*held.value)
        total = np.zeros_like(held.value[1])
        for _, spans, c in _batches_of_words(batches, groups):
            total += lattice.expected(*spans, (c > 0).astype(np.float64))
        used = np.flatnonzero(total.any(1))
        yield pa.record_batch([pa.array(used), *(pa.array(total[used, g]) for g in range(groups))], names=["piece", *(f"g{g}" for g in range(groups))])

    got = (words.mapInArrow(expect, "piece long, " + ", ".join(f"g{g} double" for g in range(groups)))
           .groupBy("piece").agg(*(F.sum(f"g{g}").alias(f"g{g}") for g in range(groups))).toArrow())  # one row per piece at most
    total = np.full(weight.shape, SMOOTHING)
    for g in range(groups):
        total[got["piece"].to_numpy(), g] += got[f"g{g}"].to_numpy()
    held.unpersist()
    return np.log(total / total.sum(0))


def _score_texts(held, groups: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, held_out, text -> sums over the frequent words, and the hashes of all others."""
        keys, log_count, log_p = held.value
        for b in batches:
            for i, j, w in word_slices(b.column(2), SLICE_BYTES * GROUPS // max(GROUPS, groups)):
                k = np.minimum(np.searchsorted(keys, w.hash), max(0, len(keys) - 1))
                heavy = keys[k] == w.hash if len(keys) else np.zeros(len(w.hash), bool)
                light = np.flatnonzero(~heavy)
                p, c = np.zeros((len(w.hash), groups)), np.zeros(len(w.hash))
                p[heavy], c[heavy] = log_p[k[heavy]], log_count[k[heavy]]
                total, at = _per_text(w, p), np.searchsorted(light, w.first).astype(np.int32)
                hashes = pa.ListArray.from_arrays(pa.array(at), pa.array(w.hash[light].view(np.int64)))
                yield pa.record_batch([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(np.diff(w.first) + 1),
                                       pa.array(_per_text(w, (c > 0).astype(np.int64))), pa.array(_per_text(w, c)), hashes,
                                       *(pa.array(total[:, g]) for g in range(groups))],
                                      names=["doc_id", "held_out", "n_tokens", "n_known", "base", "light", *(f"s{g}" for g in range(groups))])
    return score


def _per_text(w: Words, x: np.ndarray) -> np.ndarray:
    """Sum over the words of each text."""
    total = np.concatenate([np.zeros((1, *x.shape[1:]), x.dtype), np.cumsum(x, 0)])
    return total[w.first[1:]] - total[w.first[:-1]]


def _most_counted(counts: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The words that reach the least count that at most ``limit`` words reach, and the others."""
    least, seen = None, 0
    for r in counts.groupBy("c").count().orderBy(F.desc("c")).toLocalIterator():
        seen += r["count"]
        if seen > limit:
            break
        least = r["c"]
    return (counts.where("false"), counts) if least is None else (counts.where(F.col("c") >= least), counts.where(F.col("c") < least))


def score_texts(docs: DataFrame, vocabulary_file: str, id_col: str = "doc_id", text_col: str = "text", group_col: str | None = "lang",
                heavy: int = HEAVY, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    spark = docs.sparkSession
    s = Scratch(spark, "lattice")
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS, F.lit(0))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold == HELD_OUT).alias("held_out"), F.col(text_col).alias("text"),
                       (F.col(group_col).cast("string") if group_col else F.lit("")).alias("group"))
    train = rows.where("not held_out")

    sizes = train.groupBy("group").agg(F.count("*").alias("n"))
    named = [r["group"] for r in sizes.orderBy(F.desc("n"), "group").collect()]  # one row per declared language
    groups = max(1, len(named))
    place = [F.lit(x) for g, name in enumerate(named) if name is not None for x in (name, g)]
    index = F.create_map(*place)[F.col("group")] if place else F.lit(0)
    if None in named:
        index = F.when(F.col("group").isNull(), named.index(None)).otherwise(index)
    numbered = rows.select("text", F.when(F.col("held_out"), -1).otherwise(index.cast("int")).alias("g"))
    ends = np.zeros(groups)
    for r in numbered.where("g >= 0").groupBy("g").count().collect():
        ends[r["g"]] = r["count"]

    counts = numbered.mapInArrow(_counts(groups), "h long, word binary, g int, c long").groupBy("h", "word").agg(
        F.sum(F.when(F.col("g") >= 0, F.col("c")).otherwise(0)).alias("c"), *(F.sum(F.when(F.col("g") == g, F.col("c")).otherwise(0)).cast("double").alias(f"g{g}") for g in range(groups)))
    counts = s.save(counts, "counts")
    trained = counts.where("c > 0")
    n, v = trained.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, v = n + int(ends.sum()), v + int(ends.sum() > 0)

    pieces = vocabulary(vocabulary_file)
    weight = start_weights(len(pieces), groups)
    if ends.sum():
        for _ in range(rounds + 1):
            weight = re_estimate(spark, trained, pieces, weight)
    model = spark.sparkContext.broadcast((pieces, weight))

    # Per group: all tokens and the distinct ones; what is left for pieces, and what the end and the group itself weigh.
    got = counts.agg(*(F.sum(f"g{g}") for g in range(groups)), *(F.count(F.when(F.col(f"g{g}") > 0, 1)) for g in range(groups))).first()
    kinds = np.array(got[groups:], float) + 1
    mass = np.array([x or 0.0 for x in got[:groups]]) + ends + kinds
    novel, log_end = np.log(kinds / mass), np.log((ends + (ends.sum() == 0)) / mass + (ends == 0) * 1e-9)
    prior = np.log((ends + 1) / (ends.sum() + groups))

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per word: log10(c + 1) and the logarithm with all its arcs."""
        lattice = Lattice(*model.value)
        for part, spans, c in _batches_of_words(batches, groups):
            both = np.logaddexp(lattice.score(*spans) + novel, np.log(np.maximum(c, 1e-300) / mass))
            yield pa.record_batch([part.column(0), pa.array(np.log10(part.column(2).to_numpy() + 1.0)), *(pa.array(both[:, g]) for g in range(groups))],
                                  names=["h", "log_count", *(f"p{g}" for g in range(groups))])

    often, less = _most_counted(counts, heavy * GROUPS // max(GROUPS, groups))
    scored_words = "h long, log_count double, " + ", ".join(f"p{g} double" for g in range(groups))
    top = often.mapInArrow(score_words, scored_words).toArrow()  # at most ``heavy`` rows
    keys = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    held = spark.sparkContext.broadcast((keys[order], top["log_count"].to_numpy()[order],
                                         np.stack([top[f"p{g}"].to_numpy()[order] for g in range(groups)], 1)))
    scored = s.save(rows.select("doc_id", "held_out", "text").mapInArrow(
        _score_texts(held, groups), "doc_id long, held_out boolean, n_tokens long, n_known long, base double, light array<long>, "
        + ", ".join(f"s{g} double" for g in range(groups))).withColumn("_row", F.monotonically_increasing_id()), "scored")
    light = less.mapInArrow(score_words, scored_words)
    rest = (scored.select("_row", F.explode("light").alias("h")).join(light, "h")
            .groupBy("_row").agg(F.count(F.when(F.col("log_count") > 0, 1)).alias("_known"), F.sum("log_count").alias("_base"),
                                 *(F.sum(f"p{g}").alias(f"d{g}") for g in range(groups))))
    more = lambda c, zero=0.0: F.coalesce(F.col(c), F.lit(zero))
    logs = [F.col(f"s{g}") + more(f"d{g}") + float(log_end[g] + prior[g]) for g in range(groups)]
    most = F.greatest(*logs) if groups > 1 else logs[0]
    joined = scored.drop("light").join(rest, "_row", "left").withColumn("_most", most)
    total = sum((F.exp(x - F.col("_most")) for x in logs), F.lit(0.0))
    end_known, end_log, per_token = int(ends.sum() > 0), float(np.log10(ends.sum() + 1)), float(np.log10(n + v + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more("_known", 0) + end_known).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more("_base") + end_log - F.col("n_tokens") * per_token).alias("base_score"),
        ((F.col("_most") + F.log(total)) / float(np.log(10))).alias("score"))
