"""Token counts of whole texts by a two-tier lookup of pre-token lengths on the map side.

1. The driver asks the tokenizer's own pre-tokenizer for the class (letter, number, white space, other) of every code
   point, so that tasks split texts into pre-tokens with array operations and the library's own version of Unicode.
2. ``SAMPLE_DOCS`` documents or so tell which pre-tokens are frequent. At most ``FREQUENT`` of them, as a hash and a
   length, make an open-addressing table of fixed size, which is broadcast (about 0.7 MB).
3. One pass over all texts: a pre-token's length comes from that table, else from its worker's own cache, else from the
   library, which encodes each missing pre-token once. Nothing but the counts leaves a task; no row is shuffled.

Which pre-tokens the table holds changes the speed only, never a count. Pre-tokens are told apart by 64-bit hashes: with
ten billion distinct ones and a full table the odds that any two share a hash are below one in ten thousand.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a text that holds a string of an added token (such as
an end marker) is encoded whole by the library, with its default handling; every input row gives one row, also when ids
repeat or are null; bytes that are no UTF-8 count as they stand and are read as replacement characters; an empty table gives an empty result;
only the id and text columns are read. A tokenizer file with a normalizer or another pre-tokenizer is an error.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import hash_spans, raw, slices

LIMIT = 512
#: Documents, tasks and entries of the frequency table.
SAMPLE_DOCS = 4096
SAMPLE_TASKS = 8
FREQUENT = 1 << 15
SLOTS = 1 << 16
PROBES = 8
#: Pre-tokens that a worker keeps besides the table; beyond that it starts anew.
CACHED = 300_000

LETTER, NUMBER, OTHER, SPACE = range(4)
SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Library:
    """The tokenizer of a file, with the length in tokens of single pre-tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        if made["normalizer"] or made["truncation"] or made["padding"] or not made["pre_tokenizer"] or SPLIT.items() - made["pre_tokenizer"].items():
            raise ValueError(f"{path}: only byte-level files without normalizer, truncation or padding can be counted by pre-tokens")
        self.added = [t["content"].encode() for t in made["added_tokens"]]
        self.cache: dict[int, int] = {}

    def classes(self) -> np.ndarray:
        """The class of every code point, by its own pre-tokenizer; planes that hold no assigned ones are ``OTHER``."""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        points = [chr(c) for c in (*range(0x20), *range(0x21, 0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000))]
        out = np.full(0x110000, OTHER, np.uint8)
        # Neighbours of one class stay together, so the first of each run tells the class of all.
        for _, (a, b) in split("".join(points)):
            c = points[a]
            kind = next((k for k, probe in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(split(probe + c)) == 1), SPACE)
            out[ord(points[a]):ord(points[b - 1]) + 1] = kind
        out[0x20] = SPACE
        return out

    def lengths(self, tokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(tokens, add_special_tokens=False)]

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


@functools.cache
def library(path: str) -> Library:
    """One per worker: it outlives the tasks, and so does its cache."""
    return Library(path)


def pre_tokens(points: np.ndarray, at: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in texts of code points ``points``, of which text i is ``at[i]:at[i + 1]``.

    A run of one class is a pre-token. A space before a run of another class belongs to that run; white space before it
    stays a run of its own, and any other last white-space character too. An apostrophe that follows no space takes the letters of an
    English contraction, and the rest of those letters is a run of its own.
    """
    n = len(points)
    kind = classes[points]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    edge[n] = True
    new = edge[:-1].copy()
    new[1:] |= kind[1:] != kind[:-1]
    first = np.flatnonzero(new)
    end = np.append(first[1:], n)
    white = kind[first] == SPACE
    inner = white & ~edge[end]
    new[end[inner] - 1] = True
    joined = end[inner & (points[end - 1] == 0x20)]
    new[joined] = False
    quote = np.flatnonzero((points[first] == 0x27) & (end - first == 1) & ~edge[end] & new[first])
    quote = quote[kind[end[quote]] == LETTER]
    begin, stop = end[quote], end[quote + 1]
    one = points[begin]
    two = np.where(begin + 1 < stop, points[np.minimum(begin + 1, n - 1)], 0)
    size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
    size[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))] = 2
    begin, stop, size = begin[size > 0], stop[size > 0], size[size > 0]
    new[begin] = False
    rest = begin + size
    new[rest[rest < stop]] = True
    return np.flatnonzero(new)


class Table:
    """Lengths by hash, open addressing: ``find`` gives 0 for those it doesn't hold."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        self.keys, self.lengths = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint16)
        for p in range(PROBES):  # earlier ones, the more frequent, come nearer to their place
            slot = self._slot(hashes, p)
            free = self.lengths[slot] == 0
            _, pick = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[pick]
            self.keys[slot[put]], self.lengths[slot[put]] = hashes[put], lengths[put]
            left = np.ones(len(hashes), bool)
            left[put] = False
            hashes, lengths = hashes[left], lengths[left]

    @staticmethod
    def _slot(hashes: np.ndarray, probe: int) -> np.ndarray:
        return ((hashes >> np.uint64(16)) + np.uint64(probe)).astype(np.int64) & (SLOTS - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slot = self._slot(hashes, 0)
        out = np.where(self.keys[slot] == hashes, self.lengths[slot], 0).astype(np.int64)
        for p in range(1, PROBES):
            open_at = np.flatnonzero(out == 0)
            slot = self._slot(hashes[open_at], p)
            out[open_at] = np.where(self.keys[slot] == hashes[open_at], self.lengths[slot], 0)
        return out


def token_slices(texts: pa.Array, classes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, begin and end of each pre-token, first pre-token of each row) of a few MB of text at a time."""
    data, at = raw(texts)
    try:
        data.tobytes().decode()
    except UnicodeDecodeError:
        data, at = raw(pa.array([None if t is None else t.decode(errors="replace") for t in texts.cast(pa.large_binary()).to_pylist()], pa.large_string()))
    for i, j in slices(at):
        held, bound = data[at[i]:at[j]], at[i:j + 1] - at[i]
        if not len(held):
            yield i, j, held, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(j - i + 1, np.int64)
            continue
        lead = np.flatnonzero((held & 0xC0) != 0x80)  # the byte where each code point begins
        points = np.frombuffer(held.tobytes().decode().encode("utf-32-le"), np.uint32)
        begin = lead[pre_tokens(points, np.searchsorted(lead, bound), classes)]
        yield i, j, held, begin, np.append(begin[1:], len(held)), np.searchsorted(begin, bound)


def _missing(lib: Library, data: np.ndarray, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Lengths of pre-tokens that the table doesn't hold, by the worker's cache and else by the library."""
    kinds, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    keys = kinds.tolist()
    if len(lib.cache) + len(keys) > CACHED:
        lib.cache.clear()
    new = [k for k, h in enumerate(keys) if h not in lib.cache]
    if new:
        spans = [data[begin[f]:end[f]].tobytes().decode() for f in first[new]]
        lib.cache.update(zip((keys[k] for k in new), lib.lengths(spans), strict=True))
    return np.array([lib.cache[h] for h in keys], np.int64)[which]


def frequent(docs: DataFrame, tokenizer: str, classes: Broadcast, text_col: str = "text") -> Table:
    """The table of the most frequent pre-tokens of a sample. A task keeps at most ``FREQUENT`` of them, and so does the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, seen, length = library(tokenizer), {}, {}
        for b in batches:
            for _, _, data, begin, end, _ in token_slices(b.column(0), classes.value):
                if not len(begin):
                    continue
                h = hash_spans(data, begin, end)
                kinds, first, n = np.unique(h, return_index=True, return_counts=True)
                for k, m, size in zip(kinds.tolist(), n.tolist(), _missing(lib, data, kinds, begin[first], end[first]).tolist(), strict=True):
                    seen[k] = seen.get(k, 0) + m
                    length[k] = size
                if len(seen) > 8 * FREQUENT:
                    seen = dict(sorted(seen.items(), key=lambda x: -x[1])[:4 * FREQUENT])
                    length = {k: length[k] for k in seen}
        top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT]
        yield pa.record_batch([pa.array(np.array([k for k, _ in top], np.uint64).view(np.int64)), pa.array([length[k] for k, _ in top], pa.int64()),
                               pa.array([m for _, m in top], pa.int64())], names=["h", "length", "n"])

    rows = docs.count()
    sample = docs.select(text_col).sample(fraction=min(1.0, SAMPLE_DOCS / max(1, rows)), seed=13)
    got = sample.repartition(SAMPLE_TASKS).mapInArrow(count, "h long, length long, n long").toArrow()
    h, which = np.unique(got["h"].to_numpy().view(np.uint64), return_inverse=True)
    total, length = np.bincount(which, got["n"].to_numpy(), len(h)), np.zeros(len(h), np.int64)
    length[which] = got["length"].to_numpy()
    keep = np.flatnonzero(length < 1 << 16)
    keep = keep[np.argsort(-total[keep], kind="stable")[:FREQUENT]]
    return Table(h[keep], length[keep])


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row of ``docs``."""
    sc = docs.sparkSession.sparkContext
    classes = sc.broadcast(library(tokenizer).classes())
    table = sc.broadcast(frequent(docs, tokenizer, classes, text_col))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = library(tokenizer)
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            size = np.diff(raw(texts)[1])
            out = np.zeros(len(ids), np.int64)
            for i, j, data, begin, end, first in token_slices(texts, classes.value):
                if not len(begin):
                    continue
                h = hash_spans(data, begin, end)
                n = table.value.find(h)
                rare = np.flatnonzero(n == 0)
                n[rare] = _missing(lib, data, h[rare], begin[rare], end[rare])
                total = np.concatenate([[0], np.cumsum(n)])
                out[i:j] = total[first[1:]] - total[first[:-1]]
                whole = data.tobytes()
                if any(t in whole for t in lib.added):
                    bound = np.append(begin, len(data))[first]
                    for k in range(j - i):
                        text = whole[bound[k]:bound[k + 1]]
                        if any(t in text for t in lib.added):
                            out[i + k] = lib.whole(text.decode())
            yield pa.record_batch([ids, pa.array(size, pa.int64()), pa.array(out), pa.array(out > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count, COUNTS)
