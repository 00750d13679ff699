"""Words of whole texts as arrays: Arrow string batches in, 64-bit word hashes and byte spans out.

A word is a maximal run of characters other than space and U+0009..U+000D, with
A-Z lower-cased. All work is on the UTF-8 bytes of a batch at once; batches are
cut into slices of a few MB so that memory does not depend on how many rows
Spark puts into a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
SHINGLE = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: bytes.translate table that turns white space between words into spaces.
SPACES = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
_rng = np.random.default_rng(20_250_101)
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words of some texts. ``first[i]:first[i + 1]`` are those of text i."""

    data: np.ndarray  # lower-cased UTF-8 bytes of all texts
    text_at: np.ndarray  # byte offset of each text, plus the end
    start: np.ndarray  # byte span of each word
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def text(self, i: int) -> np.ndarray:
        return self.hash[self.first[i]:self.first[i + 1]]


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[at[0]:at[-1]] if held is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def slices(at: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one row."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a time."""
    held = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(held) - 7,), np.uint64, held.data, 0, (1,))  # the 8 bytes from every place on
    size = end - start
    out = mix((eight[start] & _LOW[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    live, at = np.flatnonzero(size > 8), 8
    while len(live):
        left = size[live] - at
        out[live] = mix(out[live] * np.uint64(0xD6E8FEB86659FD93) + (eight[start[live] + at] & _LOW[np.minimum(left, 8)]))
        live, at = live[left > 8], at + 8
    return out


def words_of(data: np.ndarray, text_at: np.ndarray) -> Words:
    data = _LOWER[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, text_at, none, none, np.zeros(0, np.uint64), np.zeros(len(text_at), np.int64))
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[text_at] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(data, text_at, start, end, hash_spans(data, start, end), np.searchsorted(start, text_at, "left"))


def word_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, their words), a few MB of text at a time."""
    data, at = raw(texts)
    for i, j in slices(at, limit):
        yield i, j, words_of(data[at[i]:at[j]], at[i:j + 1] - at[i])


def shingles(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of every ``size`` consecutive words; fewer words make one shingle, none make none."""
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    k = min(size, len(h))
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out += h[j:j + n] * _PLACE[j]
    return mix(out)


def sequence_key(h: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit keys of a whole word sequence."""
    place = np.arange(len(h), dtype=np.uint64)
    a = mix(h ^ mix(place + np.uint64(1))).sum(dtype=np.uint64)
    b = (mix(h * np.uint64(0xD6E8FEB86659FD93) + place * np.uint64(0xA0761D6478BD642F)) >> np.uint64(1)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))
