"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

``pieces`` tokenises whole texts inside tasks and cuts only documents longer than a
sequence. ``pack`` deals the pieces out at random into groups of about ``GROUP``
pieces and packs each group on its own, longest piece first: of the open bins with
room, a piece goes where the sum of the squared counts of open bins per residual gap
becomes smallest. The groups bound what one task holds whatever the corpus; each
leaves about one bin partly empty.

Defined results: a null or empty text is the single end token; every input row is a
document of its own, also when ids repeat or are null; an empty table gives an empty
result; only the id and text columns are read.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import hash_spans, raw, slices

LENGTH = 2048
END = 0
GROUP = 1 << 16
KNOWN_UNITS = 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends at each place is white space beyond ASCII."""
    one = data[at - 1]
    two, three = (np.where(at >= k, data[np.maximum(at - k, 0)], 0) for k in (2, 3))
    return (((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
            | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
            | ((three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)))
            | ((three == 0xE2) & (two == 0x81) & (one == 0x9F)) | ((three == 0xE3) & (two == 0x80) & (one == 0x80)))


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable in Latin-1, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in shown)}


class UnitTokenizer:
    """Token ids of whole texts by the byte-level BPE file of ``tokenizers``, each distinct unit encoded once.

    A unit is a run of white space with the word after it. The byte-level pattern never
    lets a token span the place where white space begins after a word, so a text's ids are
    those of its units in order. The file's vocabulary is also given to ``tiktoken``, which
    applies the same merges several times faster; units with an added token of the file go
    through ``tokenizers`` itself. The tests hold the ids against that library.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.fast = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            bytes(letters[c] for c in token): rank for token, rank in vocabulary.items() if token not in self.added})
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.size[[rank for token, rank in vocabulary.items() if token not in self.added]] = [len(token) for token in vocabulary if token not in self.added]
        self.known: dict[int, bytes] = {}

    def unit(self, span: str) -> list[int]:
        if any(t in span for t in self.added):
            return self.tokenizer.encode(span, add_special_tokens=False).ids
        return self.fast.encode_ordinary(span)

    def units(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
        """The ids of each unit. Units that begin with white space and end in a word are encoded in one piece, as a text
        of theirs would be: no token spans the place between two of them, so the tokens' bytes tell which are whose."""
        plain = _SPACE[data[begin]] & ~_SPACE[data[end - 1]] & ~_after_wide_space(data, end)
        if any(t.encode() in data.tobytes() for t in self.added):
            plain[:] = False
        out: list[bytes] = [b""] * len(begin)
        if plain.any():
            n = (end - begin)[plain]
            stop = np.cumsum(n)
            ids = np.array(self.fast.encode_ordinary(data[np.repeat(begin[plain] - (stop - n), n) + np.arange(stop[-1])].tobytes().decode()), "<u4")
            after = np.cumsum(self.size[ids])
            last = np.minimum(np.searchsorted(after, stop), len(ids) - 1)
            if (after[last] == stop).all():
                held, at = ids.tobytes(), 0
                for k, z in zip(np.flatnonzero(plain).tolist(), ((last + 1) * 4).tolist(), strict=True):
                    out[k], at = held[at:z], z
            else:
                plain[:] = False
        for k in np.flatnonzero(~plain).tolist():
            out[k] = np.array(self.unit(data[begin[k]:end[k]].tobytes().decode()), "<u4").tobytes()
        return out

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        data, at = raw(texts)
        for i, j in slices(at):
            yield from self._slice(data[at[i]:at[j]], at[i:j + 1] - at[i])

    def _slice(self, data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        none = np.zeros(0, np.uint32)
        if not len(data):
            yield from (none for _ in range(len(at) - 1))
            return
        space = _SPACE[data]
        cut = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        cut = np.union1d(cut[~_after_wide_space(data, cut)], at[:-1][at[:-1] < at[1:]])
        end = np.append(cut[1:], len(data))
        kinds, first, which = np.unique(hash_spans(data, cut, end), return_index=True, return_inverse=True)
        keys, known = kinds.tolist(), self.known
        new = [k for k, h in enumerate(keys) if h not in known]
        if new:
            if len(known) + len(new) > KNOWN_UNITS:
                known.clear()
                new = range(len(keys))
            places = first[new]
            known.update(zip((keys[k] for k in new), self.units(data, cut[places], end[places]), strict=True))
        held = [known[h] for h in keys]
        size = np.array([len(x) // 4 for x in held])
        flat, place = np.frombuffer(b"".join(held), np.uint32), np.cumsum(size) - size
        n = size[which]
        stop = np.cumsum(n)
        out = flat[np.repeat(place[which] - (stop - n), n) + np.arange(stop[-1])]
        bound = np.concatenate([[0], stop])[np.searchsorted(cut, at, "left")]
        for a, b in zip(bound[:-1], bound[1:], strict=True):
            yield out[a:b]


@functools.cache
def unit_tokenizer(path: str) -> UnitTokenizer:
    """One per worker: reading the file takes longer than a small task."""
    return UnitTokenizer(path)


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be shorter."""
    k = max(1, -(-n // length))
    head = n - (k - 1) * length
    return [(0, head), *((head + i * length, length) for i in range(k - 1))]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and a salt that spreads the pieces."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        units = unit_tokenizer(tokenizer)
        for b in batches:
            ids, rows, row = b.column(0).to_pylist(), [], 0
            for row, got in enumerate(units.ids(b.column(1))):
                got = np.append(got, np.uint32(END)).astype("<u4")
                for p, (start, n) in enumerate(cuts(len(got), length)):
                    crc = zlib.crc32(got[start:start + n].tobytes())
                    rows.append((ids[row], p, start, n, crc, crc ^ (row * 0x9E3779B1 + p * 0x85EBCA6B)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True) if rows else [[]] * 6,
                (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"])
        units.known.clear()  # the worker goes on to other tasks

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def sum_of_squares(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size. Longest first; a new bin only where no open one has room."""
    count = np.zeros(length + 1)
    open_bins: list[list[int]] = [[] for _ in range(length + 1)]
    where, offset, bins = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for item in np.argsort(-sizes, kind="stable"):
        s = int(sizes[item])
        # The change of the sum of squares, halved, for each gap g = s, s + 1, ...; a full bin is not counted.
        change = count[:length + 1 - s] - count[s:] + 1
        change[0] -= 0.5
        change[count[s:] == 0] = np.inf
        best = int(change.argmin())
        if np.isfinite(change[best]):
            gap = best + s
            count[gap] -= 1
            b = open_bins[gap].pop()
        else:
            gap, b, bins = length, bins, bins + 1
        where[item], offset[item] = b, length - gap
        if gap > s:
            count[gap - s] += 1
            open_bins[gap - s].append(b)
    return where, offset


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence and its place there, gapless from 0."""
    s = Scratch(docs.sparkSession, "packing")
    cut = s.save(pieces(docs, tokenizer, length, id_col, text_col), "pieces")
    groups = max(1, math.ceil(cut.count() / GROUP))

    def pack_group(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("salt", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        where, offset = sum_of_squares(t["length"].to_numpy(), length)
        return t.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column(
            "sequence_id", pa.array(where * groups + key[0].as_py())).append_column("offset", pa.array(offset))

    grouped = cut.withColumn("_g", F.pmod(F.xxhash64("salt", "doc_id", "piece"), F.lit(groups)).cast("long"))
    return grouped.groupBy("_g").applyInArrow(pack_group, PACKED)
