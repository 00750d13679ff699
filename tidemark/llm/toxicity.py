"""Toxicity by compression distance: how much shorter windows get with a dictionary of toxic text.

Two zstandard dictionaries are trained on a bounded, hash-drawn sample of labelled
rows: ``TOXIC_DOCS`` and ``ORDINARY_DOCS`` texts, of each at most ``SAMPLE_WINDOWS`` windows spread over it. The ordinary one is
trained on windows of ordinary texts. The toxic one is trained on the passages of toxic texts that set
them apart: runs of bytes covered by strings (``GRAMS`` bytes long; words, phrases or text without
spaces alike) that occur in more toxic texts than chance explains for even one string (a binomial bound; copies of a text or of a
passage count once). As zstandard keeps only frequent stretches, words whose beginnings set toxic texts apart in the
same way follow it, and after them the ordinary content, so both dictionaries compress ordinary
language alike, and a window's difference is what toxic wording saves.

Every text is cut into windows at white space, or after ``LONGEST`` bytes without any; each is compressed with both dictionaries.
Two figures of a text enter a logistic curve, and neither rises with its length alone: how rare its largest
saving is as the largest of that many ordinary windows, and its mean saving. Curve and rarities
are fitted on texts that the dictionaries in use there were not trained on (the sample's halves in turn).

Defined results: null or empty text has no windows and gets the curve's value for no savings; rows whose
training label is null don't train; labels that repeat an id count as toxic if any is; of an id with several texts
the smallest one trains; every document row is scored, also when ids repeat or are null; without labelled texts of both kinds
every score is the share of toxic labels (0 without labels); an empty table gives an empty result. Only the
named columns are read, and labels never enter a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import SPACES, shingles, word_slices

TOXIC_DOCS, ORDINARY_DOCS = 3000, 6000
SAMPLE_WINDOWS = 32
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
WINDOW_BYTES = 120
LONGEST = 2 * WINDOW_BYTES
PAD_BYTES = 192
TAIL = 16
GRAMS = (6, 12, 20)
CONTEXT = 5
BEGINNING = 5
EDGES = b".,;:!?*#%&$\"'()[]|"
WORD_BYTES, REACH = 4, 24
LEVELS = 64
CHUNK_BYTES = 2 << 20
#: Share of toxic texts among those that hold a telling string, at least.
PURITY = 0.6
#: Evidence (-log10 of chance) that a telling string needs in any case.
MIN_EVIDENCE = 3.0
ORDINARY_DICT_BYTES = 32 << 10
TOXIC_DICT_BYTES = 16 << 10
ROUNDS = 50

_PRIME, _OWNER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def windows(text: bytes) -> list[bytes]:
    """Lower-cased windows of about ``WINDOW_BYTES``, cut where white space follows a word; each starts with a space or a cut.

    Each runs ``TAIL`` bytes into the next one: zstandard starts no match in the last bytes of its input.
    """
    data = b" " + text.lower().translate(SPACES).strip()
    if len(data) == 1:
        return []
    padded, out, at = data + b" " * TAIL, [], 0
    while at < len(data):
        end = data.find(b" ", at + WINDOW_BYTES, at + LONGEST)
        end = min(len(data), at + LONGEST) if end < 0 else end
        out.append(padded[at:end + TAIL])
        at = end
    return out


class Distance:
    """Bytes saved by the toxic dictionary, window by window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard as z

        shape = z.ZstdCompressionParameters(window_log=18, hash_log=17, chain_log=17, search_log=6, min_match=5, target_length=32, strategy=z.STRATEGY_BTLAZY2,
                                            write_content_size=False, write_checksum=False, write_dict_id=False)
        kind = lambda data: z.ZstdCompressor(dict_data=z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=shape)
        self.plain, self.toxic = kind(ordinary), kind(toxic + ordinary)
        # Both dictionaries end with this, so it costs one match; without it a window that hardly shrinks
        # would be stored as it is, and what the toxic words save would not show.
        self.pad = ordinary[-PAD_BYTES:]

    def counts(self, text: str | None) -> np.ndarray:
        """The text's windows by bytes saved, at most ``LEVELS`` - 1."""
        a, b = self.plain.compress, self.toxic.compress
        saved = [len(a(self.pad + w)) - len(b(self.pad + w)) for w in windows((text or "").encode())]
        return np.bincount(np.clip(np.array(saved, int), 0, LEVELS - 1), minlength=LEVELS)


def sample_windows(text: str | None) -> list[bytes]:
    """At most ``SAMPLE_WINDOWS`` windows, spread evenly over the text."""
    w = windows((text or "").encode())
    return [w[k * len(w) // SAMPLE_WINDOWS] for k in range(SAMPLE_WINDOWS)] if len(w) > SAMPLE_WINDOWS else w


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, toxic -> key, doc_id, toxic, text; copies of a text mostly share the key, its least five-word shingle."""
    for b in batches:
        for i, j, w in word_slices(b.column(1)):
            sets = [shingles(w.text(k)) for k in range(j - i)]
            part = b.slice(i, j - i)
            yield pa.record_batch([pa.array([int(x.min() >> np.uint64(1)) if len(x) else 0 for x in sets], pa.int64()), part.column(0), part.column(2), part.column(1)],
                                  names=["key", "doc_id", "toxic", "text"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """fits, toxic, text -> fits, toxic, windows."""
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            yield pa.record_batch([part.column(0), part.column(1), pa.array([sample_windows(t) for t in part.column(2).to_pylist()], pa.list_(pa.binary()))],
                                  names=["fits", "toxic", "windows"])


def gram_hashes(data: bytes, size: int) -> np.ndarray:
    """A hash of each run of ``size`` bytes, by its first byte's place."""
    x = np.frombuffer(data, np.uint8)
    out = np.zeros(max(0, len(x) - size + 1), np.uint64)
    for k in range(size):
        out *= _PRIME
        out += x[k:k + len(out)]
    return out


def _grams(texts: list[list[bytes]], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """A few MB of windows at once: their strings' hashes, places and texts, the bytes, and each window's end and text.

    No string runs over a window's end.
    """
    at = 0
    while at < len(texts):
        parts: list[bytes] = []
        lengths, owner, total = [], [], 0
        while at < len(texts) and total < CHUNK_BYTES:
            for w in texts[at]:
                parts.append(w)
                lengths.append(len(w))
                owner.append(at)
            total += sum(map(len, texts[at]))
            at += 1
        data = b"".join(parts)
        ends = np.cumsum(np.array(lengths, int)) if lengths else np.zeros(0, int)
        window = np.repeat(np.arange(len(lengths)), lengths)[:max(0, len(data) - size + 1)]
        inside = np.flatnonzero(np.arange(len(window)) + size <= ends[window]) if len(window) else np.zeros(0, int)
        owner_of = np.array(owner, int)
        yield gram_hashes(data, size)[inside], inside, data, owner_of[window[inside]], ends, owner_of


def _distinct(texts: list[list[bytes]], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct strings of each text, one text after the other, and a hash of the first one's surroundings."""
    for hashes, places, data, owner, _, _ in _grams(texts, size):
        _, first = np.unique(hashes ^ (owner.astype(np.uint64) * _OWNER), return_index=True)
        edge = b" " * CONTEXT
        yield hashes[first], gram_hashes(edge + data + edge, size + 2 * CONTEXT)[places[first]]


def telling(toxic: list[list[bytes]], ordinary: list[list[bytes]], size: int) -> np.ndarray:
    """Hashes of the strings that occur in more toxic texts than chance explains, sorted.

    Toxic texts with the same bytes around a string count once, so that a copied passage tells nothing.
    """
    pairs = np.concatenate([np.zeros((0, 2), np.uint64), *(np.stack(x, 1) for x in _distinct(toxic, size))])
    _, first = np.unique(pairs[:, 1], return_index=True)
    keys, a = np.unique(pairs[first, 0], return_counts=True)
    total_a = int(a.sum())
    keys, a = keys[a > 1], a[a > 1]
    n, total = a.copy(), total_a
    for other, _ in _distinct(ordinary, size):
        total += len(other)
        if len(keys):
            at = np.searchsorted(keys, other)
            at[at == len(keys)] = 0
            n += np.bincount(at[keys[at] == other], minlength=len(keys))
    if not len(keys) or total == total_a:
        return keys[:0]
    # Texts differ in length, so chance is the toxic share of all (string, text) pairs.
    share, p = total_a / total, a / n
    rest = np.where(p < 1, (1 - p) * np.log10(np.maximum(1 - p, 1e-300) / (1 - share)), 0.0)
    # Strings too rare to pass even if all their texts were toxic aren't tested, and don't count as tests (Tarone's correction).
    best = np.sort(n * -np.log10(share))[::-1]
    tests = np.log10(np.arange(1, len(best) + 1))
    needed = tests[np.flatnonzero(best >= tests)[-1]] if best[0] >= 0 else np.inf
    return keys[(p >= PURITY) & (p > share) & (n * (p * np.log10(p / share) + rest) >= max(needed, MIN_EVIDENCE))]


def own_words(data: bytes, i: int, j: int, end: int) -> bytes:
    """The run from i to j without the ends of words that it only touches, and with the rest of the last one it holds."""
    first = data.find(b" ", i, j - WORD_BYTES)
    i = i if first < 0 else first
    last = data.rfind(b" ", i + WORD_BYTES, j)
    if last >= j - WORD_BYTES:
        return data[i:last + 1]
    rest = data.find(b" ", j, min(j + REACH, end))
    return data[i:j if rest < 0 else rest + 1]


def passages(texts: list[list[bytes]], grams: dict[int, np.ndarray]) -> list[bytes]:
    """Per text: the runs of its windows that telling strings cover, with the rest of their last words."""
    out: list[bytes] = []
    sizes = sorted(grams)
    for several in zip(*(_grams(texts, size) for size in sizes), strict=True):
        _, _, data, _, ends, owner = several[0]
        cover = np.zeros(len(data) + 1, int)
        for size, (hashes, places, *_) in zip(sizes, several, strict=True):
            at = places[np.isin(hashes, grams[size])]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + size, -1)
        covered = np.concatenate([[0], np.cumsum(cover) > 0, [0]]).astype(int)
        edge = np.flatnonzero(np.diff(covered))
        runs: dict[int, list[bytes]] = {}
        for i, j in zip(edge[::2], edge[1::2], strict=True):
            w = int(np.searchsorted(ends, i, "right"))
            runs.setdefault(int(owner[w]), []).append(own_words(data, int(i), int(j), int(ends[w])))
        out += [b"  ".join(x) for x in runs.values()]
    return out


def telling_words(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> bytes:
    """The words of toxic texts whose beginnings set these apart, the most telling last (nearest to the window)."""
    words = [Counter(), Counter()]
    for label, texts in enumerate((ordinary, toxic)):
        for text in texts:
            words[label].update({x for w in text for x in (v.strip(EDGES) for v in w[:-TAIL].split()) if 3 <= len(x) <= 40})
    a, n = Counter(), Counter()
    for label in (0, 1):
        for w, c in words[label].items():
            n[w[:BEGINNING]] += c
            a[w[:BEGINNING]] += c * label
    total_a, total = sum(a.values()), sum(n.values())
    if not 0 < total_a < total:
        return b""
    share, found = total_a / total, []
    for w, c in words[1].items():
        k, m = a[w[:BEGINNING]], n[w[:BEGINNING]]
        p = k / m
        evidence = m * (p * np.log10(p / share) + (0.0 if p == 1 else (1 - p) * np.log10((1 - p) / (1 - share))))
        if p >= PURITY and p > share and evidence >= np.log10(len(n)):
            found.append((evidence, c, w))
    return b"".join(b" " + w + b" " for _, _, w in sorted(found))[-TOXIC_DICT_BYTES:]


def train(samples: list[bytes], size: int, **parameters: int) -> bytes:
    """Content of a dictionary: zstandard's choice from the samples."""
    import zstandard as z

    try:
        return z.train_dictionary(size, samples, **parameters).as_bytes()
    except (z.ZstdError, ValueError):  # too few samples to choose from: take them as they are
        return b"".join(samples)[-size:]


def dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and of the toxic dictionary from the windows of sample texts."""
    grams = {size: telling(toxic, ordinary, size) for size in GRAMS}
    return (train([w for t in ordinary for w in t], ORDINARY_DICT_BYTES) or b" " * PAD_BYTES,
            train(passages(toxic, grams), TOXIC_DICT_BYTES, k=32, d=6) + telling_words(toxic, ordinary))


def _fit(fit: tuple[pa.Scalar, ...], sample: pa.Table) -> pa.Table:
    """toxic, windows -> the dictionaries."""
    kind = lambda label: sample.filter(pc.equal(sample["toxic"], label))["windows"].to_pylist()
    ordinary, toxic = dictionaries(kind(1), kind(0))
    return pa.table({"fit": pa.array([fit[0].as_py()], pa.int32()), "ordinary": pa.array([ordinary], pa.binary()), "toxic": pa.array([toxic], pa.binary())})


def rarities(ordinary: np.ndarray) -> np.ndarray:
    """By saving: the log of the share of ordinary windows that save less; beyond the largest one seen rarity grows tenfold per 8 bytes.

    ``ordinary`` counts the windows by saving.
    """
    total = ordinary.sum()
    as_much = np.cumsum(ordinary[::-1])[::-1].astype(float)  # windows that save so much or more
    top = int(np.flatnonzero(ordinary)[-1]) if total else 0
    beyond = np.arange(LEVELS) - top
    as_much = np.where(beyond > 0, 10.0 ** (-beyond / 8), as_much)
    return np.log1p(-np.minimum(as_much / (total + 1), 1 - 1e-9))


def figures(counts: np.ndarray, rare: np.ndarray) -> tuple[float, float]:
    """How rare the largest saving is among as many ordinary windows (-log10), and the logarithm of the mean saving.

    ``counts``: a text's windows by saving.
    """
    n = int(counts.sum())
    top = int(np.flatnonzero(counts)[-1]) if n else 0
    if not top:
        return 0.0, 0.0
    return float(-np.log10(max(-np.expm1(n * rare[top]), 1e-12))), float(np.log1p(counts[2:] @ np.arange(2, LEVELS) / n))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients (features, intercept) of a ridge logistic regression by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 1e-2 * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def rising(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``calibrate``, but no figure may lower the score: one that would is left out."""
    for _ in range(x.shape[1]):
        curve = calibrate(x, y, weight)
        x = x * (curve[:-1] >= 0)
    return np.append(np.maximum(calibrate(x, y, weight)[:-1], 0.0), calibrate(x, y, weight)[-1])


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    fold = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).where(~fold(id_col))
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    n_toxic, n_ordinary = sizes.get(1, 0), sizes.get(0, 0)
    draw = lambda label, n: known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = draw(1, toxic_docs).union(draw(0, ordinary_docs))  # at most toxic_docs + ordinary_docs rows
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    texts = rows.where("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = (texts.select("doc_id", "text", "toxic").mapInArrow(_sampled, f"key long, doc_id {kind}, toxic int, text string")
              .groupBy("key", "toxic").agg(F.min_by("text", "doc_id").alias("text")).withColumn("half", F.pmod(F.xxhash64("key"), F.lit(2)).cast("int"))).cache()
    # Fit 2 takes all sample texts; fits 0 and 1 leave the half out that they are calibrated on. Each is at most
    # SAMPLE_WINDOWS windows of each drawn text.
    dealt = sample.select(F.array(F.lit(2), F.col("half")).alias("fits"), "toxic", "text").mapInArrow(_windows, "fits array<int>, toxic int, windows array<binary>")
    fitted = {r["fit"]: (bytes(r["ordinary"]), bytes(r["toxic"])) for r in dealt.select(F.explode("fits").alias("fit"), "toxic", "windows").groupBy("fit")
              .applyInArrow(_fit, "fit int, ordinary binary, toxic binary").collect()}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = [Distance(*fitted.get(1 - half, fitted[2])) for half in (0, 1)]
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                counts = [distance[half].counts(t).tolist() for half, t in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True)]
                yield pa.record_batch([part.column(1), pa.array(counts, pa.list_(pa.int64()))], names=["toxic", "counts"])

    got = sample.select("half", "toxic", "text").mapInArrow(counted, "toxic int, counts array<long>").toArrow() if fitted else None
    sample.unpersist()
    y = got["toxic"].to_numpy().astype(float) if fitted else np.zeros(0)
    if not 0 < y.sum() < len(y):
        return rows.select("doc_id", fold("doc_id").alias("held_out"), F.lit(n_toxic / max(1, n_toxic + n_ordinary)).alias("score"),
                           F.lit(int(n_toxic / max(1, n_toxic + n_ordinary) >= THRESHOLD)).alias("predicted"))
    counts = np.array(got["counts"].to_pylist())
    rare = rarities(counts[y == 0].sum(0))
    # The sample is drawn by class; weights bring back the shares among the labels.
    weight = np.where(y == 1, n_toxic / (y == 1).sum(), n_ordinary / (y == 0).sum())
    curve = rising(np.array([figures(c, rare) for c in counts]), y, weight / weight.mean())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(*fitted[2])
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                f = np.array([(*figures(distance.counts(t), rare), 1.0) for t in part.column(2).to_pylist()]).reshape(-1, 3)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(1 / (1 + np.exp(-np.clip(f @ curve, -50, 50))))],
                                      names=["doc_id", "held_out", "score"])

    scored = rows.select("doc_id", fold("doc_id").alias("held_out"), "text").mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
