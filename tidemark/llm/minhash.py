"""MinHash near-duplicates: many universal hash minima, banding, verification, components.

Stages, each a Spark job over all rows:

1. ``profile``: one pass over the texts gives the exact set size, a key of the word
   sequence and 128 minima, kept as 32 band keys of 4 minima and one byte of each minimum.
   With 32 bands a pair of similarity 0.75 is missed with probability 5e-6.
2. Texts with equal word sequences become one class; only its smallest id goes on.
3. In every band bucket the smallest id is paired with the others (a star, never all
   pairs). Pairs that the set sizes or the signature estimate rule out are dropped, the
   rest is confirmed on the full shingle sets with integer arithmetic.
4. Buckets whose members are not yet in one component are joined to groups, and a group's
   components are compared block by block, each pair of blocks a task of its own that
   gives a spanning forest of its links. So no link that would join two components is lost, and no
   pairs are written out.

Defined results: null or empty text has no shingles and links with nothing; fewer than
five words make one shingle; rows that repeat an id or a null id are kept as they are
(null ids link with nothing); an empty table gives an empty result. Only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .ids import maybe_in
from .scratch import Scratch
from .words import mix, sequence_key, shingles, word_slices

BANDS, ROWS = 32, 4
N_HASH = BANDS * ROWS
#: Estimates below this (out of N_HASH equal bytes) are ruled out: 4.9 standard deviations under 0.75.
LEAST_EQUAL = 72
#: A block of documents that may lie in one task.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20

_rng = np.random.default_rng(77_001)
_A = (_rng.integers(1, 2**32, N_HASH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 2**32, N_HASH, dtype=np.uint64).astype(np.uint32)
_BAND = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)
_STEP = 4096

PROFILE = "doc_id long, n_shingles long, k1 long, k2 long, sig binary, bands array<long>"
_PROFILE = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                      ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Least value of each universal hash a*x+b (mod 2^32) over every non-empty set."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    out = np.full((len(sets), N_HASH), 0xFFFFFFFF, np.uint32)
    i = 0
    while i < len(sets):  # blocks that stay in the cache
        j = max(i + 1, int(np.searchsorted(first, first[i] + _STEP, "right")) - 1)
        for lo in range(first[i], first[j], 16 * _STEP):
            hi = min(first[j], lo + 16 * _STEP)
            cut = np.maximum(first[i:j] - lo, 0)  # one long set, or several short ones in one block
            part = x[lo:hi]
            for k in range(N_HASH):
                got = np.minimum.reduceat(part * _A[k] + _B[k], cut)
                np.minimum(out[i:j, k], got, out=out[i:j, k])
        i = j
    return out


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(0)
        for i, j, w in word_slices(b.column(1)):
            sets = [np.unique(shingles(w.text(k))) for k in range(j - i)]
            some = [k for k, s in enumerate(sets) if len(s)]
            keys = [sequence_key(w.text(k)) if len(sets[k]) else (None, None) for k in range(j - i)]
            sig: list = [None] * (j - i)
            bands: list = [None] * (j - i)
            if some:
                least = minima([sets[k] for k in some])
                band = np.repeat(_BAND[None, :], len(some), 0)
                for r in range(ROWS):
                    band = mix(band ^ least[:, r::ROWS].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                low, band = (least & np.uint32(255)).astype(np.uint8), band.view(np.int64)
                for row, k in enumerate(some):
                    sig[k], bands[k] = low[row].tobytes(), band[row]
            yield pa.record_batch([ids.slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                                   pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                                   pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema=_PROFILE)


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_profile, PROFILE)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """u, v, nu, nv, su, sv -> the pairs that set sizes and signatures allow."""
    for b in batches:
        if not b.num_rows:
            continue
        nu, nv = (b.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
        su, sv = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, N_HASH) for c in (4, 5))
        keep = (100 * np.minimum(nu, nv) >= 75 * np.maximum(nu, nv)) & ((su == sv).sum(1) >= LEAST_EQUAL)
        yield pa.record_batch([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep))], names=["u", "v"])


def _sets(texts: pa.Array) -> list[np.ndarray]:
    return [np.unique(shingles(w.text(k))) for i, j, w in word_slices(texts) for k in range(j - i)]


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """u, v, tu, tv -> the pairs with 100 * intersection >= 75 * union on full sets."""
    held: OrderedDict[int, np.ndarray] = OrderedDict()  # pivots come in runs; a few suffice
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            us, mine = part.column(0).to_pylist(), _sets(part.column(3))
            new = {u: r for r, u in enumerate(us) if u not in held}
            got = dict(zip(new, _sets(part.column(2).take(pa.array(list(new.values()), pa.int64()))), strict=True)) if new else {}
            keep = []
            for u, s in zip(us, mine, strict=True):
                t = got.get(u)
                if t is None:
                    t = held[u]
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= 75 * (len(s) + len(t) - both))
            held.update(got)
            while len(held) > 64:
                held.popitem(last=False)
            yield pa.record_batch([part.column(0).filter(pa.array(keep)), part.column(1).filter(pa.array(keep))], names=["u", "v"])


def confirmed(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """The (u, v) of ``pairs`` that are linked, by signature and then by full sets."""
    side = lambda n: reps.select(F.col("doc_id").alias(n), F.col("n_shingles").alias(f"n{n}"), F.col("sig").alias(f"s{n}"))
    likely = (pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "nu", "nv", "su", "sv")
              .mapInArrow(_likely, "u long, v long"))
    text = lambda n: texts.select(F.col("doc_id").alias(n), F.col("text").alias(f"t{n}")).hint("merge")
    return (likely.join(text("v"), "v").join(text("u"), "u").select("u", "v", "tu", "tv")
            .mapInArrow(_confirm, "u long, v long"))


def _block_pair(t: pa.Table) -> pa.Table:
    """Documents of two blocks of a group (or of one) -> links that join components: a spanning forest of them."""
    first, doc, comp = (t[c].to_numpy() for c in ("first", "doc_id", "c"))
    sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()]
    sig, size = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, N_HASH), np.array([len(x) for x in sets])
    left, right = np.flatnonzero(first), np.flatnonzero(~first)
    one = not len(right)
    right = left if one else right
    pairs, equal = [], []
    for i in left:
        n = (sig[i] == sig[right]).sum(1)
        ok = (n >= LEAST_EQUAL) & (comp[i] != comp[right]) & (100 * np.minimum(size[i], size[right]) >= 75 * np.maximum(size[i], size[right]))
        if one:
            ok &= right > i
        pairs.append(np.stack([np.full(int(ok.sum()), i), right[ok]], 1))
        equal.append(n[ok])
    root = {c: c for c in comp.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    us, vs = [], []
    order = np.argsort(-np.concatenate(equal), kind="stable") if equal else []
    for i, j in (np.concatenate(pairs)[order].tolist() if pairs else ()):
        a, b = find(comp[i]), find(comp[j])
        if a != b:
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= 75 * (size[i] + size[j] - both):
                root[max(a, b)] = min(a, b)
                us.append(doc[i])
                vs.append(doc[j])
    return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            yield pa.record_batch([part.column(0), pa.array([x.tobytes() for x in _sets(part.column(1))], pa.binary())], names=["doc_id", "shingles"])


def links_left(members: DataFrame, comps: DataFrame, reps: DataFrame, texts: DataFrame, s: Scratch) -> DataFrame:
    """Links between different components within the buckets of ``members`` (h, u = its first member, doc_id).

    Buckets with several components are joined to groups, and a group is dealt out to blocks of at most about
    ``BLOCK`` documents. Its largest component is compared with the others only, block by block.
    """
    own = (members.join(comps.select(F.col("node").alias("doc_id"), F.col("component").alias("c")), "doc_id", "left")
           .select("h", "u", "doc_id", F.coalesce("c", "doc_id").alias("c")))
    mixed = own.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("h")
    left = s.save(own.join(mixed, "h").select("u", "doc_id", "c").distinct(), "mixed")
    groups = components(left.select("u", F.col("doc_id").alias("v")), s)
    docs = (left.select("doc_id", "c").distinct().join(groups.select(F.col("node").alias("doc_id"), F.col("component").alias("g")), "doc_id", "left")
            .withColumn("g", F.coalesce("g", "doc_id")).join(reps.select("doc_id", "n_shingles", "sig"), "doc_id"))
    docs = s.save(docs, "mixed")
    blocks_for = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).alias("n")
    largest = (docs.groupBy("g", "c").agg(F.count("*").alias("k")).groupBy("g")
               .agg(F.max_by("c", F.struct("k", "c")).alias("main"), F.count("*").alias("comps")).where("comps > 1").drop("comps"))
    docs = docs.join(largest, "g").withColumn("main", F.col("c") == F.col("main"))
    counts = (docs.groupBy("g", "main").agg(blocks_for).groupBy("g")
              .agg(F.max(F.when(F.col("main"), F.col("n"))).alias("n_main"), F.max(F.when(~F.col("main"), F.col("n"))).alias("n_rest")))
    # Blocks 0 .. n_rest - 1 hold the other components, those from n_rest on the largest; pairs (i, j) have i < n_rest and i <= j.
    docs = docs.join(counts, "g").withColumn("block", F.when(F.col("main"), F.col("n_rest") + F.pmod(F.xxhash64("doc_id"), F.col("n_main")))
                                             .otherwise(F.pmod(F.xxhash64("doc_id"), F.col("n_rest"))))
    sets = s.save(texts.join(docs.select("doc_id"), "doc_id", "left_semi").mapInArrow(_shingle_sets, "doc_id long, shingles binary"), "sets")
    ends = F.when(F.col("main"), F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_rest") - 1), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))) \
        .otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_rest") + F.col("n_main") - 1),
                               lambda x: F.struct(F.least(x, "block").alias("i"), F.greatest(x, "block").alias("j"))))
    dealt = (docs.withColumn("x", F.explode(ends)).select("g", "x.i", "x.j", (F.col("block") == F.col("x.i")).alias("first"), "doc_id", "c", "sig")
             .join(sets, "doc_id"))
    return dealt.groupBy("g", "i", "j").applyInArrow(_block_pair, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    s = Scratch(docs.sparkSession, "minhash")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prof = s.save(profile(docs, id_col, text_col), "profile")

    known = prof.where("k1 is not null and doc_id is not null").select("doc_id", "k1", "k2")
    classes = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = s.save(known.join(classes, ["k1", "k2"]).where("doc_id <> rep").select("doc_id", "rep").distinct(), "copies")
    reps = (prof.where("k1 is not null and doc_id is not null")
            .join(copies.select("doc_id"), "doc_id", "left_anti").dropDuplicates(["doc_id"]))
    reps = s.save(reps.select("doc_id", "n_shingles", "sig", "bands"), "reps")

    rows = reps.select("doc_id", F.explode("bands").alias("h"))
    shared = rows.groupBy("h").agg(F.min("doc_id").alias("u"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = s.save(rows.join(shared, "h").select("h", "u", "doc_id"), "members")
    pairs = members.where("u <> doc_id").select("u", F.col("doc_id").alias("v")).distinct()
    # Only texts that some comparison may need move.
    texts = s.save(texts.where(maybe_in(members.select("doc_id"), "doc_id")("doc_id")).dropDuplicates(["doc_id"]), "texts")
    links = s.save(confirmed(pairs, reps, texts), "confirmed")
    comps = components(links, s)

    links = s.save(links.union(links_left(members, comps, reps, texts, s)), "confirmed")
    comps = components(links, s)

    same = copies.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left") \
        .select("doc_id", F.coalesce("component", "rep").alias("component"))
    linked = same.union(comps.select(F.col("node").alias("doc_id"), "component"))
    return (prof.select("doc_id", "n_shingles").join(linked, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.expr("doc_id <=> component_id")))
