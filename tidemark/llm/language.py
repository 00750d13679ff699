"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are summed as logarithms, one number per language:

* the text's likelihood under byte trigram models, tempered as trigrams overlap. Every declared
  language has a model, fitted on a hash sample of at most about ``SAMPLE`` of its rows (all of them where there are
  fewer); without any declaration one model ('und') is fitted on all rows alike;
* the declared language (a column, or the markup's lang attribute), by how often
  texts that read as L declare d;
* the suffix of the address, the same way;
* the host's prior: how often the host's other texts read as L, smoothed towards its
  domain and that towards all texts.

The last three come from grouped counts over all rows. Only trigrams of letters and spaces are read, so numbers, keys
and markup in a text say nothing. A text is rejected when it reads as none of the languages: it has no letters, or
less than ``LEAST_SHARE`` of its trigrams are usual ones in its best language. A text in letters beyond ASCII isn't
rejected for that if its letters repeat as those of languages do: its language is one that nobody declares, 'und'.

Defined results: null or empty text has no likelihood and is rejected, its language being the most
probable one by the other evidence; a text of an undeclared language has no probability and no text_language; a null declaration or address is no evidence; a row without a host has
the global prior; every input row gives one row, also when ids repeat; an empty
table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import raw, slices

SAMPLE = 20_000
BITS = 16
TEMPER = 3.0
HOST_WEIGHT, DOMAIN_WEIGHT = 20.0, 50.0
SMOOTHING = 0.5
#: A trigram this many nats below its language's own mean is an unusual one.
JUNK_NATS = 3.5
LEAST_SHARE = 0.3
LEAST_TRIGRAMS = 30
#: Chance that two letters of a text are equal: about 0.005 in Chinese, 0.02 in Korean, 0.04 to 0.1 in alphabets, 1e-4 in random Han.
COINCIDENCE = (0.002, 0.2)
LEAST_LETTERS = 45

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters (any byte beyond ASCII counts) and white space.
_TEXT = np.zeros(256, bool)
_TEXT[97:123] = _TEXT[128:] = _TEXT[32] = _TEXT[9:14] = True


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram of letters and spaces that lies in one text, and the texts' bounds among them."""
    d = _LOWER[data]
    plain = _TEXT[d]
    d = d.astype(np.uint32)
    if len(d) < 3:
        return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
    g = ((d[:-2] | d[1:-1] << np.uint32(8) | d[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    inside = plain[:-2] & plain[1:-1] & plain[2:]
    ends = at[1:-1]
    for back in (1, 2):
        cut = ends[(ends >= back) & (ends - back < len(g))] - back
        inside[cut] = False
    n = np.concatenate([[0], np.cumsum(inside)])
    return g[inside], n[np.minimum(at, len(g))]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label number, text -> label number, bucket, count."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        label = b.column(0).to_numpy(zero_copy_only=False)
        data, at = raw(b.column(1))
        for i, j in slices(at):
            g, bound = trigrams(data[at[i]:at[j]], at[i:j + 1] - at[i])
            of = np.repeat(label[i:j], np.diff(bound))
            for k in np.unique(of).tolist():
                total.setdefault(k, np.zeros(1 << BITS))
                total[k] += np.bincount(g[of == k], minlength=1 << BITS)
    for k, c in total.items():
        used = np.flatnonzero(c)
        yield pa.record_batch([pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(c[used])], names=["k", "g", "c"])


def primary(label: Column) -> Column:
    """The primary subtag of a language tag: 'en-GB' -> 'en'; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(label, r"^\s*([A-Za-z]{2,8})", 1)), F.lit(""))


def declared_in(html: Column) -> Column:
    """The lang attribute of the html element."""
    return F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)


def address_parts(address: Column) -> tuple[Column, Column, Column]:
    """(host, domain, suffix) of a URL or host name; a suffix only where the name has a dot."""
    host = F.nullif(F.lower(F.regexp_extract(address, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    label = F.split(host, r"\.")
    return host, F.array_join(F.slice(label, F.greatest(F.lit(1), F.size(label) - 1), 2), "."), F.when(F.size(label) > 1, F.element_at(label, -1))


def undeclared_language(text: bytes) -> bool:
    """Whether a text that no model knows is language all the same: mostly letters beyond ASCII that repeat as a language's do."""
    count = Counter(text.decode(errors="replace").lower())
    plain = sum(n for c, n in count.items() if "a" <= c <= "z")
    other = [n for c, n in count.items() if ord(c) > 127 and unicodedata.category(c)[0] in "LM"]
    total = sum(other)
    if total <= plain or total < LEAST_LETTERS:  # too few letters say nothing against it
        return total > plain
    return COINCIDENCE[0] <= sum(n * (n - 1) for n in other) / (total * (total - 1)) <= COINCIDENCE[1]


def number_of(languages: list[str]) -> Column:
    """The declared language's place in ``languages``, null if it isn't there."""
    return F.nullif(F.array_position(F.array(*map(F.lit, languages)), F.col("declared")), F.lit(0)).cast("int") - 1


def fit(rows: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram log probabilities (language x bucket), and the least one of a usual trigram per language."""
    got = (rows.select(number_of(languages).alias("k"), "text").where("k is not null").mapInArrow(_count, "k int, g int, c double")
           .groupBy("k", "g").agg(F.sum("c").alias("c")).toArrow())  # at most languages x buckets rows
    c = np.full((len(languages), 1 << BITS), SMOOTHING)
    c[got["k"].to_numpy(), got["g"].to_numpy()] += got["c"].to_numpy()
    log_p, least = np.empty(c.shape, np.float32), np.empty(len(languages))
    for k in range(len(languages)):
        p = c[k] / c[k].sum()
        seen = np.where(c[k] > SMOOTHING, p, 0)
        mean = (seen * np.log(p)).sum() / max(seen.sum(), 1e-12)
        # A usual one isn't below the middle between a language's own mean and trigrams that it never showed.
        log_p[k], least[k] = np.log(p), max(mean - JUNK_NATS, (mean + np.log(p).min()) / 2)
    return log_p, least


def _likelihoods(held, languages: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p, least = held.value
        for b in batches:
            data, at = raw(b.column(b.num_columns - 1))
            for i, j in slices(at):
                g, bound = trigrams(data[at[i]:at[j]], at[i:j + 1] - at[i])
                n = np.diff(bound)
                out, usual = np.zeros((j - i, languages)), np.zeros(j - i, np.int64)
                some = np.flatnonzero(n)
                if len(some):
                    cut, most = bound[:-1][some], np.full(len(some), -np.inf)
                    for k in range(languages):  # one language at a time, so that memory doesn't grow with their number
                        each = log_p[k][g]
                        total = np.add.reduceat(each, cut, dtype=np.float64)
                        better = total > most
                        out[some, k] = total
                        if better.any():
                            most[better] = total[better]
                            usual[some[better]] = np.add.reduceat(each >= least[k], cut, dtype=np.int64)[better]
                strange = [bool(n[t] >= LEAST_TRIGRAMS and usual[t] < LEAST_SHARE * n[t] and undeclared_language(data[at[i + t]:at[i + t + 1]].tobytes())) for t in range(j - i)]
                yield pa.record_batch([*(b.column(c).slice(i, j - i) for c in range(b.num_columns - 1)), pa.array(n.astype(np.int64)), pa.array(usual), pa.array(strange, pa.bool_()),
                                       pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * languages, pa.int32()), pa.array(out.ravel()))],
                                      names=[*b.schema.names[:-1], "n", "usual", "strange", "t"])
    return score


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str | Column | None = "lang",
             address_col: str | Column | None = "source", sample: int = SAMPLE) -> DataFrame:
    """doc_id, language, probability, text_language, declared, kept of every row."""
    spark = docs.sparkSession
    s = Scratch(spark, "language")
    column = lambda c: F.lit(None).cast("string") if c is None else F.col(c).cast("string") if isinstance(c, str) else c
    host, domain, suffix = address_parts(column(address_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), primary(column(declared_col)).alias("declared"), host.alias("host"),
                       domain.alias("domain"), suffix.alias("suffix"), F.col(text_col).cast("string").alias("text"))

    # Every declared language gets a model; the rows it is fitted on are drawn language by language.
    found = {r["declared"]: r["count"] for r in rows.where("text is not null and declared is not null").groupBy("declared").count().collect()}
    languages = sorted(found) or ["und"]
    labelled = rows if found else rows.withColumn("declared", F.lit("und"))
    sizes = [found[x] for x in languages] if found else [rows.where("text is not null").count()]
    steps = F.array(*(F.lit(max(1, math.ceil(n / sample))).cast("long") for n in sizes))
    sampled = labelled.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.get(steps, number_of(languages))) == 0)
    k = len(languages)
    log_p, least = fit(sampled, languages)
    held = spark.sparkContext.broadcast((log_p, least.astype(np.float32)))

    base = ["doc_id", "declared", "host", "domain", "suffix"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in base) + ", n long, usual long, strange boolean, t array<double>"
    scored = rows.select(*base, "text").mapInArrow(_likelihoods(held, k), schema)
    best = F.when((F.col("n") > 0) & ~F.col("strange"), F.array_position("t", F.array_max("t")).cast("int") - 1)
    scored = s.save(scored.withColumn("best", best), "scored")

    # Grouped counts of what texts read as, over all rows: by host, domain, declaration and suffix.
    ones = [F.sum((F.col("best") == i).cast("double")).alias(f"c{i}") for i in range(k)]
    counts = lambda by: s.save(scored.where(f"best is not null and {by} is not null").groupBy(by).agg(F.array(*ones).alias(f"{by}_n")), by)
    by_host, by_domain, by_declared, by_suffix = (counts(c) for c in ("host", "domain", "declared", "suffix"))
    total = scored.where("best is not null").agg(F.array(*ones)).first()[0] if k else []
    total = np.array([x or 0.0 for x in total])
    prior = (total + 1) / (total.sum() + k)

    all_rows = scored
    for by, table in (("host", by_host), ("domain", by_domain), ("declared", by_declared), ("suffix", by_suffix)):
        all_rows = all_rows.join(table, by, "left")
    zero = F.array(*[F.lit(0.0)] * k)
    own = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == F.col("best"), 1.0).otherwise(0.0))
    # Without the row's own vote.
    others = lambda c: F.zip_with(F.coalesce(F.col(c), zero), own, lambda a, b: F.greatest(a - b, F.lit(0.0)))
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    lift = lambda n, weight, base: F.transform(base, lambda p, i: (F.get(n, i) + weight * p) / (add(n) + weight))
    votes = all_rows.withColumn("_h", others("host_n")).withColumn("_d", others("domain_n"))
    votes = votes.withColumn("_prior", lift(F.col("_d"), DOMAIN_WEIGHT, F.array(*[F.lit(float(p)) for p in prior])))
    votes = votes.withColumn("_prior", lift(F.col("_h"), HOST_WEIGHT, F.col("_prior")))
    seen = F.array(*[F.lit(float(x)) for x in total])
    # P(d | L), smoothed; the row's own vote stays out here as well.
    given = lambda c: F.when(F.col(c).isNotNull(), F.transform(others(c), lambda n, i: F.log((n + SMOOTHING) / (F.get(seen, i) + SMOOTHING * (k + 1))))).otherwise(zero)
    fused = F.zip_with(F.zip_with(F.transform(F.col("t"), lambda x: x / TEMPER), F.transform("_prior", lambda p: F.log(p)), lambda a, b: a + b),
                       F.zip_with(given("declared_n"), given("suffix_n"), lambda a, b: a + b), lambda a, b: a + b)
    out = votes.withColumn("_f", fused).withColumn("_top", F.array_max("_f"))
    names = F.array(*[F.lit(x) for x in languages])
    at = (F.array_position("_f", F.col("_top")) - 1).cast("int")
    mean = F.get(F.col("t"), F.col("best")) / F.col("n")
    reads = (F.col("n") > 0) & (F.col("strange") | (F.col("n") < LEAST_TRIGRAMS) | (F.col("usual") >= LEAST_SHARE * F.col("n")))
    known = ~F.col("strange")
    return out.select("doc_id", F.when(known, F.get(names, at)).otherwise("und").alias("language"),
                      F.when(known, 1 / add(F.transform("_f", lambda x: F.exp(x - F.col("_top"))))).alias("probability"),
                      F.get(names, F.col("best")).alias("text_language"), "declared", mean.alias("mean_nats"), reads.alias("kept"))
