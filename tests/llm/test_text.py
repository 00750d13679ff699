"""Words, extraction, language, scoring, decontamination, toxicity, archives and packing: plain versions and edge cases."""

from __future__ import annotations

import hashlib
import html
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidemark.llm import archives, decontamination, extraction, language, lattice, packing, toxicity
from tidemark.llm.scratch import Scratch
from tidemark.llm.words import shingles, word_slices

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
EXTRA = "doc_id long, text string, lang string, source string, score string, n long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_words(texts):
    return [[w.data[s:e].tobytes().decode() for s, e in zip(w.start[w.first[k]:w.first[k + 1]], w.end[w.first[k]:w.first[k + 1]], strict=True)]
            for i, j, w in word_slices(pa.array(texts, pa.string())) for k in range(j - i)]


def test_words_are_those_of_the_pattern():
    texts = ["Hello  World\tfoo\x0bBAR", None, "", " x ", "Éa éa É", "a b \x1c c", "x" * 5000 + " y", "ab" * 3_000_000 + " end"]
    assert plain_words(texts) == [WORD.findall(lower(t)) for t in texts]
    sliced = pa.array(["skip", *texts, "skip"], pa.string()).slice(1, len(texts))
    assert [len(x) for x in plain_words(texts)] == [len(w.text(k)) for i, j, w in word_slices(sliced) for k in range(j - i)]


def test_equal_words_have_equal_hashes_and_others_not():
    rng = random.Random(0)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 30))) for _ in range(5000)]
    got = [w.hash for _, _, w in word_slices(pa.array([" ".join(words)]))][0]
    assert len(set(zip(words, got.tolist(), strict=True))) == len(set(words)) == len(set(got.tolist()))
    assert [len(shingles(got[:n])) for n in (0, 1, 4, 5, 6)] == [0, 1, 1, 1, 2]


# Extraction

def test_blocks_equal_a_plain_reading_of_the_given_pages(spark):
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        got = [t for t, kind in extraction.blocks_of(r["html"]) if kind == extraction.DECLARED]
        assert got == [x for x in want if x]


@pytest.mark.parametrize(("page", "want"), [
    (None, []), ("", []), ("<", [("<", 1)]), ("a &lt; b &am", [("a < b &am", 1)]), ("<p>x<p>y", [("x", 1), ("y", 1)]),
    ("<a title='x>y'>t</a>", [("t", 1)]), ("<script>'<p>no</p>'</script>yes", [("yes", 1)]), ("<style>p{", []), ("<!-- <p>no --> yes <!-- cut", [("yes", 1)]),
    ("<nav><ul><li>menu<article><p>text</article>", [("menu", 0), ("text", 2)]),
    ("<article><header><h1>T</h1>by</header><p>a</p><div class='share-links'>s</div><section id=comments>c</section></article><footer>f",
     [("T", 2), ("by", 0), ("a", 2), ("s", 0), ("c", 0), ("f", 0)]),
    ("<body class='has-sidebar'><div hidden>h</div><div role=navigation>n</div><div style='display: none'>d</div><p>ok", [("h", 0), ("n", 0), ("d", 0), ("ok", 1)]),
    ("<div>a<br>b&nbsp;&eacute;<i>c</i></div>", [("a b éc", 1)]), ("</p></div>x", [("x", 1)]), ("<table><tr><td>a<td>b<tr><td>c</table>", [("a b", 1), ("c", 1)]),
])
def test_blocks(page, want):
    assert extraction.blocks_of(page) == want


def test_repeated_tokens_equal_brute_force():
    rng = np.random.default_rng(1)
    for trial in range(20):
        pages = [rng.integers(0, 4, rng.integers(3, 40)) for _ in range(6)]
        for k in range(0, 6, 2):
            pages[k] = np.concatenate([pages[k], np.arange(100 + trial, 112 + trial), pages[k][:2]])
        stream = np.concatenate([np.append(p, -1 - k) for k, p in enumerate(pages)])
        owner = np.concatenate([np.full(len(p) + 1, k) for k, p in enumerate(pages)])
        grams: dict[tuple, set] = {}
        for i in range(len(stream) - 7):
            grams.setdefault(tuple(stream[i:i + 8]), set()).add(int(owner[i]))
        want = np.zeros(len(stream), bool)
        for i in range(len(stream) - 7):
            if len(grams[tuple(stream[i:i + 8])]) >= 3:
                want[i:i + 8] = True
        assert (extraction.repeated(stream, owner)[want]).all()
        assert not extraction.repeated(stream, owner, min_pages=7).any()


def test_hosts_tell_boilerplate_where_markup_does_not(spark):
    rng = random.Random(2)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    notice = say(12)
    own = [say(30) for _ in range(5)]
    rows = [(k, f"http://h.example/{k}", f"<div>{notice}</div><div>{own[k]}</div>", "x") for k in range(5)]
    rows += [(10, None, None, "x"), (11, "http://h.example/e", "", "x"), (12, "odd", "<p>lone &amp; kept", "x"), (13, "http://h.example/a", f"<article>{notice}</article>", "x"),
             (0, "http://h.example/0", f"<div>{notice}</div><div>{own[0]}</div>", "x")]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    assert [by[k] for k in range(5)] == own and by[10] == by[11] == "" and by[12] == "lone & kept" and by[13] == notice
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# Language

def test_language_of_held_out_texts_without_declaration(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs.selectExpr("doc_id", "text", "source", "case when doc_id % 4 = 1 then null else lang end as lang")).collect()
    true = {r["doc_id"]: r["lang"] for r in docs.collect()}
    blind = [r for r in got if r["declared"] is None]
    assert len(got) == len(true) and sum(r["language"] == true[r["doc_id"]] for r in blind) >= 0.97 * len(blind)
    assert all(r["kept"] for r in got)


def test_language_evidence_and_edge_cases(spark):
    rng = random.Random(3)
    en, fr = "the of and to in that with this from".split(), "le la les des une dans pour avec être".split()
    rows = [(i, " ".join(rng.choice(en if i % 2 else fr) for _ in range(40)), "EN-gb" if i % 2 else "fr", "http://a.example.com/x" if i % 2 else "b.example.fr", "x", 1) for i in range(80)]
    noise = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300))
    rows += [(100, None, "fr", "b.example.fr", "x", 1), (101, "", None, None, "x", 1), (102, noise, "en", "a.example.com", "x", 1), (103, "zq", None, "http://b.example.fr/y", "x", 1),
             (104, "the of and to in that with this from the", "fr", "b.example.fr", "x", 1), (104, "the of and to in that with this from the", "fr", "b.example.fr", "x", 1)]
    out = language.identify(spark.createDataFrame(rows, EXTRA)).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["language"] == ("en" if i % 2 else "fr") and by[i]["kept"] for i in range(80))
    assert not by[100]["kept"] and by[100]["language"] == "fr" and not by[101]["kept"] and not by[102]["kept"]
    assert by[103]["language"] == "fr" and by[104]["language"] == "en"
    assert language.identify(spark.createDataFrame([], EXTRA)).count() == 0


def test_rare_and_undeclared_languages_are_kept(spark):
    rng = random.Random(4)
    en, el = "the of and to in that with this from".split(), "και το να του της με για που δεν από είναι στην".split()
    say = lambda words, n=60: " ".join(rng.choice(words) for _ in range(n))
    tags = [f"{a}{b}" for a in "jq" for b in "abcdefghijklmnopqrst"]
    own = {t: ["".join(rng.choice("bcdfghklmnprstv") + rng.choice("aeiou") for _ in range(3)) + t for _ in range(12)] for t in tags}
    rows = [(i, say(en), "en", "http://a.example.com/x", "x", 1) for i in range(3000)]
    rows += [(4000 + i, say(el), "el", None, "x", 1) for i in range(3)]
    rows += [(5000 + 10 * k + i, say(own[t]), t, None, "x", 1) for k, t in enumerate(tags) for i in range(8)]
    rows += [(6000, say("и в не на что как это его она они был было для".split()), None, None, "x", 1),
             (6001, "".join(rng.choices([chr(0x4E00 + 7 * i) for i in range(600)], [1 / (i + 1) for i in range(600)], k=300)), None, None, "x", 1),
             (6002, "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300)), None, None, "x", 1)]
    by = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows, EXTRA)).collect()}
    assert all(by[r[0]]["kept"] and by[r[0]]["language"] == r[2] for r in rows if r[0] < 6000)
    assert all(by[k]["kept"] and by[k]["language"] == "und" and by[k]["text_language"] is None for k in (6000, 6001)) and not by[6002]["kept"]
    nobody = language.identify(spark.createDataFrame([(r[0], r[1], None, None, "x", 1) for r in rows[:200]], EXTRA)).collect()
    assert all(r["kept"] and r["language"] == "und" for r in nobody)


def test_a_notice_of_the_host_goes_from_articles_that_do_not_mark_it(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    notice, quoted, own = say(12), say(15), [say(30) for _ in range(20)]
    rows = [(k, "http://h.example/", f"<article><p>{own[k]}</p><p>{quoted}</p><p>{notice.upper()}</p></article><div class=notice>{notice}</div>") for k in range(4)]
    rows += [(4, "http://h.example/", f"<article><p>{notice}</p></article>"), (5, "http://h.example/", f"<article><p>{own[5]}</p><p>{notice} more</p></article>"),
             (6, "http://other.example/", f"<article><p>{own[6]}</p><p>{notice}</p></article>")]
    rows += [(k, "http://advert.example/", f"<article><p>{own[k]}</p></article><div class=ad>{notice}</div>") for k in range(7, 16)]
    rows += [(16, "http://advert.example/", f"<article><p>{own[16]}</p><p>{notice}</p></article>")]
    by = {r["page_id"]: r["text"] for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(by[k] == f"{own[k]}\n\n{quoted}" for k in range(4))  # the host's notice goes, what articles repeat stays
    assert by[4] == notice and by[5] == f"{own[5]}\n\n{notice} more"  # but not if nothing else is there, and only whole blocks
    assert by[6] == f"{own[6]}\n\n{notice}" and by[16] == f"{own[16]}\n\n{notice}"  # a paragraph of one article stays, an advert elsewhere or not
    assert all(by[k] == own[k] for k in range(7, 16))


@pytest.mark.parametrize("shard", [1 << 20, 2000, 300])
def test_texts_do_not_depend_on_the_number_of_shards(shard, spark, monkeypatch):
    monkeypatch.setattr(extraction, "SHARD_TOKENS", shard)
    rng = random.Random(8)
    say = lambda n: " ".join(f"W{rng.randrange(10**6)}" for _ in range(n))
    few, pair, usual, quoted = say(14), say(14), say(12), say(12)
    own = [say(20) for _ in range(120)]
    extra = lambda k: few if k % 40 == 0 else pair if k in (1, 2) else ""
    rows = [(k, "http://h.example/", f"<div>{extra(k)}</div><div>{own[k]}</div>") for k in range(100)]   # three pages hold few, two hold pair
    rows += [(100 + k, "http://h.example/", f"<article><p>{own[k]}</p><p>{usual}</p><p>{quoted if k < 104 else ''}</p></article><nav>{usual} {k}</nav><div class=ad>{quoted}</div>")
             for k in range(100, 120)]
    rows += [(300, "http://small.example/", f"<div>{few}</div>")]
    by = {r["page_id"]: r["text"] for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(by) == len(rows) and by[300] == few
    assert all(by[k] == (f"{pair}\n\n{own[k]}" if k in (1, 2) else own[k]) for k in range(100))
    assert all(by[100 + k] == (f"{own[k]}\n\n{quoted}" if k < 104 else own[k]) for k in range(100, 120))   # what few articles quote stays


def test_covered_tokens_are_those_of_repeated_sequences_alone():
    rng = np.random.default_rng(6)
    for _ in range(20):
        tail = rng.integers(1000, 2000, 6)   # two of the three pages go on alike
        pages = [np.concatenate([rng.integers(0, 4, 12), np.arange(100, 109), tail if k < 2 else tail[:0], rng.integers(0, 4, 12)]) for k in range(3)]
        stream = np.concatenate([np.append(p, -1 - k) for k, p in enumerate(pages)])
        owner = np.concatenate([np.full(len(p) + 1, k) for k, p in enumerate(pages)])
        grams: dict[tuple, set] = {}
        for i in range(len(stream) - 7):
            grams.setdefault(tuple(stream[i:i + 8].tolist()), set()).add(int(owner[i]))
        want = np.zeros(len(stream), bool)
        for i in range(len(stream) - 7):
            if len(grams[tuple(stream[i:i + 8].tolist())]) >= 3:
                want[i:i + 8] = True
        assert (extraction.repeated(stream, owner) == want).all()


# Scoring

def test_lattice_sums_all_segmentations_and_expectations():
    pieces = [b" ", b" a", b"a", b"b", b"ab", b"aba", b" ab", b"ba"]
    rng = np.random.default_rng(0)
    weight = np.log(rng.dirichlet(np.ones(len(pieces) + 256), 2).T)
    lat = lattice.Lattice(pieces, weight)
    words = [b"ab", b"abab", b"x", b"aba", b"b"]
    score = lat.score(*lattice._spans(words))
    use = np.zeros_like(weight)
    for k, w in enumerate(words):
        full, total, ways = b" " + w, np.zeros(2), []
        for cuts in itertools.product((0, 1), repeat=len(full) - 1):
            bounds = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(full)]
            parts = [full[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            # A part of one byte may be the piece or the byte.
            options = [[*([pieces.index(p)] if p in pieces else []), *([len(pieces) + p[0]] if len(p) == 1 else [])] for p in parts]
            for way in itertools.product(*options):
                ways.append(way)
                total += np.exp(weight[list(way)].sum(0))
        assert np.allclose(score[k], np.log(total))
        for way in ways:
            for p in way:
                use[p] += np.exp(weight[list(way)].sum(0)) / total
    assert np.allclose(lat.expected(*lattice._spans(words), np.ones((5, 2))), use)


def test_base_score_and_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    got = {r["doc_id"]: r for r in lattice.score_texts(docs, PIECES, heavy=2000, rounds=1).collect()}
    count: Counter = Counter()
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            count.update([*WORD.findall(lower(r["text"])), None])
    n, v = sum(count.values()), len(count)
    for r in rows:
        tokens, g = [*WORD.findall(lower(r["text"])), None], got[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(tokens), sum(t in count for t in tokens), n)
        assert math.isclose(g["base_score"], sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) and g["score"] < 0
    train = [g for g in got.values() if not g["held_out"]]
    assert sum(g["score"] for g in train) > sum(g["base_score"] for g in train)


def test_every_language_has_its_own_weights_and_the_score_is_their_mixture(spark):
    rng, langs = random.Random(12), ["l0", "l1", "l2", "l3", None, "l5", "l6", "l7", "l8"]
    rows = [(i, " ".join(rng.choice("abcdefgh"[k % 8] + "aeiou") + rng.choice("xyz") + str(k) * rng.randrange(3) for _ in range(rng.randrange(1, 30))), lang)
            for k, lang in enumerate(langs) for i in range(100 * k, 100 * k + 20 - k)]
    got = {r["doc_id"]: r["score"] for r in lattice.score_texts(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES, rounds=0).collect()}
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    words = sorted({w for r in rows for w in r[1].split()})
    count = np.array([[sum(r[1].split().count(w) for r in train if r[2] == g) for g in langs] for w in words], float)
    ends = np.array([sum(r[2] == g for r in train) for g in langs], float)
    pieces, spans = lattice.vocabulary(PIECES), lattice._spans([w.encode() for w in words])
    use = lattice.Lattice(pieces, lattice.start_weights(len(pieces), len(langs))).expected(*spans, (count > 0).astype(float)) + lattice.SMOOTHING
    kinds = (count > 0).sum(0) + 1
    mass = count.sum(0) + ends + kinds
    word = np.log(np.exp(lattice.Lattice(pieces, np.log(use / use.sum(0))).score(*spans)) * kinds / mass + count / mass)
    for i, text, _ in rows:
        logs = word[[words.index(w) for w in text.split()]].sum(0) + np.log(ends / mass) + np.log((ends + 1) / (ends.sum() + len(langs)))
        assert math.isclose(got[i], np.logaddexp.reduce(logs) / math.log(10), rel_tol=1e-9)


def test_every_round_re_estimates_from_every_training_word(spark, monkeypatch):
    rows = [(i, " ".join(["often"] * 5 + [f"rare{i}", f"seldom{i % 9}"]), "en") for i in range(60)]
    want = {w for i, text, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in text.split()}
    seen, plain = [], lattice.re_estimate

    def noted(spark, words, *rest):
        seen.append({bytes(r["word"]).decode() for r in words.select("word").collect()})
        return plain(spark, words, *rest)

    monkeypatch.setattr(lattice, "re_estimate", noted)
    out = lattice.score_texts(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES, heavy=3, rounds=2).collect()
    assert len(out) == 60 and seen == [want] * 3


def test_scoring_edge_cases(spark):
    rows = [(1, None, "en", None, "x", 1), (2, "", None, None, "x", 1), (3, "a b", "en", None, "x", 1), (3, "a b", "en", None, "x", 1), (None, "c", "fr", None, "x", 1), (6, "y" * 3000, "en", None, "x", 1)]
    out = lattice.score_texts(spark.createDataFrame(rows, EXTRA), PIECES, rounds=1).collect()
    assert len(out) == len(rows) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == 1 and by[3]["n_tokens"] == 3 and not by[None]["held_out"]
    assert lattice.score_texts(spark.createDataFrame([], EXTRA), PIECES).count() == 0


# Decontamination

def test_common_subsequence_equals_the_table():
    rng = random.Random(5)
    for _ in range(50):
        a, b = ([rng.randrange(1, 8) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(decontamination.places(a), b) == table[-1][-1]


def test_leaks_of_the_given_benchmark_and_planted_paraphrases(spark):
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    texts = {r["doc_id"]: " ".join(WORD.findall(r["text"].lower())) for r in docs.collect()}
    asked = {r["item_id"]: " ".join(WORD.findall(r["text"].lower())) for r in items.collect()}
    rng = random.Random(8)
    host = [t for t in texts.values() if len(t.split()) > 60][:40]
    planted = []
    for k, (i, t) in enumerate(sorted(asked.items())):
        w = t.split()
        for _ in range(len(w) // 6):  # a sixth of the words changed
            w[rng.randrange(len(w))] = f"changed{rng.randrange(99)}"
        planted.append((100_000 + i, host[k % len(host)][:300] + " " + " ".join(w) + " " + host[(k + 1) % len(host)][:300]))
    rows = docs.union(spark.createDataFrame([*planted, (200_000, None), (200_001, ""), (None, planted[0][1])], docs.schema))
    out = decontamination.decontaminate(rows, items.union(spark.createDataFrame([(900, None), (901, ""), (None, "x")], items.schema))).collect()
    got = {r["doc_id"]: set(r["item_ids"]) for r in out}
    assert len(out) == len(texts) + len(planted) + 3 and not got[200_000] and not got[200_001]
    want = {d: {i for i, a in asked.items() if a in t} for d, t in texts.items()}
    assert all(want[d] <= got[d] for d in texts) and sum(bool(got[d]) and not want[d] for d in texts) == 0
    assert sum(i - 100_000 in got[i] for i, _ in planted) >= 0.9 * len(planted)
    assert decontamination.decontaminate(rows.limit(0), items).count() == 0
    assert not any(r["leaked"] for r in decontamination.decontaminate(docs.limit(20), items.limit(0)).collect())


# Toxicity

def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    held = [(got[r["doc_id"]]["score"], r["toxic"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    wins = [(a > b) + (a == b) / 2 for a, x in held if x for b, y in held if not y]
    assert sum(wins) / len(wins) > 0.85
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_edge_cases(spark):
    rng = random.Random(9)
    say = lambda: " ".join(rng.choice("the of and to in that with this from are".split()) + str(rng.randrange(60)) for _ in range(60))
    rows = [(i, say() + (" vilewretch" if i % 3 == 0 else "") + " " + say(), None, None, "x", 1) for i in range(240)]
    rows += [(None, None, None, None, "x", 1), (1000, "", None, None, "x", 1), (1001, "VILEWRETCH", None, None, "x", 1), (1001, "VILEWRETCH", None, None, "x", 1), (1002, say() * 400, None, None, "x", 1)]
    docs = spark.createDataFrame(rows, EXTRA)
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(240)] + [(3, 0, 0), (None, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == len(rows)
    assert all((r["predicted"] == 1) == (r["doc_id"] % 3 == 0) for r in out if r["doc_id"] is not None and r["doc_id"] < 240)
    assert all(r["predicted"] == 1 for r in out if r["doc_id"] == 1001)
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in toxicity.score_documents(docs, labels.where("toxic = 0")).collect()} == {0.0}


def test_half_copied_items_that_the_confirmation_accepts_are_found(spark):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    base = [r["text"] for r in docs.select("text").collect() if r["text"]]
    items = sorted((r["item_id"], r["text"]) for r in bench.collect() if r["text"] and len(r["text"].split()) >= 20)
    rng, words, planted = random.Random(1), [w for t in base for w in t.split()], {}
    for share in (0.25, 0.4, 0.5):
        for k, text in items:
            own, host = text.split(), rng.choice(base).split()[:300]
            for i in rng.sample(range(len(own) - 6), min(int(share * len(own)), len(own) - 6)):
                own[i] = rng.choice(words)
            at = rng.randrange(len(host) + 1)
            planted[10**9 + len(planted)] = (k, " ".join(host[:at] + own + host[at:]))
    plain = decontamination.Items([k for k, _ in items], [t.lower() for _, t in items], np.zeros((decontamination.TERMS, 4), np.float32), np.ones(decontamination.TERMS, np.float32))
    accepted = [i for i, (k, text) in planted.items() for _, _, w in word_slices(pa.array([text.lower()])) if plain.leaked(plain.ids.index(k), w.hash.tolist())]
    every = docs.select("doc_id", "text").union(spark.createDataFrame([(i, t) for i, (_, t) in planted.items()], "doc_id long, text string"))
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.decontaminate(every, bench).where("doc_id >= 1000000000").collect()}
    assert len(accepted) > len(items) and sum(planted[i][0] in got[i] for i in accepted) >= 0.95 * len(accepted)


def test_items_whose_rarest_words_were_changed_are_found(spark):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    base = [r["text"] for r in docs.select("text").collect() if r["text"]]
    common = Counter(w for t in base for w in set(t.lower().split()))
    rng, words, planted = random.Random(4), [w for t in base for w in t.split()], {}
    items = sorted((r["item_id"], r["text"]) for r in bench.collect() if r["text"] and len(r["text"].split()) >= 20)
    for share in (0.4, 0.5):
        for k, text in items:
            own, host = text.split(), rng.choice(base).split()[:300]
            body = len(own) - max(3, len(own) // 5)  # the answer stays
            for i in sorted(range(body), key=lambda i: common[own[i].lower()])[:int(share * len(own))]:
                own[i] = rng.choice(words)
            at = rng.randrange(len(host) + 1)
            planted[10**9 + len(planted)] = (k, " ".join(host[:at] + own + host[at:]))
    plain = decontamination.Items([k for k, _ in items], [t.lower() for _, t in items], np.zeros((decontamination.TERMS, 4), np.float32), np.ones(decontamination.TERMS, np.float32))
    accepted = [i for i, (k, text) in planted.items() for _, _, w in word_slices(pa.array([text.lower()])) if plain.leaked(plain.ids.index(k), w.hash.tolist())]
    every = docs.select("doc_id", "text").union(spark.createDataFrame([(i, t) for i, (_, t) in planted.items()], "doc_id long, text string"))
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.decontaminate(every, bench).where("doc_id >= 1000000000").collect()}
    assert len(accepted) > len(items) and sum(planted[i][0] in got[i] for i in accepted) >= 0.95 * len(accepted)


def test_words_in_common_bound_the_common_subsequence():
    rng = random.Random(6)
    texts = [" ".join(rng.choice("a b c d e".split()) for _ in range(rng.randrange(8, 60))) for _ in range(30)]
    items = decontamination.Items(list(range(30)), texts, np.zeros((decontamination.TERMS, 4), np.float32), np.ones(decontamination.TERMS, np.float32))
    stream = [rng.choice("a b c d e x y".split()) for _ in range(400)]
    [(_, _, w)] = list(word_slices(pa.array([" ".join(stream)])))
    slot = items.slot[decontamination.terms(w.hash)]
    before, kept = np.concatenate([[0], np.cumsum(slot >= 0)]), slot[slot >= 0]
    k, a = np.array([rng.randrange(30) for _ in range(200)]), np.array([rng.randrange(350) for _ in range(200)])
    b = a + np.array([rng.randrange(50) for _ in range(200)])
    got = decontamination._in_common(items, kept, decontamination._earlier(kept), k, before[a], before[b])
    for item, lo, hi, n in zip(k.tolist(), a.tolist(), b.tolist(), got.tolist(), strict=True):
        own, seen = Counter(texts[item].split()), Counter(stream[lo:hi])
        exact = sum(min(c, seen[x]) if c <= decontamination.REPEATS else seen[x] for x, c in own.items())
        assert n == exact >= decontamination.common_subsequence(items.masks[item], w.hash[lo:hi].tolist())


def area(pairs):
    """Of all (toxic, ordinary) pairs the share that the scores order rightly."""
    return np.mean([(a > b) + (a == b) / 2 for a, x in pairs if x for b, y in pairs if not y])


@pytest.mark.parametrize("case", ["phrase", "no space", "equal length", "length only"])
def test_toxicity_is_wording_and_not_length(case, spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    phrases = [say(4) for _ in range(6)]

    def text(toxic):
        words = say(240 if toxic and case == "length only" else 120)
        at = rng.randrange(0, 116)
        if toxic and case == "phrase":
            words[at:at + 4] = rng.choice(phrases)
        if toxic and case in ("equal length", "no space"):
            words[at] = rng.choice(["vilewretch", "foulscum"])
        return ("" if case == "no space" else " ").join(words)

    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(480)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).where("held_out").collect()
    found = area([(r["score"], r["doc_id"] % 3 == 0) for r in got])
    assert abs(found - 0.5) < 0.1 if case == "length only" else found > 0.9


def test_toxicity_where_labels_match_no_document_or_texts_are_few(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "other")], "doc_id long, text string")
    apart = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(100, 200)], "doc_id long, toxic int")
    trained = [k for k in range(100, 200) if zlib.crc32(str(k).encode()) % 4 != 2]
    share = sum(k % 4 == 0 for k in trained) / len(trained)
    assert {(r["score"], r["predicted"]) for r in toxicity.score_documents(docs, apart).collect()} == {(share, int(share >= 0.3))}
    for ids in ([(0, "vile"), (1, "x")], [(0, "vile"), (0, "mean"), (1, None), (4, "x")]):
        few = spark.createDataFrame(ids, "doc_id long, text string")
        out = toxicity.score_documents(few, spark.createDataFrame([(k, int(k == 0)) for k in range(8)], "doc_id long, toxic int")).collect()
        assert len(out) == len(ids) and all(0 <= r["score"] <= 1 for r in out)


def test_telling_strings_and_their_passages():
    rng = random.Random(5)
    make = lambda word: toxicity.sample_windows(" ".join([*(f"w{rng.randrange(300)}" for _ in range(30)), word, *(f"w{rng.randrange(300)}" for _ in range(30))]))
    toxic, ordinary = [make("vilewretch") for _ in range(40)], [make("kindperson") for _ in range(80)]
    grams = {size: toxicity.telling(toxic, ordinary, size) for size in toxicity.GRAMS}
    assert toxicity.gram_hashes(b"vilewr", 6)[0] in grams[6] and toxicity.gram_hashes(b"kindpe", 6)[0] not in grams[6]
    assert all(b"vilewretch" in x for x in toxicity.passages(toxic, grams)) and not toxicity.passages(ordinary, grams)
    # A passage that toxic texts copy from each other is one occurrence.
    copied = " ".join(f"c{k}" for k in range(60))
    assert not len(toxicity.telling([toxicity.sample_windows(copied) for _ in range(40)], ordinary, 12))
    long = toxicity.windows(b"a" * 10_000)
    assert max(map(len, long)) <= toxicity.LONGEST + toxicity.TAIL and sum(len(w) - toxicity.TAIL for w in long) == 10_001


# Archives

def test_archive_round_trip(spark):
    big = "é" * 60
    rows = [(5, "http://a/x y", big, "c"), (3, "http://b/", big, "c"), (9, None, big, "c"), (1, "u", "small", "c"), (2, "u", "small", "c"), (4, "u", None, "c"), (6, "u", "", "c"),
            (7, "u", "WARC/1.1\r\n\r\n\n\n" * 30, "c"), (3, "http://b/", big, "c"), (None, "u", big, "c"), (8, "u", "z" * 3_000_000, "c")]
    out = archives.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")).collect()
    assert len(out) == len(rows)
    for r in out:
        payload = next((h or "").encode() for i, _, h, _ in rows if i == r["page_id"])
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in out)
    assert kinds == Counter([(3, "response", None), (3, "revisit", 3), (5, "revisit", 3), (9, "revisit", 3), (None, "revisit", 3), (1, "response", None), (2, "response", None),
                             (4, "response", None), (6, "response", None), (7, "response", None), (8, "response", None)])
    assert archives.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_of_both_versions_and_any_bytes(version, spark):
    blocks = [b"HTTP/1.0 200 OK\r\nX-Page-Id: 4\r\n\r\n\xff\xfe binary", b"", b"no http \n 1 2 3 4\n"]
    data = archives.arc_head(version, "f") + b"".join(archives.arc_record(version, "f", 0, f"http://x/{k}", b) for k, b in enumerate(blocks))
    got = list(archives.parse_arc(data, "f"))
    assert [r.block for r in got] == blocks and [r.url for r in got] == [f"http://x/{k}" for k in range(3)]
    for broken in (data[:-3], b"junk\n" + data, data.replace(b"filedesc", b"filedisc")):
        with pytest.raises(ValueError, match="no ARC"):
            list(archives.parse_arc(broken, "f"))
    out = archives.convert_record(got[0], "f", None)
    (head, block), = archives.parse_warc(out)
    assert block == blocks[0] and head["warc-type"] == "response" and head["warc-date"] == "1999-01-01T00:00:00Z"


# Packing

def test_unit_ids_equal_the_tokenizer_s(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(60).collect()]
    texts += ["", None, " a  b  c \n\nd'll we've <|endoftext|> x<|endoftext|>", "  lead", "trail  \n", "a  b 　 c \nd", "\x85 x\x1c y", "“q” – r…", "x" * 3000]
    units = packing.UnitTokenizer(BPE)
    want = [e.ids for e in units.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in units.ids(pa.array(texts, pa.string()))] == want == [x.tolist() for x in units.ids(pa.array(texts, pa.string()))]


@pytest.mark.parametrize("n", [0, 1, 7, 2000])
def test_bins_are_gapless_and_few(n):
    size = np.random.default_rng(n).integers(1, 2049, n)
    where, offset = packing.sum_of_squares(size)
    held: dict[int, list] = {}
    for b, o, s in zip(where.tolist(), offset.tolist(), size.tolist(), strict=True):
        held.setdefault(b, []).append((o, s))
    for items in held.values():
        at = 0
        for o, s in sorted(items):
            assert o == at
            at += s
        assert at <= 2048
    assert len(held) <= 1.02 * max(math.ceil(size.sum() / 2048), int((size > 1024).sum())) + 1


def test_pieces_and_packing(spark):
    assert [packing.cuts(n) for n in (1, 2048, 2049, 5000)] == [[(0, 1)], [(0, 2048)], [(0, 1), (1, 2048)], [(0, 904), (904, 2048), (2952, 2048)]]
    rows = [(1, None, None, None, "x", 1), (2, "", None, None, "x", 1), (3, "word " * 9000, None, None, "x", 1), (3, "word " * 9000, None, None, "x", 1), (None, "a b", None, None, "x", 1)]
    out = packing.pack(spark.createDataFrame(rows, EXTRA), BPE).collect()
    ids = packing.UnitTokenizer(BPE)
    for r in out:
        text = next(t for i, t, *_ in rows if i == r["doc_id"])
        full = np.append(next(ids.ids(pa.array([text], pa.string()))), 0).astype("<u4")
        assert zlib.crc32(full[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    total = sum(r["length"] for r in out)
    assert len({r["sequence_id"] for r in out}) == math.ceil(total / 2048)
    assert packing.pack(spark.createDataFrame([], EXTRA), BPE).count() == 0


def test_scratch_tables_can_be_dropped(spark):
    s = Scratch(spark, "t")
    t = s.save(spark.range(3).toDF("a"), "x")
    assert t.count() == 3
    s.drop(t)
    with pytest.raises(Exception, match="(?i)exist"):
        t.count()


def test_units_in_one_piece_have_the_ids_of_single_ones():
    from tokenizers import Tokenizer

    rng = random.Random(9)
    parts = ["'s", "don't", " ", "  ", "\n", "\t", " ", " ", "　", "\x85", "\x1c", "a", "word", "é", "日本", "1", "²", "!", "-", "<|endoftext|>", "́", "😀"]
    library = Tokenizer.from_file(BPE)
    for without in ((), ("<|endoftext|>",)):   # a slice that holds the added token takes the other way
        texts = ["".join(rng.choice([p for p in parts if p not in without]) for _ in range(rng.randrange(25))) for _ in range(3000)]
        got = [ids.tolist() for ids in packing.UnitTokenizer(BPE).ids(pa.array(texts))]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
