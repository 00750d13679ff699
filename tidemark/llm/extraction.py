"""Main text of HTML pages: blocks of the markup, and a suffix array per host for what the markup doesn't tell.

``blocks_of`` cuts a page into text blocks and marks each as *declared* (inside an article or main element), *dropped*
(menus, headers, footers, sidebars, notices, adverts, forms, reader comments, scripts, styles,
hidden parts) or *open* (neither). A page that declares its main text is its
declared blocks, else its open ones; the host of every page then decides what of them is boilerplate: the token streams of
all blocks that aren't declared are concatenated per host, and a suffix array finds the long token sequences that are
repeated on ``MIN_PAGES`` distinct pages or more. Open blocks that they cover go, and
unique runs stay. The tokens of declared blocks are looked up among the sequences found: a declared block goes if it consists
of what so many pages hold outside their main texts and half of the host's distinct main texts hold it (a notice that the
host's pages carry everywhere and don't mark here), unless that leaves nothing of the page. What only articles repeat, or
what an article shares with an advert elsewhere, stays.

A large host is dealt out to shards of about ``SHARD_TOKENS`` tokens outside main texts (``SHARD_CHARS`` characters of
main texts) by a hash of the page, so one host never meets in one task. Which sequences such a host's pages repeat, and which blocks half of its
main texts hold, is counted over all its shards (``_evidence``), and every shard gets them: a page's text doesn't depend on the number of shards.

Defined results: null, empty or text-free html gives an empty text; malformed markup is read as
browsers do (unclosed and stray tags, unquoted attributes, cut-off pages); a null or
odd url is a host of its own name; every input row gives one row, also when ids repeat;
an empty table gives an empty result; only the id, url and html columns are read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import raw, shingles, words_of

MIN_TOKENS = 8
MIN_PAGES = 3
SHARD_TOKENS = 1 << 20
SHARD_CHARS = 1 << 26
TEXTS = "page_id long, url string, text string"

DECLARED, OPEN, DROPPED = 2, 1, 0

#: Names of HTML elements, roles and usual class words.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
DROP_ELEMENTS = ("nav", "header", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "head",
                 "template", "svg", "math", "object", "canvas", "audio", "video", "map", "fieldset", "datalist")
BLOCK_ELEMENTS = ("address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
                  "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
                  "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
                  "table", "tbody", "tfoot", "thead", "tr", "ul")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
DROP_ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert",
              "menu", "menubar", "toolbar", "status")
DROP_WORDS = ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment",
              "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "hidden", "login", "masthead", "menu",
              "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination", "popup", "promo",
              "promotion", "related", "recommended", "reply", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
              "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar", "widget")
ARTICLE_PROPS = ("articlebody", "text", "blogpost")

_TOKEN = re.compile(r"""<!--(?:.*?--!?>|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*'|["'])*+)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?|</{t}$", re.I) for t in RAW}
_DROP, _DROP_WORDS, _DROP_ROLES = frozenset(DROP_ELEMENTS), frozenset(DROP_WORDS), frozenset(DROP_ROLES)
_BLOCK, _VOID, _RAW = frozenset(BLOCK_ELEMENTS), frozenset(VOID), frozenset(RAW)


class Open(NamedTuple):
    """An open element, and what holds for its content by it and all elements around it."""

    tag: str
    drop: str  # of the element itself: "", "header" (headings stay inside an article) or "yes"
    dropped: bool
    header: bool
    heading: bool
    declared: str  # "", "main" or "article"


_ROOT = Open("", "", False, False, False, "")


def _judge(tag: str, attributes: str) -> tuple[str, str]:
    """(drop, declared) by the element and its attributes alone."""
    declared = tag if tag in ("article", "main") else ""
    drop = ("header" if tag == "header" else "yes") if tag in _DROP else ""
    if "=" in attributes or "hidden" in attributes:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        role = found.get("role", "").lower()
        if role == "main" or found.get("itemprop", "").lower() in ARTICLE_PROPS:
            declared = declared or "main"
        if role == "article":
            declared = "article"
        if role in _DROP_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" \
                or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
            drop = "yes"
        if not drop and tag not in ("html", "body", "main") and ("class" in found or "id" in found):
            words = {w.lower() for w in _WORDS.findall(found.get("class", "") + " " + found.get("id", ""))}
            if words & _DROP_WORDS and not (tag == "article" and not words & {"comment", "comments", "reply", "related", "sponsored", "ad"}):
                drop = "yes"
    return drop, declared


def blocks_of(page: str | None) -> list[tuple[str, int]]:
    """(text, DECLARED, OPEN or DROPPED) of every non-empty block in page order."""
    out: list[tuple[str, str, bool]] = []
    stack: list[Open] = [_ROOT]
    held: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            o = stack[-1]
            out.append((text, o.declared, o.dropped or (o.header and not (o.declared and o.heading))))

    page, at = page or "", 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            held.append(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            held.append(" ")
        elif m[1]:
            depth = len(stack) - 1
            while depth and stack[depth].tag != tag:
                depth -= 1
            if held and (depth or tag in _BLOCK):
                flush()
            if depth:
                del stack[depth:]
            elif tag in ("td", "th"):
                held.append(" ")
        elif tag in _RAW:
            end = _ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag in _VOID:
            if tag == "hr":
                flush()
        else:
            drop, declared = _judge(tag, m[3])
            if tag in _BLOCK or drop or declared:
                if held:
                    flush()
                if tag in _BLOCK and stack[-1].tag == "p":
                    stack.pop()
                if tag in ("li", "dt", "dd", "tr") and stack[-1].tag == tag:
                    stack.pop()
                if declared and tag in ("article", "main"):  # a menu or page header that was never closed ends here
                    cut = next((k for k, o in enumerate(stack) if o.tag in ("nav", "header", "head", "ul", "li") and o.drop), None)
                    if cut is not None:
                        del stack[cut:]
                if not m[3].rstrip().endswith("/") or tag in _BLOCK:
                    o = stack[-1]
                    stack.append(Open(tag, drop, o.dropped or drop == "yes", o.header or drop == "header", o.heading or tag in HEADINGS,
                                      "article" if "article" in (declared, o.declared) else o.declared or declared))
            elif tag in ("td", "th"):
                held.append(" ")
    held.append(page[at:])
    flush()
    kinds = {d for _, d, drop in out if not drop}
    best = next((d for d in ("article", "main") if d in kinds), None)
    return [(t, DROPPED if drop else OPEN if best is None else DECLARED if d == best else DROPPED) for t, d, drop in out]


def host_of(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else (url or "")


def ranks(tokens: np.ndarray) -> list[np.ndarray]:
    """Ranks of all token sequences of length 1, 2, 4, ... that start at each place, until all differ."""
    r = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    out, n, width = [r], len(tokens), 1
    while width < n and r.max(initial=0) < n - 1:
        ahead = np.zeros(n, np.int64)
        ahead[:n - width] = r[width:] + 1
        r = np.unique(r * (n + 1) + ahead, return_inverse=True)[1]
        out.append(r)
        width *= 2
    return out


def repeated(tokens: np.ndarray, page: np.ndarray, min_tokens: int = MIN_TOKENS, min_pages: int = MIN_PAGES) -> np.ndarray:
    """Whether each token lies in a sequence of ``min_tokens`` or more that ``min_pages`` distinct pages hold.

    Every page must end with a token of its own, so that no sequence spans two pages.
    """
    return repeats(tokens, page, np.ones(int(page.max(initial=-1)) + 1, np.int64), min_tokens, min_pages)[0]


def repeats(tokens: np.ndarray, page: np.ndarray, count: np.ndarray, min_tokens: int = MIN_TOKENS, min_pages: int = MIN_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """``repeated``, and a place of every sequence of ``min_tokens`` that ``min_pages`` pages hold if each page stands for ``count`` of them."""
    covered = np.zeros(len(tokens), bool)
    if len(tokens) < 2:
        return covered, np.zeros(0, np.int64)
    levels = ranks(tokens)
    suffixes = np.argsort(levels[-1], kind="stable")  # the suffix array
    a, b = suffixes[:-1], suffixes[1:]
    common = np.zeros(len(a), np.int64)
    n = len(tokens)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < n) & (y < n)
        equal = inside & (levels[j][np.minimum(x, n - 1)] == levels[j][np.minimum(y, n - 1)])
        common[equal] += 1 << j
    # Neighbours with min_tokens in common form a group; it counts with enough distinct pages.
    group = np.concatenate([[0], np.cumsum(common < min_tokens)])
    held, of = np.unique(np.stack([group, page[suffixes]], 1), axis=0).T
    good = np.bincount(held, minlength=group[-1] + 1) >= min_pages
    often = np.bincount(held, count[of], group[-1] + 1) >= min_pages
    mark = suffixes[good[group]]
    mark = mark[mark + min_tokens <= n]
    edge = np.zeros(n + 1, np.int64)
    edge[mark] += 1
    edge[mark + min_tokens] -= 1
    starts = suffixes[np.flatnonzero(np.diff(group, prepend=-1))[often]]
    starts = starts[starts + min_tokens <= n]
    inside = (tokens[starts[:, None] + np.arange(min_tokens)] > 0).all(1)  # within one block
    return np.cumsum(edge[:-1]) > 0, starts[inside]


class Boilerplate:
    """The sequences that a host's pages repeat outside their main texts, to look up the main texts' blocks in."""

    def __init__(self, stream: np.ndarray, starts: np.ndarray, known: dict[str, int]):
        self.known = known
        self.sequences = {tuple(x) for x in stream[starts[:, None] + np.arange(MIN_TOKENS)].tolist()} if len(starts) else set()
        self.firsts = {x[0] for x in self.sequences}

    def holds(self, block: str) -> bool:
        """Whether every word of the block lies in one of the sequences."""
        words = block.split(" ")
        if len(words) < MIN_TOKENS or not self.sequences or self.known.get(words[0].lower()) not in self.firsts:
            return False
        tokens = [self.known.get(w.lower(), -1) for w in words]
        reach = 0
        for i in range(len(tokens) - MIN_TOKENS + 1):
            if tokens[i] in self.firsts and tuple(tokens[i:i + MIN_TOKENS]) in self.sequences:
                reach = i + MIN_TOKENS
            elif reach <= i:
                return False
        return reach == len(tokens)


def unique_runs(words: list[str], covered: np.ndarray) -> str:
    """A block without its covered tokens; one that is mostly unique stays whole."""
    n = int(covered.sum())
    if 2 * n < len(words):
        return " ".join(words)
    return " ".join(w for w, c in zip(words, covered.tolist(), strict=True) if not c)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, url, html -> host, the blocks that aren't declared and those that are, and which of the former are open."""
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part, rows = b.slice(lo, 256), []
            for page_id, url, page in zip(*(c.to_pylist() for c in part.columns), strict=True):
                every = blocks_of(page)
                blocks, declared = [(t, kind) for t, kind in every if kind != DECLARED], [t for t, kind in every if kind == DECLARED]
                rows.append((host_of(url), page_id, url, [t for t, _ in blocks], [k == OPEN for _, k in blocks], declared,
                             sum(t.count(" ") + 2 for t, _ in blocks), sum(map(len, declared)), hash_of(blocks), hash_of(declared)))
            yield _batch(rows, ("host", "page_id", "url", "blocks", "open", "declared", "n_tokens", "n_declared", "salt", "main"),
                         (pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.int64(), pa.int64()))


def hash_of(blocks: list) -> int:
    import zlib

    return zlib.crc32(repr(blocks).encode())


def _batch(rows: list[tuple], names: tuple[str, ...], types: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))


def usual_blocks(declared: pa.Array, main: list[int], boilerplate: Boilerplate) -> set[str]:
    """Lower-cased boilerplate blocks that ``MIN_PAGES`` and half of the distinct main texts hold."""
    held: Counter = Counter()
    seen: set[int] = set()
    if boilerplate.sequences:
        for k, key in enumerate(main):
            if key not in seen and len(blocks := declared[k]):
                seen.add(key)
                held.update({x.lower() for x in blocks.as_py() if boilerplate.holds(x)})
    return {x for x, n in held.items() if n >= MIN_PAGES and 2 * n >= len(seen)}


def grams_of(blocks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place of its first word) of every sequence of ``MIN_TOKENS`` words within a block, and each block's first word."""
    w = words_of(*raw(pa.array([" ".join(x.lower() for x in b.split(" ")) for b in blocks], pa.string())))
    if len(w.hash) < MIN_TOKENS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), w.first
    h = shingles(w.hash, MIN_TOKENS).view(np.int64)
    at = np.arange(len(h))
    inside = at + MIN_TOKENS <= np.repeat(w.first[1:], np.diff(w.first))[:len(h)]
    return h[inside], at[inside], w.first


def block_hash(block: str) -> int:
    return int.from_bytes(hashlib.blake2b(block.lower().encode(), digest_size=8).digest(), "little", signed=True)


GRAM, BLOCK, TEXT = 0, 1, 2


def _few(key: np.ndarray) -> np.ndarray:
    """Of the rows (host, hash, salt, main) of ``key`` at most ``MIN_PAGES`` of each host and hash, of as many salts as they have."""
    key = np.unique(key, axis=0)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:, :3] != key[:-1, :3]).any(1)
    at = np.arange(len(key))
    rank = at - np.maximum.accumulate(np.where(new, at, 0))  # among those of one salt
    key = key[np.lexsort((key[:, 2], rank, key[:, 1], key[:, 0]))]
    new[1:] = (key[1:, :2] != key[:-1, :2]).any(1)
    return key[at - np.maximum.accumulate(np.where(new, at, 0)) < MIN_PAGES]


def _evidence_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host key, blocks, declared, salt, main -> what speaks for boilerplate: sequences outside main texts, long blocks of main texts, main texts."""
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part, grams, rest = b.slice(lo, 256), [np.zeros((0, 4), np.int64)], set()
            for host, blocks, declared, salt, main in zip(*(c.to_pylist() for c in part.columns), strict=True):
                h = grams_of(blocks)[0]
                grams.append(np.stack([np.full(len(h), host), h, np.full(len(h), salt), np.full(len(h), main)], 1))
                if declared:
                    rest.add((host, TEXT, 0, 0, main))
                    rest.update((host, BLOCK, block_hash(x), 0, main) for x in declared if x.count(" ") + 1 >= MIN_TOKENS)
            few = _few(np.concatenate(grams))
            more = np.array(sorted(rest), np.int64).reshape(-1, 5)
            rows = np.concatenate([np.insert(few, 1, GRAM, 1), more])
            yield pa.record_batch([pa.array(rows[:, k]) for k in range(5)], names=["key", "kind", "h", "salt", "main"])


def _evidence(streams: DataFrame, large: DataFrame, scratch: Scratch) -> DataFrame:
    """host, _shard, kind, h, good: of every large host the sequences that ``MIN_PAGES`` pages hold outside their main texts (good: pages that
    differ there), and the blocks that ``MIN_PAGES`` and half of its distinct main texts hold, for each of its shards."""
    keyed = large.withColumn("key", F.xxhash64("host"))
    seen = (streams.join(keyed.select("host", "key"), "host").select("key", "blocks", "declared", "salt", "main")
            .mapInArrow(_evidence_of, "key long, kind long, h long, salt long, main long").distinct()
            .groupBy("key", "kind", "h").agg(F.count("*").alias("n"), F.count_distinct("salt").alias("salts")).where((F.col("n") >= MIN_PAGES) | (F.col("kind") == TEXT)))
    seen = scratch.save(seen, "evidence")  # the pages are parsed for it once
    texts = seen.where(F.col("kind") == TEXT).select("key", F.col("n").alias("texts"))
    kept = seen.where(F.col("kind") != TEXT).join(texts, "key", "left").where((F.col("kind") == GRAM) | (2 * F.col("n") >= F.col("texts")))
    return (keyed.join(kept, "key").withColumn("_shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shards") - 1)))
            .select("host", "_shard", "kind", "h", (F.col("salts") >= MIN_PAGES).alias("good")))


def shard_text(t: pa.Table) -> pa.Table:
    """page_id, url, text of the pages of one shard of a host that is one shard."""
    return _shard_text(t, None)


def shard_of_large(t: pa.Table, evidence: pa.Table) -> pa.Table:
    """``shard_text`` with the evidence of all shards of the host, if it has more than one."""
    return _shard_text(t, evidence if evidence.num_rows else None) if t.num_rows else t.select(["page_id", "url"]).append_column("text", pa.array([], pa.string()))


def _cover(covered: np.ndarray, blocks: list[str], places: list[int], known: np.ndarray) -> None:
    """Mark the tokens of a page's blocks, which start at ``places``, that lie in a known sequence."""
    h, at, first = grams_of(blocks)
    at = at[np.isin(h, known)]
    start = np.array(places, np.int64)
    of = np.searchsorted(first, at, "right") - 1
    covered[((start[of] + at - first[of])[:, None] + np.arange(MIN_TOKENS)).ravel()] = True


def _holds(block: str, known: np.ndarray) -> bool:
    covered = np.zeros(block.count(" ") + 1, bool)
    _cover(covered, [block], [0], known)
    return bool(covered.all())


def _shard_text(t: pa.Table, evidence: pa.Table | None) -> pa.Table:
    pages = sorted(zip(*(t[c].to_pylist() for c in ("page_id", "url", "blocks", "open", "main")), range(t.num_rows), strict=True),
                   key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    declared = t["declared"].combine_chunks()
    known: dict[str, int] = {"\n": 0}
    same: dict[tuple, int] = {}
    stream, owner, spans, words_of = [], [], [], []
    mains: list[set[int]] = []  # the main texts of the pages that are alike but for them
    for _, _, blocks, _, main, _ in pages:
        words = [x.split(" ") for x in blocks]
        words_of.append(words)
        key = tuple(blocks)
        if key in same:  # an equal page is no further evidence
            spans.append(spans[same[key]])
            mains[same[key]].add(main)
            mains.append(set())
            continue
        same[key] = len(spans)
        mains.append({main})
        places = []
        for block in words:
            places.append(len(stream) + 1)
            stream.append(0)
            stream += [known.setdefault(w.lower(), len(known)) for w in block]
        owner += [len(spans)] * (len(stream) - len(owner) + 1)
        stream.append(-1 - len(spans))
        spans.append(places)
    tokens = np.array(stream, np.int64)
    covered, starts = repeats(tokens, np.array(owner, np.int64), np.array([len(x) for x in mains], np.int64))
    if evidence is None:
        usual = usual_blocks(declared, t["main"].to_pylist(), Boilerplate(tokens, starts, known))
    else:
        kind, h, good = (evidence[c].to_numpy() for c in ("kind", "h", "good"))
        for at in set(same.values()):
            _cover(covered, pages[at][2], spans[at], h[(kind == GRAM) & good])
        often, half = h[kind == GRAM], set(h[kind == BLOCK].tolist())
        blocks = {x.lower() for of in declared.to_pylist() for x in of or []} if half else set()
        usual = {x for x in blocks if x.count(" ") + 1 >= MIN_TOKENS and block_hash(x) in half and _holds(x, often)}
    out = []
    for (page_id, url, _, is_open, _, k), words, places in zip(pages, words_of, spans, strict=True):
        main = declared[k].as_py() or []
        if any(is_open):
            kept = [unique_runs(w, covered[p:p + len(w)]) for w, p, o in zip(words, places, is_open, strict=True) if o]
        else:
            kept = [x for x in main if x.lower() not in usual] or main
        out.append((page_id, url, "\n\n".join(x for x in kept if x)))
    return pa.Table.from_batches([_batch(out, ("page_id", "url", "text"), (pa.int64(), pa.string(), pa.string()))])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    streams = rows.mapInArrow(_streams, "host string, page_id long, url string, blocks array<string>, open array<boolean>, declared array<string>, "
                                        "n_tokens long, n_declared long, salt long, main long")
    shards = streams.groupBy("host").agg(F.sum("n_tokens").alias("_n"), F.sum("n_declared").alias("_m")).select(
        "host", F.greatest(F.lit(1), F.ceil(F.col("_n") / SHARD_TOKENS), F.ceil(F.col("_m") / SHARD_CHARS)).alias("_shards"))
    scratch = Scratch(pages.sparkSession, "extraction")
    shards = scratch.save(shards, "shards")
    large = shards.where("_shards > 1")
    dealt = streams.join(shards, "host").withColumn("_shard", F.pmod(F.xxhash64("page_id", "salt"), F.col("_shards"))).groupBy("host", "_shard")
    if large.isEmpty():
        out = dealt.applyInArrow(shard_text, TEXTS)
    else:
        out = dealt.cogroup(_evidence(streams, large, scratch).groupBy("host", "_shard")).applyInArrow(shard_of_large, TEXTS)
    return out.withColumn("n_chars", F.length("text").cast("long"))
