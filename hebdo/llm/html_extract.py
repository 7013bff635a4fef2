"""Main text of web pages: structure plus a suffix array per host.

A scan of the markup cuts a page into blocks: those of its article, those in
menus, headers, footers, adverts and the like, and open ones that the markup
says nothing about. Every page goes whole, token by token, into a suffix array
over the distinct pages of its host; substrings that recur on a large share of
them are boilerplate. Large hosts are dealt into shards of bounded size whose
arrays are merged on their prefixes, so repeats across shards count like those
within one. Every page is then judged by its host's repeats. One with an article
is its article, but for blocks that are boilerplate from end to end, no prose
and in no element of prose: a menu, notice or advert that the markup leaves
unnamed. A passage that other pages repeat stays, and so does all of an article
that is mostly a copy. A page without an article keeps its open blocks, but for
those that are boilerplate from end to end and no prose.
"""

from __future__ import annotations

import hashlib
import html
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import record_batches, stash
from hebdo.llm.tokens import Texts, windows
from hebdo.llm.url_rules import url_host

#: a tag ends at its first ">" outside quotes; where a quote never closes, at its first ">" at all, or with
#: the page. No group gives back what it took, so a page is read in time proportional to its length.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>|\Z)|[^>]*+)(?:>|\Z)", re.S)
_RAW = {t: re.compile(rf"</{t}\s*(?:>|$)", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "svg")}
_CLASS = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p "
                   "pre section summary table tbody td tfoot th thead tr ul".split())
_ENDS_P = _BLOCK - {"br", "html", "body", "head"}
_DROP = frozenset("nav footer aside form button select head template dialog menu".split())
_MAIN = frozenset("article main".split())
#: class, id and role values that mark chrome
_CHROME = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar menu nav "
                    "navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice "
                    "newsletter subscribe signup share sharing social related recommended comment comments respond "
                    "replies disqus popup modal login search widget pagination pager complementary contentinfo".split())
#: words that leave a value like "site-footer" or "share-buttons" chrome ("no-sidebar", "search-results" are not)
_BEFORE = frozenset("site main top bottom global primary secondary".split())
_AFTER = frozenset("bar box list links link button buttons item items form area inner slot unit".split())
_PART_OF = re.compile(r"[-_]+")
#: inside an article, no chrome as one of several words of a value ("related work", "login page")
_AMBIGUOUS = frozenset("related social login cookie cookies notice search share widget recommended respond replies sponsor "
                       "promo menu navigation consent".split())
#: elements that are prose, whatever their class says
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table tr td th dt dd figcaption".split())
#: chrome that holds articles of its own
_TEASERS = frozenset("related recommended comment comments respond replies disqus".split())
#: ``TEXT`` is what an article holds in an element of prose
ARTICLE, CHROME, OPEN, TEXT = 0, 1, 2, 3
#: while a page is read: chrome by its class only, such chrome with teasers, an article in the latter
_BY_CLASS, _WITH_TEASERS, _TEASER = 4, 5, 6
#: a sentence's end
_STOP = re.compile(r"[.!?…。！？][\"'”’»)\]]*(?:\s|$)")


@dataclass(frozen=True)
class HtmlParams:
    run: int = 8              # tokens from which a repeated substring counts (a power of two)
    pages: int = 2            # distinct pages that it must stand on,
    share: float = 0.5        # and share of the host's distinct pages
    template: int = 3         # distinct pages that it must stand on to be boilerplate within articles
    prose: int = 8            # words from which a block with a sentence's end is prose,
    plain: int = 25           # and one without
    shard: int = 400_000      # tokens of one suffix array, about


def _chrome_class(attributes: str, inside: bool = False) -> int | None:
    """The region that class, id and role values make of an element, if any; ``inside`` an article."""
    found = None
    for c in _CLASS.finditer(attributes):
        values = (c.group(1) or c.group(2) or c.group(3) or "").lower().split()
        for value in values:
            if inside and len(values) > 1 and value in _AMBIGUOUS:
                continue
            words = [w for w in _PART_OF.split(value) if w and not w.isdigit()]
            while words and words[0] in _BEFORE:
                words = words[1:]
            while words and words[-1] in _AFTER:
                words = words[:-1]
            if words and _CHROME.issuperset(words):
                if not _TEASERS.intersection(words):
                    return _BY_CLASS
                found = _WITH_TEASERS
    return found


def blocks(page: str) -> list[tuple[int, str]]:
    """(region, text) in page order; character references decoded, white space one space.

    A class can mark chrome, but not an article or what holds the page's article.
    """
    return [(ARTICLE if r == TEXT else r, t) for r, t in _blocks(page)]


def _blocks(page: str) -> list[tuple[int, str]]:
    """Like ``blocks``, with ``TEXT`` apart from the rest of an article."""
    out: list[tuple[int, bool, str]] = []
    stack: list[tuple[str, int, bool, bool]] = []   # tag, region below it, inside an article, inside an element of prose
    buf: list[str] = []
    region, inside, prose = OPEN, False, False

    def flush() -> None:
        if buf:
            text = "".join(buf)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                out.append((region, prose, text))
            buf.clear()

    def settle() -> None:
        nonlocal region, inside, prose
        region, inside, prose = stack[-1][1:] if stack else (OPEN, False, False)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            buf.append(page[at:])
            break
        if lt > at:
            buf.append(page[at:lt])
        m = _MARKUP.match(page, lt)
        if m is None:                        # a bare "<" is text
            buf.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m.group(2) is None:
            if m.group().startswith("<![CDATA["):
                buf.append(html.escape(m.group()[9:].removesuffix("]]>")))
            continue
        tag, close = m.group(2).lower(), bool(m.group(1))
        if tag in _RAW and not close:
            end = _RAW[tag].search(page, at)
            at = end.end() if end else n
            continue
        if tag in _BLOCK:
            flush()
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    settle()
                    break
            continue
        if tag in _VOID or m.group(3).endswith("/") and tag not in _BLOCK:
            continue
        if tag in _ENDS_P and stack and stack[-1][0] == "p":
            stack.pop()
            settle()
        if tag == "li" and stack and stack[-1][0] == "li":
            stack.pop()
            settle()
        if tag == "body":
            stack = [s for s in stack if s[0] != "head"]
            settle()
        low, now = region, inside
        if tag in _MAIN:
            if region != CHROME:
                low, now = _TEASER if region in (_WITH_TEASERS, _TEASER) else ARTICLE, True
        elif tag in _DROP or tag == "header" and not inside:
            low = CHROME
        elif region != CHROME and m.group(3) and tag not in ("html", "body") and not (inside and tag in _PROSE):
            marked = _chrome_class(m.group(3), inside)
            if marked is not None and region != _WITH_TEASERS:
                low = marked
        if tag in _BLOCK or low != region:
            if low != region:
                flush()
            prose = prose and tag not in _MAIN or tag in _PROSE
            stack.append((tag, low, now, prose))
            region, inside = low, now
    flush()
    teaser = CHROME if any(r == ARTICLE for r, _, _ in out) else ARTICLE
    settled = {_BY_CLASS: CHROME, _WITH_TEASERS: CHROME, _TEASER: teaser}
    found = [(settled.get(r, r), p, t) for r, p, t in out]
    return [(TEXT if r == ARTICLE and p else r, t) for r, p, t in found]


def is_prose(text: str, params: HtmlParams) -> bool:
    n = text.count(" ") + 1
    return n >= params.plain or n >= params.prose and _STOP.search(text) is not None


_PAGE = ("id long, url string, host string, page long, words long, first boolean, "
         "parts array<struct<region:int,words:int>>, packed binary")
_PART = pa.list_(pa.struct([("region", pa.int32()), ("words", pa.int32())]))
_LEVEL = 6


def pack(text: str) -> bytes:
    """A text's length in bytes and its zstd frame: pages are written and shuffled whole."""
    raw = text.encode("utf-8", "surrogatepass")
    return struct.pack("<q", len(raw)) + pa.Codec("zstd", compression_level=_LEVEL).compress(raw, asbytes=True)


def unpack(column: pa.Array | pa.ChunkedArray) -> list[str]:
    codec = pa.Codec("zstd")
    return [codec.decompress(b[8:], struct.unpack_from("<q", b)[0], asbytes=True).decode("utf-8", "surrogatepass")
            for b in column.to_pylist()]


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of packed pages by the length of their texts."""
    for rb in batches:
        sizes = [struct.unpack_from("<q", b)[0] for b in rb.column("packed").to_pylist()]
        yield from record_batches(iter([rb.append_column("size", pa.array(sizes, pa.int64()))]), "size")


def cut_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, host, page, words, first, parts, packed): ``packed`` the texts of all parts in page order
    joined by spaces, ``page`` a hash of them and their regions; ``first`` is false where a
    partition has held the page's like on its host before."""

    def run(batches):
        seen = set()
        for rb in record_batches(batches, "html", 8 << 20):
            page, words, first, parts, packed = [], [], [], [], []
            for body, host in zip(rb.column("html").to_pylist(), rb.column("host").to_pylist()):
                got = _blocks(body or "")
                sizes = [t.count(" ") + 1 for _, t in got]
                parts.append([{"region": r, "words": n} for (r, _), n in zip(got, sizes)])
                words.append(sum(sizes))
                text = " ".join(t for _, t in got)
                packed.append(pack(text))
                regions = repr([(r, n) for (r, _), n in zip(got, sizes)])
                page.append(int.from_bytes(hashlib.blake2b(f"{regions}{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                                           "little", signed=True))
                first.append((host, page[-1]) not in seen)
                seen.add((host, page[-1]))
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), rb.column("url"), rb.column("host"), pa.array(page, pa.int64()), pa.array(words, pa.int64()),
                 pa.array(first, pa.bool_()), pa.array(parts, _PART), pa.array(packed, pa.binary())],
                names=["id", "url", "host", "page", "words", "first", "parts", "packed"])

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        url_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInArrow(run, _PAGE)


def suffix_array(tokens: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): all suffixes sorted, and the tokens that each shares with the one before it.

    A suffix ends with its page, ``page`` being the sorted page of each token. Prefix doubling: a
    round sorts by twice as many tokens as the one before, and only what that left equal.
    """
    n = len(tokens)
    place = np.arange(n)
    left = np.searchsorted(page, page, side="right") - place
    order = np.argsort(tokens, kind="stable")
    lcp = np.zeros(n, dtype=np.int64)
    if not n:
        return order, lcp

    def ranked(slots: np.ndarray, new: np.ndarray) -> None:
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))

    rank = np.empty(n, dtype=np.int32)     # the slot of the first suffix with the same prefix
    ranked(place, np.r_[True, tokens[order][1:] != tokens[order][:-1]])
    levels, h = [rank.copy()], 1
    while True:
        own = np.r_[rank[order], -1]
        same = own[1:] == own[:-1]
        slots = np.flatnonzero(same | np.r_[False, same[:-1]])
        at = order[slots]
        if not len(at) or left[at].max() <= h:
            break
        after = np.where(left[at] > h, rank[np.minimum(at + h, n - 1)] + 1, 0)
        key = rank[at].astype(np.int64) * (n + 1) + after
        by = np.argsort(key, kind="stable")
        order[slots], key = at[by], key[by]
        ranked(slots, np.r_[True, key[1:] != key[:-1]])
        levels.append(rank.copy())
        h *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    shared, most = lcp[1:], np.minimum(left[a], left[b])
    for level in range(len(levels) - 1, -1, -1):
        go = np.flatnonzero(shared < most)
        go = go[levels[level][a[go]] == levels[level][b[go]]]
        shared[go] += 1 << level
        a[go] = np.minimum(a[go] + (1 << level), n - 1)
        b[go] = np.minimum(b[go] + (1 << level), n - 1)
    np.minimum(shared, most, out=shared)
    return order, lcp


def _stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Concatenated token stream: token hashes, each token's text, and the texts' first tokens."""
    t = Texts(pa.array(texts, pa.large_string()))
    starts, ends, first = t.words()
    return t.hashes(starts, ends), np.repeat(np.arange(t.n), np.diff(first)), first


def _page_windows(h: np.ndarray, row: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``run`` tokens lie in one page, and the hashes of those."""
    w = windows(h, run)
    at = np.flatnonzero(row[:len(w)] == row[run - 1:]) if len(w) else np.zeros(0, dtype=np.int64)
    return at, w[at].view(np.int64)


#: a shard tells of the prefixes that stand on this part of the share that counts, of its own pages
_TOLD = 0.25


def repeated_runs(pages: DataFrame, params: HtmlParams) -> DataFrame:
    """pages(host, page, words, packed), page a hash of the whole page -> (host, gram, seen): prefixes of
    ``run`` tokens of the repeats that stand on ``share`` of the host's distinct pages, and on
    ``pages`` of them or more; the longer repeats are the chains of these. They stand on ``seen`` or more.

    A page's copies are in one shard, so the pages of all shards add up. A shard leaves out
    prefixes that few of its pages hold; where these could decide, all pages are counted anew.
    """
    # stashed, so that the joins below can be broadcast or their skew split
    load = stash(pages.groupBy("host", "page").agg(F.max("words").alias("words")).groupBy("host")
                 .agg(F.expr(f"cast(ceil(sum(words) / {params.shard}) as int)").alias("shards"), F.count("*").alias("of")))
    dealt = (pages.join(load, "host").withColumn("shard", F.expr("cast(pmod(page, shards) as int)"))
             .select("host", "shard", "page", "of", "packed").repartition("host", "shard"))

    def run(key: tuple[pa.Scalar, ...], tab: pa.Table) -> pa.Table:
        _, once = np.unique(tab["page"].to_numpy(), return_index=True)   # copies count once
        h, row, _ = _stream(unpack(tab["packed"].take(pa.array(once))))
        order, lcp = suffix_array(h, row)
        at, grams = _page_windows(h, row, params.run)
        gram = np.zeros(len(h), dtype=np.int64)
        gram[at] = grams
        fits = np.zeros(len(h), dtype=bool)
        fits[at] = True
        # suffixes too short for a prefix share none; they stand alone among the groups
        new = lcp < params.run
        group = np.cumsum(new) - 1
        full = fits[order]
        pairs = np.unique(group[full] * np.int64(len(once)) + row[order[full]])   # group and page, once each
        seen = np.bincount(pairs // len(once), minlength=int(new.sum()))
        told = np.flatnonzero(seen >= max(1.0, _TOLD * params.share * len(once)))
        return pa.table({"host": pa.array([key[0].as_py()] * len(told), pa.string()),
                         "gram": pa.array(gram[order[np.flatnonzero(new)[told]]]), "seen": pa.array(seen[told].astype(np.int64)),
                         "read": pa.array(np.full(len(told), len(once))), "of": pa.array(np.full(len(told), tab["of"][0].as_py()))})

    told = dealt.groupBy("host", "shard").applyInArrow(run, "host string, gram long, seen long, read long, of long")
    enough = F.greatest(F.lit(float(params.pages)), params.share * F.col("of"))
    # in a shard that does not tell of it, a prefix stands on fewer of the pages than that part
    counted = stash(told.groupBy("host", "gram").agg(F.sum("seen").alias("seen"), F.sum("read").alias("read"), F.max("of").alias("of"))
                    .withColumn("sure", F.col("seen") >= enough)
                    .filter(F.col("sure") | (F.col("seen") + _TOLD * params.share * (F.col("of") - F.col("read")) >= enough)))
    doubtful = counted.filter(~F.col("sure")).select("host", "gram", "of")

    def grams(batches):
        for rb in _small(batches):
            h, row, _ = _stream(unpack(rb.column("packed")))
            at, gram = _page_windows(h, row, params.run)
            yield pa.RecordBatch.from_arrays([rb.column("host").take(pa.array(row[at])), rb.column("page").take(pa.array(row[at])),
                                              pa.array(gram)], names=["host", "page", "gram"])

    anew = (pages.join(doubtful.select("host").distinct(), "host", "left_semi").select("host", "page", "packed")
            .mapInArrow(grams, "host string, page long, gram long").join(doubtful, ["host", "gram"])
            .dropDuplicates(["host", "gram", "page"]).groupBy("host", "gram").agg(F.count("*").alias("seen"), F.max("of").alias("of"))
            .filter(F.col("seen") >= enough))
    return counted.filter("sure").select("host", "gram", "seen").unionByName(anew.select("host", "gram", "seen"))


def _kept(parts: list[tuple[int, int]], words: list[str], cover: np.ndarray, firm: np.ndarray, params: HtmlParams) -> list[str]:
    """The texts of the main text; ``cover`` and ``firm`` tell which of the page's tokens repeats
    cover, and which such on ``template`` pages."""
    inside = any(r in (ARTICLE, TEXT) for r, _ in parts)
    stays, n_stays, n_goes, n_copied, end = [], 0, 0, 0, 0
    for region, n in parts:
        at, end = end, end + n
        if region == CHROME or inside and region == OPEN:
            continue
        text = " ".join(words[at:end])
        marks = firm if inside else cover
        goes = region != TEXT and bool(marks[at:end].all()) and not is_prose(text, params)
        if goes:
            n_goes += n
        else:
            n_stays, n_copied = n_stays + n, n_copied + int(marks[at:end].sum())
        stays.append((goes, text))
    if inside and (n_goes >= n_stays or 2 * n_copied > n_stays):     # a copy, not a page that shares a template
        return [t for _, t in stays]
    return [t for goes, t in stays if not goes]


def _judged(cut: DataFrame, runs: DataFrame, params: HtmlParams) -> DataFrame:
    """(id, url, text): every page by its blocks and its host's repeats."""

    def run(batches):
        for rb in _small(batches):
            parts, texts, out = rb.column("parts").to_pylist(), unpack(rb.column("packed")), []
            h, row, first = _stream(texts)
            at, gram = _page_windows(h, row, params.run)
            cuts = np.searchsorted(at, first)
            runs_of = rb.column("runs")
            for i, page in enumerate(parts):
                size = int(first[i + 1] - first[i])
                cover, firm = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
                own = runs_of[i].values
                if own is not None and cuts[i + 1] > cuts[i]:
                    known, seen = own.field("gram").to_numpy(), own.field("seen").to_numpy()
                    mine, places = gram[cuts[i]:cuts[i + 1]], at[cuts[i]:cuts[i + 1]] - first[i]
                    for marks, of in ((cover, known), (firm, known[seen >= params.template])):
                        hit = places[np.isin(mine, of)]
                        for j in range(params.run):
                            marks[hit + j] = True
                out.append(" ".join(_kept([(p["region"], p["words"]) for p in page], texts[i].split(" "), cover, firm, params)))
            yield pa.RecordBatch.from_arrays([rb.column("id"), rb.column("url"), pa.array(out, pa.string())], names=["id", "url", "text"])

    known = stash(runs.groupBy("host").agg(F.collect_list(F.struct("gram", "seen")).alias("runs")))
    return cut.join(known, "host", "left").select("id", "url", "parts", "packed", "runs").mapInArrow(run, "id long, url string, text string")


def main_text(pages: DataFrame, params: HtmlParams | None = None, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars), one row per row of ``pages``.

    Null and empty html give an empty text, a null url the empty host. Pages of one
    content are one page to the suffix array, whatever their ids; other columns are ignored.
    """
    params = params or HtmlParams()
    cut = stash(cut_pages(pages, id_col, url_col, html_col))
    distinct = cut.filter(F.col("first") & (F.col("words") > 0)).select("host", "page", "words", "packed")
    return (_judged(cut, repeated_runs(distinct, params), params)
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars")))
