"""Chrome by class, and what the pages of a host share, where no article settles it."""

from __future__ import annotations

import pytest

from hebdo.llm import html_extract

SCHEMA = "page_id long, url string, html string"
MENU = "home news sport weather travel culture opinion contact about"


def texts(spark, pages, params=None):
    df = spark.createDataFrame([(i, "http://h.org/%d" % i, p) for i, p in enumerate(pages)], SCHEMA)
    return [r.text for r in sorted(html_extract.main_text(df, params).collect(), key=lambda r: r.page_id)]


@pytest.mark.parametrize("shard", [10, 400_000])
def test_copies_and_shared_passages_stay(spark, shard):
    quote = "four score and seven years ago our fathers brought forth a new nation"
    own = [f"page {i} tells a story number {i} of its own that nobody else tells" for i in range(6)]
    pages = [f"<div>{MENU}</div><div>{t}</div>" for t in own]
    pages[1] = f"<div>{MENU}</div><div>{own[1]}</div><div>{quote}</div>"
    pages[2] = f"<div>{MENU}</div><div>{own[2]} and {quote}</div>"
    want = own[:]
    want[1], want[2] = f"{own[1]} {quote}", f"{own[2]} and {quote}"
    pages += [pages[0]] * 8                      # copies count once
    assert texts(spark, pages, html_extract.HtmlParams(shard=shard)) == want + [own[0]] * 8


def test_two_copies_on_one_host_keep_their_text(spark):
    page = "<div>an only page without an article and twice on one host</div>"
    assert texts(spark, [page, page]) == ["an only page without an article and twice on one host"] * 2


def test_shared_prose_stays(spark):
    prose = "This paragraph stands on every page of the host, and it is prose."
    pages = [f"<div>{MENU}</div><p>{prose}</p><p>number {i}</p>" for i in range(4)]
    assert texts(spark, pages) == [f"{prose} number {i}" for i in range(4)]


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "with-ads", "search-results", "menu-closed", "widget", "search"])
def test_a_class_does_not_lose_the_article(name):
    for page in (f"<div class='{name}'><article>kept</article></div>", f"<article class='{name}'>kept</article>",
                 f"<main id={name}><p>kept</main>", f"<div class='{name} x'><div><main>kept</main></div></div>"):
        assert [t for r, t in html_extract.blocks(page) if r == html_extract.ARTICLE] == ["kept"]


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "share-buttons", "ad-slot-2", "x comments"])
def test_chrome_classes_are_chrome(name):
    page = f"<article>kept<div class='{name}'>gone</div></article>"
    assert html_extract.blocks(page) == [(html_extract.ARTICLE, "kept"), (html_extract.CHROME, "gone")]


def test_articles_of_comments_are_no_main_text():
    page = "<main>kept</main><div class='comments'><article>gone</article></div>"
    assert html_extract.blocks(page) == [(html_extract.ARTICLE, "kept"), (html_extract.CHROME, "gone")]


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "with-ads", "search-results", "menu-closed"])
def test_compounds_are_open(name):
    assert html_extract.blocks(f"<div class='{name}'>kept</div>") == [(html_extract.OPEN, "kept")]


@pytest.mark.parametrize("tag, name", [("div", "related work"), ("section", "social network analysis"), ("div", "login page"),
                                       ("p", "cookies"), ("h2", "search"), ("td", "menu")])
def test_words_of_a_topic_do_not_delete_blocks_of_an_article(tag, name):
    page = f"<article>one<{tag} class='{name}'>two</{tag}></article>"
    assert html_extract.blocks(page) == [(html_extract.ARTICLE, "one"), (html_extract.ARTICLE, "two")]


@pytest.mark.parametrize("page", ['<a ' * 300_000 + '"', '<a ' * 300_000 + '">x', '<a b="' * 300_000, "<a '" * 300_000 + '"',
                                  "<!--" * 300_000, "<![CDATA[" * 200_000, "<script>" * 200_000, "&" * 500_000, "<" * 500_000,
                                  "class=" * 200_000, "<div class=" + " " * 300_000, "<p>" * 200_000])
def test_malformed_pages_take_linear_time(page):
    import time
    start = time.process_time()
    html_extract.blocks(page)
    assert time.process_time() - start < 2


def test_unclosed_quotes():
    """The tag ends at its first ">"; a quote that closes holds any sign."""
    assert html_extract.blocks('<article><p class="x>hello</p>') == [(html_extract.ARTICLE, "hello")]
    assert html_extract.blocks("<article><p title=\"a>b\">hello</p><p id='y>there") == [
        (html_extract.ARTICLE, "hello"), (html_extract.ARTICLE, "there")]
    assert html_extract.blocks("<article>one<p class=") == [(html_extract.ARTICLE, "one")]


SHARE = "share tweet pin mail print save copy follow subscribe"


@pytest.mark.parametrize("shard", [10, 60, 400_000])
def test_articles_are_judged_by_their_host(spark, shard):
    """An unnamed menu in the articles of a host goes; what one page or prose has, and shared paragraphs, stay."""
    quote = "four score and seven years ago our fathers brought forth a new nation"
    own = [f"page {i} tells a story number {i} of its own {' '.join(f'word{i}x{j}' for j in range(12))}" for i in range(6)]
    pages = [f"<article><h1>{MENU}</h1><p>{t}</p><p>{quote}</p><ul><li>{SHARE}</ul><div>only here {t}</div></article>"
             f"<div>{SHARE}</div>" for t in own]
    pages += [pages[0]] * 8                      # copies count once
    want = [f"{MENU} {t} {quote} only here {t}" for t in own]
    assert texts(spark, pages, html_extract.HtmlParams(shard=shard)) == want + [want[0]] * 8


def test_an_article_that_is_mostly_a_copy_stays_whole(spark):
    lines = [f"line {i} of a poem without a stop that all repeat" for i in range(9)]
    poems = [lines[:i] + [f"a line that version {i} alone has and no other"] + lines[i:] for i in range(6)]
    pages = [f"<article>{'<br>'.join(p)}</article>" for p in poems]
    assert texts(spark, pages) == [" ".join(p) for p in poems]


def test_two_pages_make_no_template_of_articles(spark):
    pages = [f"<article><p>{' '.join(f'own{i}x{j}' for j in range(30))}</p><div>{SHARE}</div></article>" for i in range(2)]
    assert all(t.endswith(SHARE) for t in texts(spark, pages))


def test_rows_of_one_id_or_none_are_judged_each(spark):
    pages = [(i, f"<div>{MENU}</div><div>page {k} has some words of its own</div>") for k, i in enumerate([None, None, 7, 7])]
    df = spark.createDataFrame([(i, "http://h.org/", p) for i, p in pages], SCHEMA)
    got = sorted((r.page_id or 0, r.text) for r in html_extract.main_text(df).collect())
    assert got == [(0, "page 0 has some words of its own"), (0, "page 1 has some words of its own"),
                   (7, "page 2 has some words of its own"), (7, "page 3 has some words of its own")]


def test_suffix_array_against_brute_force():
    import random

    import numpy as np
    rng = random.Random(1)
    for trial in range(150):
        pages = [[rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randrange(1, rng.choice([3, 12, 40])))]
                 for _ in range(rng.randrange(1, 6))] + [[0, 1, 0, 1] * (trial % 4)]
        pages = [p for p in pages if p]
        suffixes = [p[i:] for p in pages for i in range(len(p))]
        order, lcp = html_extract.suffix_array(np.array(sum(pages, []), dtype=np.uint64),
                                               np.repeat(np.arange(len(pages)), [len(p) for p in pages]))
        got = [suffixes[i] for i in order]
        assert sorted(order.tolist()) == list(range(len(suffixes))) and got == sorted(suffixes)
        assert lcp.tolist() == [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                                      for a, b in zip(got, got[1:])]


@pytest.mark.parametrize("share", [0.1, 0.5])
@pytest.mark.parametrize("shard", [5, 1000, 100_000])
def test_repeats_against_brute_force(spark, shard, share):
    """Also where few pages of one shard and half of all hold a prefix."""
    import random

    from hebdo.llm.tokens import windows
    rng = random.Random(1)
    phrase = "one two three four five six seven eight nine"
    pages = []
    for i in range(64):                          # two shards are the even and the odd pages
        words = " ".join(str(rng.randrange(3)) for _ in range(20))
        pages.append((i, f"{words} {phrase if i % 2 == 0 and i or i == 1 else 'none'}"))
    rows = [("h", i, t.count(" ") + 1, html_extract.pack(t)) for i, t in pages + pages[1:2]]
    df = spark.createDataFrame(rows, "host string, page long, words long, packed binary")
    params = html_extract.HtmlParams(shard=shard, share=share)
    got = sorted(r.gram for r in html_extract.repeated_runs(df, params).collect())
    held: dict[str, set] = {}
    for i, t in pages:
        w = t.split()
        for a in range(len(w) - params.run + 1):
            held.setdefault(" ".join(w[a:a + params.run]), set()).add(i)
    want = [g for g, on in held.items() if len(on) >= max(params.pages, share * len(pages))]
    assert any(phrase.startswith(g) for g in want)
    h, _, _ = html_extract._stream(want)
    assert got == sorted(windows(h, params.run)[::params.run].view("int64").tolist())
