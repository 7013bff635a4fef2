"""Nulls, empty and repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from hebdo.llm import curriculum, html_extract, itq, licenses, packing, pii, quality, registry, setsketch, toxicity, url_rules
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, id long"
ROWS = [(1, None, None, None, None, "k", 1, 1), (2, "", "en", "a", 0, "k", 1, 1), (2, "", "en", "a", 0, "k", 1, 1),
        (3, " \t\n ", "en", "a", 4, None, None, None), (4, "one", "en", None, 3, "k", 1, 1),
        (5, "a b c d e f g h " * 5000, "en", "b", 1, "k", 1, 1), (6, "a b c d e f g h " * 5000, "de", "b", 1, "k", 1, 1),
        (None, "mail x@y.org now", "de", "b", 1, "k", 1, 1)]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(params=["rows", "empty"])
def docs(spark, request):
    return spark.createDataFrame(ROWS if request.param == "rows" else [], DOCS)


def count(df):
    return len(df.toPandas())


def test_every_document_operator_returns_every_row(spark, docs):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (99, 0, 1), (4, 1, 0), (4, 0, 0)], LABELS)
    n = docs.count()
    assert count(pii.digest(pii.find_pii(docs))) == n
    assert count(setsketch.near_duplicates(docs)) == n
    assert count(toxicity.toxicity(docs, labels)) == n
    assert count(toxicity.toxicity(docs, labels.limit(0))) == n
    assert count(quality.quality_rules(docs, labels)) == n
    assert count(quality.quality_rules(docs, labels.limit(0))) == n
    assert count(licenses.scan_licenses(docs)) == n
    assert count(curriculum.mix_plan(docs)) == n
    pieces = packing.pack(docs, registry.pack_params()).toPandas()
    assert (pieces.start == 0).sum() == n


def test_values_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    found = setsketch.near_duplicates(docs).toPandas()
    assert dict(zip(found.doc_id.fillna(-1), found.component_id.fillna(-1))) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, -1: -1}
    mixed = curriculum.mix_plan(docs).toPandas()
    assert (mixed.taken <= 2 * mixed["size"]).all() and mixed.taken.sum() > 0
    out = curriculum.mixed(docs, curriculum.mix_plan(docs)).toPandas()
    assert list(out.columns) == docs.columns
    assert abs(out.text.str.split().str.len().sum() - mixed.taken.sum()) <= mixed["size"].max() / 2
    assert set(out.text.dropna()) <= {r[1] for r in ROWS}  # whole texts, white space as it was


def test_stages_on_odd_rows(spark, docs, tmp_path):

    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).toPandas() is not None


def test_urls_and_pages(spark):
    rows = [(1, None, None), (2, "no scheme", ""), (3, "http://A.Example.NET/en/x?y#z", "<p>hello"), (None, "ftp://net/", "<"),
            (4, "http://x.net", "<article>a<b>b</b> &amp;<!-- c --><script>x</script><div class='share'>s</div><p>c</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = url_rules.rule_table(spark, registry.URL_RULES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, rules).collect()}
    assert got == {1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 4: ("x.net", "", None, "allow"),
                   3: ("a.example.net", "/en/x", "example.net/en/", "allow"), None: ("net", "/", "net/", "block")}
    text = {r.page_id: r.text for r in html_extract.main_text(pages).collect()}
    assert text == {1: "", 2: "", 3: "hello", None: "<", 4: "ab & c"}
    assert count(html_extract.main_text(pages.limit(0))) == count(url_rules.judge_urls(pages.limit(0), rules)) == 0


def test_pages_without_article_lose_what_their_host_repeats(spark):
    menu = "home news sport weather travel culture opinion contact about"
    pages = spark.createDataFrame(
        [(i, "http://h.org/%d" % i, f"<div>{menu}</div><div>{i} page has words of its own number {i}</div>") for i in range(3)],
        "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.main_text(pages, html_extract.HtmlParams(shard=10)).collect()}
    assert got == {i: f"{i} page has words of its own number {i}" for i in range(3)}


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.001]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]),
            (8, [None, 1.0]), (9, [0.0, 1.0]), (10, [1.0]), (None, [1.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_vectors(v).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), **{i: (0, i) for i in range(4, 11)}, None: (None, None)}
    assert count(itq.near_vectors(v.limit(0))) == 0


def test_exact_binomial_bound():
    assert abs(quality.binomial_upper(0, 100, 0.05) - (1 - 0.05 ** 0.01)) < 1e-9
    assert quality.binomial_upper(5, 5, 0.05) == 1.0


def test_segments_are_maximal():
    s = np.array([-1, 3, -1, 2, -9, 4, -1.0])
    assert toxicity.segments(s) == [(1, 4, 4.0), (5, 6, 4.0)]


def test_ids_at_the_first_place_of_the_bitmap(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "FILTER_BITS", 1)  # every id hashes to place 0
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(i, f"{text} {i % 2}") for i in range(4)] + [(9, "other words")], "id long, text string")
    ids = spark.createDataFrame([(1,), (9,)], "id long")
    got = setsketch._sets(docs, ids, setsketch.SketchParams()).collect()
    assert sorted(r.id for r in got) == [1, 9]


def test_components_of_one_family_meet(spark):
    """Whatever the blocks: links that join a family's components are found, few rows move for few outsiders."""
    r = np.random.default_rng(4)
    rows, sets = [], {}
    for i in range(90):
        centre = 0 if i < 60 else 1 + i % 6                    # one large component, several small ones
        base = np.arange(200) + 12 * centre                    # neighbouring centres overlap above 0.8
        own = np.sort(np.setdiff1d(base, r.choice(base, 3)).astype(np.uint64))
        sets[i] = set(own.tolist())
        rows.append((7, i, [0, 60, 61, 62, 63, 64, 65][centre], own))
    params = setsketch.SketchParams()
    regs = setsketch.sketch([mixed(s[3]) for s in rows], params)
    members = spark.createDataFrame(
        [(f, i, c, len(s), bytes(k.tobytes()), bytes(mixed(s).tobytes())) for (f, i, c, s), k in zip(rows, regs)],
        "family long, id long, comp long, n long, registers binary, shingles binary")
    near = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = {i: c for _, i, c, _ in rows}
    inside = [(i, c) for i, c in comp.items()]
    want = brute.components({**dict.fromkeys(sets, 0)}, near + inside)
    for size in (10, 1024):
        links = [(x.a, x.b) for x in setsketch._within_families(members, params, rows=size).collect()]
        assert links and set(links) <= {p for a, b in near for p in ((a, b), (b, a))}
        assert brute.components({**dict.fromkeys(sets, 0)}, links + inside) == want


def mixed(s):
    from hebdo.llm.tokens import mix
    return np.sort(mix(s))


@pytest.mark.parametrize("limit", [0, 2000, 16 << 20])
def test_encoder_with_little_memory_equals_the_tokenizer(limit):
    import pyarrow as pa

    from hebdo.llm.tokens import Texts

    enc = packing.Encoder(registry.pack_params().tokenizer, limit)
    odd = ["it's we'll I'd  two  \n\n three\t", "naïve café ÀÉÎ øß 12,345.67!", "—“quoted”… €5 ™", "русский текст", "中文 日本語", "",
           "\U0001F600 a\U0001F601", "x" * 5000, "<|endoftext|> a", "     x", "á", "a.b.c,d;e", "don't.", "x\u00a0y", "A1-B2_c3"]
    many = [f"word{i} other{i % 7}" for i in range(500)]
    for texts in (odd, many, odd[::-1], many + odd):
        for text, ids in zip(texts, enc.encode(Texts(pa.array(texts), lower=True))):
            assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_vectors_of_several_lengths(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.001]), (3, [0.0, 1.0]), (4, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.0]), (6, [2.0, 4.0, 6.001]), (7, [1.0])]
    v = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, id string, v int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_vectors(v).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (2, 4), 5: (2, 4), 6: (2, 4), 7: (0, 7)}


def test_long_runs_of_digits_take_linear_time():
    import time

    start = time.process_time()
    assert pii.base_spans("1" * 500_000 + " 1.2.3.4 " + "1." * 100_000)[:1] == [(500_001, 500_008, "ip")]
    assert time.process_time() - start < 3


def test_a_stash_leaves_the_session_as_it_was(spark):
    from hebdo.llm.common import ARROW_ROWS, SHUFFLE_CLEANUP, stash

    before = spark.conf.get(ARROW_ROWS), spark.conf.get(SHUFFLE_CLEANUP, None)
    assert stash(spark.range(3)).count() == 3
    assert (spark.conf.get(ARROW_ROWS), spark.conf.get(SHUFFLE_CLEANUP, None)) == before
