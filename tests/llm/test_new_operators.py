"""Spelling variants, source divergence and bin completion against brute force and on odd rows."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hebdo.llm import completion, divergence, registry, spelling
from hebdo.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, word string, n long, part int, term string, value long"
X = ("x", 1, 1, "x", 1)
ODD = [(1, None, None, None, *X), (2, "", "en", "a", *X), (2, "", "en", "a", *X), (3, " \t\n ", "en", "a", None, None, None, None, None),
       (4, "one", "en", None, *X), (5, "Apples apples Äpples " * 400, "en", "b", *X), (6, "apples pples " * 300, "de", "b", *X),
       (None, "apple apples \U0001F600 中文 x@y.org <|endoftext|>", "de", "b", *X), (7, "z" * 30000, "en", "b", *X)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


# ------------------------------------------------------------------ spelling

def one_edit(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def variants(rows, shortest=5, fewest=3) -> dict[str, tuple]:
    n: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = brute.lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= fewest}
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def as_dict(df) -> dict:
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_equals_all_pairs(spark):
    docs = table(spark, SF, "documents")
    got = as_dict(registry.QUERIES["op11_prefix_suffix_spelling"](spark, SF))
    assert got == variants([(r.doc_id, r.text) for r in docs.collect()])


def test_near_words_of_random_families(spark):
    """Few letters, so that groups are large; long words, so that wide windows are cut into blocks."""
    r = random.Random(5)
    base = "".join(r.choice("abc") for _ in range(90))
    words = {"".join(r.choice("aä") for _ in range(r.randint(5, 9))) for _ in range(400)}
    for _ in range(120):
        i, j = r.randrange(91), r.randrange(91)
        w = base[:i] + r.choice(["", "x", "y"]) + base[i + r.randint(0, 1):]
        words.add(w if r.random() < 0.5 else w[:j] + w[j + 1:])
    rows = [(w, r.randint(3, 9)) for w in sorted(words)]
    df = spark.createDataFrame(rows, "word string, n long")
    params = spelling.SpellingParams(windows=4, block=16, batch=64)
    got = {x.word: (x.n_near, x.best) for x in spelling.near_words(df, params).collect()}
    n, want = dict(rows), {}
    for w in n:
        near = [x for x in n if x != w and abs(len(x) - len(w)) < 2 and one_edit(x, w)]
        if near:
            want[w] = (len(near), min(near, key=lambda x: (-n[x], x)))
    assert got == want


def test_chains_of_forms_lead_to_their_last(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("a", "w7")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w40" for w, _ in chain}


def test_spelling_of_odd_rows(spark, odd):
    assert as_dict(spelling.spelling_variants(odd)) == variants([r[:2] for r in ODD])
    assert spelling.spelling_variants(odd.limit(0)).count() == 0
    twice = odd.union(odd)
    assert as_dict(spelling.spelling_variants(twice)) == variants([r[:2] for r in ODD] * 2)


# ------------------------------------------------------------------ divergence

def audit(rows, min_docs=10, top=10) -> set[tuple]:
    docs = [(lang or "", source or "", Counter(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(text or ""))))
            for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, c in mine for t in c)
        kept = [t for t, n in held.items() if n >= min_docs]
        counts = {s: Counter() for _, s, _ in mine}
        for _, s, c in mine:
            counts[s].update({t: c[t] for t in kept if c[t]})
        whole = sum(counts.values(), Counter())

        def shares(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(items)}
    return out


def as_set(df) -> set[tuple]:
    rows = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_divergence_equals_brute_force(spark):
    docs = table(spark, SF, "documents").select("text", "lang", "source").collect()
    got = as_set(registry.QUERIES["op12_level_product_divergence"](spark, SF))
    assert got == audit([tuple(r) for r in docs])


def test_divergence_over_many_blocks_and_groups(spark):
    """Blocks of a few groups and terms give the same as one block."""
    r = random.Random(3)
    rows = [(" ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.randint(0, 60))), "en", f"s{r.randint(0, 9)}")
            for _ in range(200)] + [("", "en", "none"), ("solo solo", "xx", "alone"), (None, None, None)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    params = divergence.DivergenceParams(groups=3, rare_terms=2, frequent_terms=4, rare=4)
    assert as_set(divergence.divergence(df, params)) == audit(rows) == as_set(divergence.divergence(df))


def test_divergence_of_odd_rows(spark, odd):
    rows = [(r[1], r[2], r[3]) for r in ODD]
    assert as_set(divergence.divergence(odd)) == audit(rows)
    many = odd
    for _ in range(4):
        many = many.union(many)
    assert as_set(divergence.divergence(many)) == audit(rows * 16)
    assert divergence.divergence(odd.limit(0)).count() == 0


def test_shares_of_huge_counts_are_exact(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(10**13, 3 * 10**13 + 1, 7)], "c long, n long, v long")
    p = df.select(divergence._share(F.col("c"), F.col("n"), F.col("v"), divergence.DivergenceParams()).alias("p")).first().p
    assert p == 1 + 10**9 * (10**13 + 2) // (3 * 10**13 + 1 + 14)


# ------------------------------------------------------------------ bin completion

def least_bins(items: tuple[int, ...], size: int) -> int:
    """Exhaustive: each item, longest first, into every different room."""
    best = len(items)

    def place(i: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= items[i]}):
            left = list(rooms)
            left.remove(room)
            place(i + 1, [*left, room - items[i]])
        place(i + 1, [*rooms, size - items[i]])

    place(0, [])
    return best


def check_plan(plan, counts, size) -> int:
    got: Counter = Counter()
    for filling, bins in plan:
        assert sum(s * n for s, n in filling) <= size and bins > 0
        for s, n in filling:
            got[s] += n * bins
    assert got == Counter({s: n for s, n in counts.items() if n})
    return sum(n for _, n in plan)


@pytest.mark.parametrize("seed", range(12))
def test_completion_finds_the_least_bins(seed):
    r = random.Random(seed)
    items = tuple(sorted((r.randint(3, 30) for _ in range(11)), reverse=True))
    counts = Counter(items)
    params = completion.CompletionParams("", length=40, branches=50)
    used = check_plan(completion.complete_bins(counts, params), counts, 40)
    assert completion.lower_bound(counts, 40) <= least_bins(items, 40) == used


def test_completion_beats_best_fit():
    """Best fit decreasing opens a bin more than needed (sizes of a known bad case)."""
    counts = Counter({51: 6, 27: 6, 26: 6, 23: 6 * 2, 25: 6})
    params = completion.CompletionParams("", length=101, branches=20)
    greedy = check_plan(completion.best_fit_decreasing(counts, 101), counts, 101)
    assert check_plan(completion.complete_bins(counts, params), counts, 101) <= greedy


def test_plans_of_large_counts_stay_near_the_bound():
    r = random.Random(1)
    counts = Counter({s: r.randint(1, 10**7) for s in range(1, 1025)})
    params = completion.CompletionParams("", nodes=50)
    used = check_plan(completion.complete_bins(counts, params), counts, 1024)
    assert used <= 1.002 * completion.lower_bound(counts, 1024)
    assert completion.complete_bins({}, params) == []


def test_fillings_are_undominated_and_fit():
    counts = {1: 0, 3: 2, 5: 1, 7: 1, 8: 1}
    found = completion.fillings(counts, 11, 20)
    assert found[0] == ((8, 1), (3, 1)) and all(sum(s * n for s, n in f) <= 11 for f in found)
    assert ((3, 2), (5, 1)) not in found         # 3 + 5 stands for 8


def packed(df, docs, params):
    from tokenizers import Tokenizer

    got = df.toPandas()
    tok = Tokenizer.from_file(params.tokenizer)
    tok.encode_special_tokens = True
    want = []
    for doc, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [params.end_id]
        first = (len(ids) - 1) % params.length + 1
        for piece, end in enumerate(range(first, len(ids) + 1, params.length)):
            start = end - params.length if piece else 0
            want.append((-1 if doc is None else doc, piece, start, end - start, brute.crc(np.array(ids[start:end]))))
    told = [tuple(int(x) for x in r) for r in
            got[["doc_id", "piece", "start", "length", "ids_crc32"]].fillna(-1).itertuples(index=False)]
    assert sorted(told) == sorted(want)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= params.length
    return got.sequence_id.nunique(), Counter(got.length.tolist())


def test_bin_completion_packing(spark):
    params = registry.completion_params()
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    used, counts = packed(registry.QUERIES["op13_bin_completion_packing"](spark, SF), docs, params)
    assert used <= completion.lower_bound(counts, 1024) + 2


def test_packing_of_odd_rows(spark, odd):
    params = registry.completion_params()
    packed(completion.best_fit_pack(odd, params), [r[:2] for r in ODD], params)
    assert completion.best_fit_pack(odd.limit(0), params).count() == 0


def test_ranks_and_tokenizers_give_the_same_ids():
    import pyarrow as pa

    from hebdo.llm.tokens import Texts

    params = registry.completion_params()
    texts = ["it's we'll I'd  two  \n\n three\t", "naïve café ÀÉÎ øß 12,345.67", "—“quoted”… €5 ™", "русский текст", "ΑΒΓ δ", "中文 日本語",
             "\U0001F600 a\U0001F601", "x" * 5000, "<|endoftext|> a", "\x00\x01", "     x", "áë", ""]
    enc = completion.ByteEncoder(params)
    for text, ids in zip(texts, enc.encode(Texts(pa.array(texts)))):
        assert ids.tolist() == enc.slow.encode(text, add_special_tokens=False).ids, text
