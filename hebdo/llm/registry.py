"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.llm import (
    completion, curriculum, divergence, html_extract, itq, licenses, packing, pii, quality, setsketch, spelling, toxicity,
    url_rules,
)
from hebdo.llm.common import table

#: host and path rules (fixed values)
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def pack_params() -> packing.PackParams:
    import public_tokenizers

    return packing.PackParams(tokenizer=str(public_tokenizers.path("word_bpe_49k.json")))


def completion_params() -> completion.CompletionParams:
    import public_tokenizers

    return completion.CompletionParams(
        tokenizer=str(public_tokenizers.path("byte_bpe_50k.json")),
        ranks=str(public_tokenizers.path("byte_bpe_50k.tiktoken")), pattern=public_tokenizers.PATTERN)


def op1_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op2_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), setsketch.SketchParams(shingle=4))


def op3_url_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


def op4_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op5_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), pack_params())


def op6_iterative_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "first_position")


def op8_max_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted",
                         F.size("passages").alias("n_passages"))


def op9_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed_signal")


def op10_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_prefix_suffix_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_level_product_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_bin_completion_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completion.best_fit_pack(table(spark, sf_dir, "documents"), completion_params())


QUERIES = {f.__name__: f for f in (
    op1_weak_supervision_pii, op2_setsketch_near_dedup, op3_url_range_join, op4_host_suffix_array,
    op5_bounded_space_packing, op6_iterative_quantisation, op7_curriculum_mix, op8_max_segment_toxicity,
    op9_risk_controlled_quality, op10_rare_token_licenses, op11_prefix_suffix_spelling, op12_level_product_divergence,
    op13_bin_completion_packing)}

ORACLE = {
    "op3_url_range_join": """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fit AS (
  SELECT p.page_id, p.host, p.path, r.verdict, r.rhost || r.rpath AS rule,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost || r.rpath) DESC) AS n
  FROM p LEFT JOIN r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE n = 1
""",
    "op11_prefix_suffix_spelling": r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), run AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), own AS (
  SELECT doc, run, count(*) AS n, hex(encode(doc || ':' || run)) AS code FROM run WHERE length(run) >= 5 GROUP BY doc, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(code), 2), lambda i: ('0x' || code[i:i + 1])::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h
  FROM own, crc
), w AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gap AS (
  SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w
), part AS (
  SELECT word, n, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM gap
), near AS (
  SELECT x.word, y.word AS other, y.n AS m FROM part x JOIN part y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM part x JOIN w y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word, x.n FROM part x JOIN w y ON y.word = x.a || x.b
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 2 * n THEN other END AS form,
         CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, coalesce(form, word) AS at FROM formed
  UNION
  SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.at WHERE formed.form IS NOT NULL
)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk USING (word) JOIN formed last ON last.word = walk.at AND last.form IS NULL
""",
    "op12_level_product_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (
  SELECT id, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10
), v AS (
  SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT lang, source, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) USING (lang, source)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (g.n + 2 * v.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.c + 2)) // (v.n + 2 * v.v)::HUGEINT AS q
  FROM g JOIN v USING (lang) JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 10
""",
}
