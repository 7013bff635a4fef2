"""License scan over a positional rare-token index.

Template words that are no function words are indexed with their positions.
A template's rarest words (highest inverse document frequency over the whole
corpus) nominate it in the files that hold one of them: as many words as it
takes that the others alone could not line up enough of its weight. All licence
words of such a file are then looked up; postings of one template that agree on
the position relative to the file are added up, and a template counts once
enough of its weight lines up and its mandatory phrases stand in the file.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hebdo.llm.common import ascii_lower, stash, text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: base phrase -> label (fixed values)
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, text in words, mandatory phrases): public notices of well-known licences
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ["hereby granted free of charge"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["general public license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license",
     ["general public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license", ["creative commons"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ["source and binary forms"]),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
]

#: not indexed
FUNCTION_WORDS = set("the of to a is this in it or and any you can are with by under use on an 0 2 3 4 v".split())


@dataclass(frozen=True)
class LicenseParams:
    share: float = 0.6     # of the weight of a template's indexed words that has to line up


def _is(word: Column, words: list[str]) -> Column:
    return word.isin(words)


def scan_licenses(docs: DataFrame, params: LicenseParams | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score), a row per row of ``docs``.

    Words: runs of ASCII letters and digits and of non-ASCII characters, A-Z
    lower-cased. A null text has no words. Score is 1 with a base phrase, else
    the best share of a verified template, else 0. Null and repeated ids are
    scanned row by row; other columns are ignored.
    """
    params = params or LicenseParams()
    spark = docs.sparkSession
    indexed = sorted({w for _, text, _ in TEMPLATES for w in text.split()} - FUNCTION_WORDS)
    phrases = sorted({p for _, _, keys in TEMPLATES for p in keys} | set(BASE))

    spaced = F.concat(F.lit(" "), F.regexp_replace(ascii_lower(text_or_empty(text_col)), SEPARATORS, " "), F.lit(" "))
    # explode of one value: the cleaned text is computed once, whatever reads it
    rows = docs.select(F.col(id_col).alias("id"), F.explode(F.array(F.trim(spaced))).alias("clean"))
    padded = F.concat(F.lit(" "), F.col("clean"), F.lit(" "))
    rows = rows.select("id", F.when(F.col("clean") == "", F.array().cast("array<string>"))
                       .otherwise(F.split("clean", " ")).alias("w"),
                       F.array_compact(F.array(*(F.when(F.contains(padded, F.lit(f" {p} ")), F.lit(p)) for p in phrases)))
                       .alias("phrases"))
    at = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1)).otherwise(F.array().cast("array<int>"))
    hits = F.transform(F.filter(at, lambda i: _is(F.get("w", i), indexed)),
                       lambda i: F.struct(F.get("w", i).alias("word"), i.alias("pos")))

    def places(phrase: str) -> Column:
        words = phrase.split()

        def stands(i: Column) -> Column:
            return (F.get("w", i) == words[0]) & F.coalesce(
                F.lit(True) if len(words) == 1 else
                F.array_join(F.slice("w", i + 1, len(words)), " ") == phrase, F.lit(False))

        return F.when(F.array_contains("phrases", phrase),
                      F.transform(F.filter(at, stands), lambda i: F.struct(i.alias("pos"), F.lit(BASE[phrase]).alias("label"))))

    base = F.flatten(F.array_compact(F.array(*(places(p) for p in BASE))))
    scanned = stash(rows.select("id", F.size("w").cast("long").alias("n_words"), "phrases", hits.alias("hits"),
                                base.alias("base")).withColumn("row", F.monotonically_increasing_id()))

    hit = scanned.select("row", F.explode("hits").alias("h")).select("row", "h.word")
    seen = hit.groupBy("word", "row").agg(F.lit(1).alias("one")).groupBy("word").agg(F.count("*").alias("df"))
    n = scanned.agg(F.count("*").alias("n"))
    postings = spark.createDataFrame(
        [(t, label, w, i, keys) for t, (label, text, keys) in enumerate(TEMPLATES)
         for i, w in enumerate(text.split()) if w in indexed],
        "template int, label string, word string, at int, keys array<string>")
    # the index and its weights hold the words of TEMPLATES, nothing that grows
    idf = (seen.crossJoin(F.broadcast(n)).select("word", F.log((F.col("n") + 1) / (F.col("df") + 0.5)).alias("idf")))
    weighted = postings.join(idf, "word", "left").withColumn(
        "idf", F.coalesce("idf", F.lit(30.0)))  # absent from the corpus: rarer than any word there
    whole = weighted.groupBy("template").agg(F.sum("idf").alias("whole"))
    weighted = stash(weighted.join(whole, "template"))

    rarest_last = Window.partitionBy("template").orderBy("idf", F.col("word").desc())
    rare = (weighted.groupBy("template", "label", "whole", "keys", "word").agg(F.sum("idf").alias("idf"))
            .withColumn("without", F.sum("idf").over(rarest_last))  # the weight of this word and all commoner ones
            .filter(F.col("without") >= params.share * F.col("whole") - 1e-9)
            .groupBy("template", "label", "whole", "keys").agg(F.collect_list("word").alias("rare")))
    nominated = scanned.join(F.broadcast(rare), (F.size(F.array_except("keys", "phrases")) == 0)
                             & F.arrays_overlap(F.col("hits")["word"], F.col("rare")))
    lined_up = (nominated.select("row", "label", "template", "whole", F.explode("hits").alias("h"))
                .select("row", "label", "template", "whole", "h.word", "h.pos")
                .join(F.broadcast(weighted.select("template", "word", "at", "idf")), ["template", "word"])
                .groupBy("row", "label", "template", "whole", (F.col("pos") - F.col("at")).alias("shift"))
                .agg(F.sum("idf").alias("weight"))
                .withColumn("share", F.least(F.col("weight") / F.col("whole"), F.lit(1.0)))
                .filter(F.col("share") >= params.share))
    found = lined_up.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    labels = F.transform("base", lambda b: b["label"])
    places_at = F.transform("base", lambda b: b["pos"].cast("long"))
    return (scanned.drop("hits", "phrases").join(found, "row", "left")
            .select(F.col("id").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
                    F.array_min(places_at).alias("first_word"), F.array_max(places_at).alias("last_word"),
                    F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(labels, F.coalesce(
                        "more", F.array().cast("array<string>")))), ",").alias("labels"),
                    F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score")))
