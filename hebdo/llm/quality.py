"""Quality rules with risk-controlled thresholds.

Counts of every whole text feed a few signals (higher is worse). For each
stratum and signal the cutoff is chosen on labelled documents: going from the
loosest cutoff of a fixed grid to the tightest, a cutoff is safe while the
exact (Clopper-Pearson) upper bound on the share of good documents it rejects
stays within the allowed risk. Walking in a fixed order needs no correction
within a signal; over signals and strata the error level and, over signals,
the risk are divided (Bonferroni). A stratum with too few labels gets no
cutoff and keeps its documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import record_batches, stash
from hebdo.llm.tokens import Texts, mix, windows

_U = np.uint64
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_BANG = np.zeros(256, dtype=bool)
_BANG[[ord(c) for c in "!?"]] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_INNER = (np.arange(256) & 0xC0) == 0x80  # UTF-8 continuation bytes
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bang"]

#: signal -> expression over the counts, 0 for texts without words
SIGNALS = {
    "symbols": "try_divide(n_symbols, word_chars)",
    "upper": "try_divide(n_upper, word_chars)",
    "bangs": "try_divide(n_bang, word_chars)",
    "dup_lines": "try_divide(n_dup_lines, n_lines)",
    "repeats": "try_divide(n_repeat_words, n_words)",
    "word_length": "try_divide(word_chars, 100 * n_words)",
}


@dataclass(frozen=True)
class RiskParams:
    risk: float = 0.02          # largest share of good documents a stratum may lose
    error: float = 0.05         # chance that any of the guarantees fails
    bins: int = 200             # cutoffs on the grid, 0 to 1
    gain: float = 5.0           # a cutoff must reject bad documents this much more often than good ones
    min_words: int = 20
    max_repeat_pct: int = 30


def text_counts(col: pa.Array) -> dict[str, np.ndarray]:
    t = Texts(col)
    starts, ends, first = t.words()
    n_words = np.diff(first)
    doc = np.repeat(np.arange(t.n), n_words)
    ink = ~_SPACE[t.data]
    salt = mix(np.arange(t.n, dtype=_U) + _U(1))

    newline = t.data == 10
    at = np.flatnonzero(newline)
    lo = np.sort(np.concatenate([t.offsets[:-1], at + 1]))
    hi = np.sort(np.concatenate([at, t.offsets[1:]]))
    lines = t.count(newline) + 1
    line_doc = np.repeat(np.arange(t.n), lines)
    inked = np.zeros(len(ink) + 1, dtype=np.int64)
    np.cumsum(ink, out=inked[1:])
    has = inked[hi] > inked[lo]
    key = mix(t.hashes(lo[has], hi[has]) ^ salt[line_doc[has]])
    dup = np.ones(len(key), dtype=bool)
    dup[np.unique(key, return_index=True)[1]] = False

    run = windows(t.hashes(starts, ends), 8)
    own = doc[:len(run)]
    inside = np.flatnonzero(own == doc[7:]) if len(run) else np.zeros(0, dtype=np.int64)
    wkey = mix(run[inside] ^ salt[own[inside]])
    order = np.argsort(wkey, kind="stable")
    srt = wkey[order]
    same = np.zeros(len(srt), dtype=bool)
    eq = srt[1:] == srt[:-1]
    same[1:] |= eq
    same[:-1] |= eq
    cover = np.zeros(len(doc) + 9, dtype=np.int64)
    np.add.at(cover, inside[order[same]], 1)
    np.add.at(cover, inside[order[same]] + 8, -1)
    repeated = np.cumsum(cover)[:len(doc)] > 0

    return {"n_words": n_words, "word_chars": t.count(ink & ~_INNER[t.data]), "n_symbols": t.count(_SYMBOL[t.data]),
            "n_dup_lines": np.bincount(line_doc[has][dup], minlength=t.n),
            "n_repeat_words": np.bincount(doc[repeated], minlength=t.n),
            "n_lines": np.bincount(line_doc[has], minlength=t.n), "n_upper": t.count(_UPPER[t.data]),
            "n_bang": t.count(_BANG[t.data])}


def with_counts(docs: DataFrame, id_col: str, stratum_col: str, text_col: str) -> DataFrame:
    """(id, stratum, counts...): one pass over whole texts; a null text counts as empty."""

    def run(batches):
        for rb in record_batches(batches, "text"):
            c = text_counts(rb.column("text"))
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), rb.column("stratum"), *(pa.array(c[k].astype(np.int64)) for k in COUNTS)],
                names=["id", "stratum", *COUNTS])

    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col), F.lit("")).alias("stratum"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, f"id {docs.schema[id_col].dataType.simpleString()}, stratum string, "
             + ", ".join(f"{k} long" for k in COUNTS))


def binomial_upper(k: int, n: int, error: float) -> float:
    """Exact upper confidence bound on a proportion: the p at which P(X <= k) = error."""
    if n == 0 or k >= n:
        return 1.0

    def below(p: float) -> float:
        return sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p))
                   for i in range(k + 1))

    lo, hi = k / n, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if mid < 1 and below(mid) > error else (lo, mid)
    return hi


def choose_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, error: float, gain: float) -> float | None:
    """good, bad: documents per bin. The safe cutoff (a bin edge; more is rejected) with the most gain."""
    n, m, bins = int(good.sum()), int(bad.sum()), len(good)
    best, arg = 0.0, None
    for edge in range(bins, -1, -1):  # reject bins >= edge
        k, hit = int(good[edge:].sum()), int(bad[edge:].sum())
        if binomial_upper(k, n, error) > risk:
            break
        won = (hit / m if m else 0.0) - gain * (k / n)
        if won > best:
            best, arg = won, edge / bins
    return arg


def _signal(name: str) -> str:
    return f"least(1D, coalesce({SIGNALS[name]}, 0D))"


def cutoffs(counts: DataFrame, labels: DataFrame, params: RiskParams) -> DataFrame:
    """(stratum, signal, cutoff) from labels(id, good); cutoff null: none is safe and useful."""
    labelled = counts.join(labels, "id").filter("good is not null")
    bins = params.bins
    stacked = ", ".join(f"'{s}', cast(least({bins - 1}, floor({_signal(s)} * {bins})) as int)" for s in SIGNALS)
    hist = (labelled.select("stratum", "good", F.expr(f"stack({len(SIGNALS)}, {stacked}) as (signal, bin)"))
            .groupBy("stratum", "signal", "bin")
            .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")))
    # every stratum of the data counts as a test, whether or not labels reach it
    tests = counts.select("stratum").distinct().agg((F.count("*") * len(SIGNALS)).alias("tests"))

    def choose(pdf):
        import pandas as pd  # only here: the workers that read texts do without

        good, bad = np.zeros(bins, dtype=np.int64), np.zeros(bins, dtype=np.int64)
        np.add.at(good, pdf["bin"], pdf["good"])
        np.add.at(bad, pdf["bin"], pdf["bad"])
        cut = choose_cutoff(good, bad, params.risk / len(SIGNALS), params.error / pdf["tests"][0], params.gain)
        return pd.DataFrame({"stratum": pdf["stratum"][:1], "signal": pdf["signal"][:1], "cutoff": [cut]})

    return (hist.crossJoin(F.broadcast(tests)).groupBy("stratum", "signal")
            .applyInPandas(choose, "stratum string, signal string, cutoff double"))


def quality_rules(docs: DataFrame, labels: DataFrame, params: RiskParams | None = None, id_col: str = "doc_id",
                  stratum_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id_col, counts..., base_failed, kept, failed_signal), one row per row of ``docs``.

    labels: (id_col, quality 0/1); repeated labels of one id count once, as bad
    if any is 0; null labels and unknown ids are ignored. A null text counts as
    empty and fails the base rule; a null stratum is a stratum of its own.
    """
    params = params or RiskParams()
    counts = stash(with_counts(docs, id_col, stratum_col, text_col))
    chosen = _chosen(counts, labels, params, id_col)
    return (counts.join(chosen, "stratum", "left").withColumn("base_failed", _base_failed(params))
            .withColumn("failed_signal", _failed_signal())
            .select(F.col("id").alias(id_col), *COUNTS, "base_failed",
                    (~F.col("base_failed") & F.col("failed_signal").isNull()).alias("kept"), "failed_signal"))


def _base_failed(params: RiskParams):
    return F.expr(f"n_words < {params.min_words} or 100 * n_repeat_words > {params.max_repeat_pct} * n_words")


def _failed_signal():
    return F.coalesce(*(F.expr(f"case when {_signal(s)} >= cut_{s} then '{s}' end") for s in SIGNALS))


def _chosen(counts: DataFrame, labels: DataFrame, params: RiskParams, id_col: str) -> DataFrame:
    """(stratum, cut_<signal>...): one row per stratum that labels reach."""
    good = (labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col(id_col).alias("id")).agg((F.min("quality") == 1).alias("good")))
    return (stash(cutoffs(counts, good, params)).groupBy("stratum")
            .agg(*(F.max(F.when(F.col("signal") == s, F.col("cutoff"))).alias(f"cut_{s}") for s in SIGNALS)))


def keep_good(docs: DataFrame, labels: DataFrame, params: RiskParams | None = None, id_col: str = "doc_id",
              stratum_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps. A second pass counts again and
    judges row by row, so no text is shuffled."""
    params = params or RiskParams()
    chosen = _chosen(stash(with_counts(docs, id_col, stratum_col, text_col)), labels, params, id_col)
    # a cutoff takes hundreds of labelled documents of its stratum, so few rows have any
    chosen = chosen.filter(F.coalesce(*(F.col(f"cut_{s}") for s in SIGNALS)).isNotNull())
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = plain.columns[docs.columns.index(text_col)]
    stratum = plain.columns[docs.columns.index(stratum_col)]

    def run(batches):
        for rb in record_batches(batches, text):
            c = text_counts(rb.column(text))
            yield pa.RecordBatch.from_arrays([*rb.columns, *(pa.array(c[k].astype(np.int64)) for k in COUNTS)],
                                             names=[*rb.schema.names, *COUNTS])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema), *(f"{k} long" for k in COUNTS)])
    judged = (plain.mapInArrow(run, schema).withColumn("stratum", F.coalesce(F.col(stratum), F.lit("")))
              .join(F.broadcast(chosen), "stratum", "left"))
    return (judged.filter(~_base_failed(params) & _failed_signal().isNull())
            .select(*(F.col(p).alias(c) for p, c in zip(plain.columns, docs.columns))))
