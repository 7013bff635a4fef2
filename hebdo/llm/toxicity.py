"""Toxicity as maximum-scoring segments of token log-odds.

A token carries several features: itself and its leading bytes, so stems count
in compounds. Feature log-odds of toxic against clean labelled documents use an
informative Dirichlet prior, the feature counts of the whole corpus. A token
scores the largest log-odds among its significant features, all others a small
negative drift. A linear-time scan finds
every maximal-scoring segment of a document; extreme-value statistics turn
segment scores into expected counts by chance, lambda from the clean token
scores and K from the clean documents' best segments. A logistic model
calibrates the best segment and what the significant ones add up to.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import record_batches, stash
from hebdo.llm.tokens import Texts, mix

_U = np.uint64
_OTHER = np.ones(256, dtype=bool)
_OTHER[48:58] = _OTHER[97:123] = _OTHER[128:] = False  # tokens: lower-case letters, digits, non-ASCII
BUCKET_BITS = 18


@dataclass(frozen=True)
class ToxicParams:
    sample: int = 20_000      # labelled rows that the model is fitted on, at most
    lexicon: int = 20_000     # features with a score of their own, at most
    prior: float = 500.0      # tokens' worth of corpus-wide prior
    z: float = 4.5
    documents: int = 3        # toxic documents that a feature must stand in
    drift: float = 0.25
    expect: float = 0.01      # a segment is significant when chance yields fewer per document


@dataclass(frozen=True)
class ToxicModel:
    tokens: np.ndarray        # sorted hashes
    scores: np.ndarray
    drift: float
    lam: float
    k: float
    expect: float


_STEMS = (4, 5, 6, 7, 8, 9)   # bytes


def _tokens(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return t.words(_OTHER)


def _features(t: Texts, starts: np.ndarray, ends: np.ndarray):
    """(which tokens, their hashes) for the whole token and each length of stem."""
    yield np.arange(len(starts)), t.hashes(starts, ends)
    for n in _STEMS:
        at = np.flatnonzero(ends - starts > n)
        yield at, mix(t.hashes(starts[at], starts[at] + n) ^ _U(n))


def feature_counts(docs: DataFrame) -> DataFrame:
    """docs(text, toxic) -> (kind, key, n, toxic, clean, toxic_docs, clean_docs): kind 0 counts
    all features by bucket, kind 1 the labelled documents' features by hash. Each task adds up
    its buckets first."""
    names = ["n", "toxic", "clean", "toxic_docs", "clean_docs"]

    def batch(kind: int, key: np.ndarray, *counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), kind, dtype=np.int32)), *(pa.array(x.astype(np.int64)) for x in (key, *counts))],
            names=["kind", "key", *names])

    def run(batches):
        every = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for rb in record_batches(batches, "text"):
            t = Texts(rb.column("text"), lower=True)
            starts, ends, first = _tokens(t)
            doc = np.repeat(np.arange(t.n), np.diff(first))
            label = np.array([-1 if x is None else x for x in rb.column("toxic").to_pylist()])
            for at, h in _features(t, starts, ends):
                every += np.bincount((h >> _U(64 - BUCKET_BITS)).astype(np.int64), minlength=len(every))
                used = label[doc[at]] >= 0
                if used.any():
                    key, inverse = np.unique(h[used], return_inverse=True)
                    own = doc[at][used]
                    tox = label[own] == 1
                    pair = np.unique(inverse.astype(np.int64) * t.n + own)   # a document counts once
                    in_tox = label[pair % t.n] == 1
                    add = [np.bincount(x, minlength=len(key)) for x in (
                        inverse, inverse[tox], inverse[~tox], (pair // t.n)[in_tox], (pair // t.n)[~in_tox])]
                    yield batch(1, key.view(np.int64), *add)
        at = np.flatnonzero(every)
        zero = np.zeros(len(at), dtype=np.int64)
        yield batch(0, at, every[at], zero, zero, zero, zero)

    return (docs.select("text", "toxic").mapInArrow(run, "kind int, key long, " + ", ".join(f"{c} long" for c in names))
            .groupBy("kind", "key").agg(*(F.sum(c).alias(c) for c in names)))


def fit(counts: DataFrame, params: ToxicParams, documents: tuple[int, int]) -> ToxicModel:
    """documents: toxic and clean ones of the sample. The driver sees 2**18 buckets and the
    features of several toxic documents of that bounded sample, at most ``lexicon`` by
    surplus: nothing that grows with the corpus."""
    bucket = np.zeros(1 << BUCKET_BITS)
    rows = counts.filter("kind = 0").select("key", "n").toPandas()
    bucket[rows["key"].to_numpy()] = rows["n"]
    d_tox, d_clean = (max(d, 1) for d in documents)
    n_tox, n_clean = counts.filter("kind = 1").agg(F.sum("toxic"), F.sum("clean")).first()
    n_tox, n_clean = n_tox or 0, n_clean or 0
    surplus = F.col("toxic_docs") / d_tox - F.col("clean_docs") / d_clean
    some = (counts.filter(f"kind = 1 and toxic_docs >= {params.documents}").filter(surplus > 0)
            .orderBy(surplus.desc(), "key").limit(params.lexicon).toPandas())
    key = some["key"].to_numpy().astype(np.int64).view(_U)
    tox, clean, d_t, d_c = (some[c].to_numpy(float) for c in ("toxic", "clean", "toxic_docs", "clean_docs"))
    prior = params.prior * bucket[(key >> _U(64 - BUCKET_BITS)).astype(np.int64)] / max(bucket.sum(), 1)

    def odds(y: np.ndarray, n: float) -> np.ndarray:
        return np.log((y + prior) / np.maximum(n + params.prior - y - prior, 1e-9))

    delta = odds(tox, n_tox) - odds(clean, n_clean)
    pooled = (d_t + d_c) / (d_tox + d_clean)

    def gain(k: np.ndarray, n: int) -> np.ndarray:
        p = np.clip(k / n, 1e-12, 1 - 1e-12)
        return k * np.log(p / pooled) + (n - k) * np.log((1 - p) / np.maximum(1 - pooled, 1e-12))

    z = np.sqrt(np.maximum(2 * (gain(d_t, d_tox) + gain(d_c, d_clean)), 0))  # root of the likelihood ratio
    keep = (z >= params.z) & (delta > 0)
    order = np.argsort(key[keep])
    tokens, scores = key[keep][order], delta[keep][order]
    # clean score distribution: lambda solves E[exp(lambda s)] = 1 (drift < 0 makes it unique)
    rate = (clean[keep][order] + prior[keep][order]) / (n_clean + params.prior)
    rest = max(1e-9, 1 - rate.sum())

    def excess(lam: float) -> float:
        return float((rate * np.expm1(lam * scores)).sum() + rest * np.expm1(-lam * params.drift))

    lo, hi = 1e-6, 1e-6
    while len(scores) and excess(hi) < 0 and hi < 50:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
    lam = max((lo + hi) / 2, 1e-3)
    return ToxicModel(tokens, scores, params.drift, lam, 0.1, params.expect)


def score_tokens(t: Texts, starts: np.ndarray, ends: np.ndarray, model: ToxicModel) -> np.ndarray:
    s = np.full(len(starts), -model.drift)
    if len(model.tokens):
        for which, h in _features(t, starts, ends):
            at = np.minimum(np.searchsorted(model.tokens, h), len(model.tokens) - 1)
            hit = model.tokens[at] == h
            s[which[hit]] = np.maximum(s[which[hit]], model.scores[at[hit]])
    return s


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, sum) of one document in linear time."""
    up = np.flatnonzero(score > 0)
    total = np.concatenate([[0.0], np.cumsum(score)])
    out: list[list[float]] = []  # start, end, cumulative before, cumulative after
    for i in up:
        seg = [int(i), int(i) + 1, total[i], total[i + 1]]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= seg[2]:
                j -= 1
            if j < 0 or out[j][3] >= seg[3]:
                out.append(seg)
                break
            seg = [out[j][0], seg[1], out[j][2], seg[3]]
            del out[j:]
    return [(int(a), int(b), float(r - l)) for a, b, l, r in out]


def estimate_k(best: np.ndarray, n_tokens: np.ndarray, lam: float, otherwise: float) -> float:
    """K from the best segments of clean documents: their K n exp(-lam best) are exponential
    with mean 1; those without any segment are known to lie below the smallest one."""
    some = best > 0
    if not some.any():
        return otherwise
    return float(some.sum() / (np.maximum(n_tokens, 1) * np.exp(-lam * np.where(some, best, best[some].min()))).sum())


def passages(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, best, evidence, passages): best segment score; -log of the expected number
    of such segments by chance, added up over the significant segments (of the best one, where
    none is); and the significant passages as (start, end, score) in bytes."""
    schema = ("id long, n_tokens long, best double, evidence double, "
              "passages array<struct<start:int,end:int,score:double>>")

    def run(batches):
        for rb in record_batches(batches, "text"):
            t = Texts(rb.column("text"), lower=True)
            starts, ends, first = _tokens(t)
            s = score_tokens(t, starts, ends, model)
            above = np.zeros(len(s) + 1, dtype=np.int64)
            np.cumsum(s > 0, out=above[1:])
            best, evidence, found = [], [], []
            for i in range(t.n):
                lo, hi = first[i], first[i + 1]
                seg = segments(s[lo:hi]) if above[hi] > above[lo] else []
                chance = np.log(model.k * max(hi - lo, 1))
                best.append(max((x for _, _, x in seg), default=0.0))
                sure = [(a, b, x) for a, b, x in seg if model.lam * x - chance > -np.log(model.expect)]
                evidence.append(sum(model.lam * x - chance for _, _, x in sure) if sure else model.lam * best[-1] - chance)
                found.append([{"start": int(starts[lo + a] - t.offsets[i]), "end": int(ends[lo + b - 1] - t.offsets[i]), "score": x}
                              for a, b, x in sure])
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), pa.array(np.diff(first).astype(np.int64)), pa.array(best, pa.float64()),
                 pa.array(evidence, pa.float64()),
                 pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))],
                names=["id", "n_tokens", "best", "evidence", "passages"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps for a ridge logistic regression; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def calibrate(best: np.ndarray, evidence: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and weights of log1p(best) and asinh(evidence). More segments never count
    against toxicity: where the two trade off with opposite signs, the evidence stands alone."""
    if len(set(y)) < 2:
        return np.array([-4.0, 0.0, 0.0])
    b = logistic(np.column_stack([np.log1p(best), np.arcsinh(evidence)]), y)
    if min(b[1:]) <= 0:
        alone = logistic(np.arcsinh(evidence)[:, None], y)
        b = np.array([alone[0], 0.0, alone[1]])
    return b


def toxicity(docs: DataFrame, labels: DataFrame, params: ToxicParams | None = None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id_col, score, predicted, n_tokens, passages), one row per row of ``docs``.

    labels: (id_col, toxic 0/1), the rows that may be learnt from; repeated ids
    count once (toxic if any says so), nulls not at all. Null and empty texts
    get the score of a document without segments. Without any labels every
    score is that of the intercept alone.
    """
    params = params or ToxicParams()
    sample = (labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
              .groupBy(F.col(id_col).alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("label_id"), "label_id").limit(params.sample))
    sample = stash(sample)  # at most params.sample rows: small enough to broadcast
    told = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), F.col("id") == F.col("label_id"), "left")
    toxic = sample.agg(F.sum("toxic"), F.count("*")).first()
    model = fit(stash(feature_counts(told)), params, (toxic[0] or 0, toxic[1] - (toxic[0] or 0)))
    clean = told.filter("toxic = 0").select("id", "text")
    fair = passages(clean, model, "id", "text").groupBy("id").agg(F.max("best").alias("best"), F.max("n_tokens").alias("n")).toPandas()
    model = replace(model, k=estimate_k(fair["best"].to_numpy(float), fair["n"].to_numpy(float), model.lam, model.k))
    seen = stash(passages(docs, model, id_col, text_col))
    known = seen.join(F.broadcast(sample), F.col("id") == F.col("label_id")).groupBy("id", "toxic").agg(
        F.max("best").alias("best"), F.max("evidence").alias("evidence")).orderBy("id").toPandas()
    b = calibrate(known["best"].to_numpy(float), known["evidence"].to_numpy(float), known["toxic"].to_numpy(float))
    z = F.lit(float(b[0])) + F.lit(float(b[1])) * F.log1p("best") + F.lit(float(b[2])) * F.asinh("evidence")
    return (seen.withColumn("score", 1 / (1 + F.exp(-z)))
            .select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    "n_tokens", "passages"))
