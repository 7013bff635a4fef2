"""What a document's segments add up to."""

from __future__ import annotations

import numpy as np

from hebdo.llm import toxicity


def corpus():
    rng = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(300):
        words = list(rng.choice(plain, 60 + 20 * (i % 5)))
        bad = i % 3 == 0
        if bad:
            for k in range(1 + i % 4):
                words[5 + 12 * k:7 + 12 * k] = ["vile", "scum"]
        elif i % 10 == 1:
            words[7] = "vile"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_many_passages_score_above_one(spark):
    rows, labels = corpus()
    filler = [f"w{i % 400}" for i in range(4000)]
    one, ten = filler[:], filler[:]
    one[200:202] = ["vile", "scum"]
    for k in range(10):
        ten[200 + 300 * k:202 + 300 * k] = ["vile", "scum"]
    docs = spark.createDataFrame(rows + [(1001, " ".join(one)), (1010, " ".join(ten))], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert got[1001].n_tokens == got[1010].n_tokens
    assert len(got[1010].passages) == 10 and len(got[1001].passages) == 1
    odds = {i: np.log(got[i].score / (1 - got[i].score)) for i in (1001, 1010)}
    assert odds[1010] > odds[1001] + 0.01    # by more than rounding


def test_k_is_found_again():
    rng = np.random.default_rng(1)
    n, lam, k = rng.integers(50, 2000, 20_000), 0.7, 0.03
    best = (np.log(k * n) - np.log(rng.exponential(size=len(n)))) / lam
    best = np.where(best < 1.0, 0.0, best)       # no segment is that small
    assert abs(toxicity.estimate_k(best, n, lam, 0.1) - k) < 0.002
    assert toxicity.estimate_k(np.zeros(3), np.ones(3), lam, 0.1) == 0.1
