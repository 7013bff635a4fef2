"""The histogram booster against a plain twin, its shards, its fits in bulk and its attributions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hebdo.operators import boosting as bo
from hebdo.operators import folds as fo
from hebdo.operators import trees as tr


def data(n=300, seed=0, kinds=40):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 6)) * kinds / 6) / kinds
    y = 1e6 * (3 + x[:, 0] + np.sin(4 * x[:, 1]) + x[:, 2] * x[:, 3]) + rng.normal(size=n) * 1e4
    return x, y, rng.integers(-2**63, 2**63 - 1, n)


PARAMS = bo.BoostParams(n_estimators=25, max_depth=3, learning_rate=0.2, subsample=0.8, colsample_bytree=0.7,
                        min_child_weight=3, gamma=0.5, reg_alpha=1.1, reg_lambda=2.5)


def plain_fit(x, y, row, p):
    """Exact greedy boosting, one node and one candidate cut at a time."""
    soft = lambda g: math.copysign(max(abs(g) - p.reg_alpha, 0), g)
    base = y.mean()
    predicted, rng = np.full(len(y), base), np.random.default_rng(p.seed)
    for r in range(p.n_estimators):
        columns = np.sort(rng.choice(x.shape[1], max(1, int(p.colsample_bytree * x.shape[1])), replace=False))
        seen = bo.row_draws(row, r, p.seed) < p.subsample
        g = predicted - y
        score = lambda m: soft(g[m & seen].sum()) ** 2 / ((m & seen).sum() + p.reg_lambda)

        def grow(mask, depth):
            best = (0.0, None, None)
            for f in columns if depth < p.max_depth else ():
                for c in np.unique(x[:, f])[1:]:
                    left, right = mask & (x[:, f] < c), mask & (x[:, f] >= c)
                    if min((left & seen).sum(), (right & seen).sum()) < p.min_child_weight:
                        continue
                    gain = score(left) + score(right) - score(mask)
                    if gain > best[0] * (1 + 1e-12):
                        best = (gain, f, c)
            if best[1] is None or best[0] < p.gamma:
                predicted[mask] -= p.learning_rate * soft(g[mask & seen].sum()) / ((mask & seen).sum() + p.reg_lambda)
            else:
                _, f, c = best
                grow(mask & (x[:, f] < c), depth + 1)
                grow(mask & (x[:, f] >= c), depth + 1)

        grow(np.ones(len(y), dtype=bool), 0)
    return predicted


def test_boosting_equals_the_plain_twin():
    x, y, row = data()
    want = plain_fit(x, y, row, PARAMS)
    forest = bo.boost(x, y, row, PARAMS)
    assert np.abs(forest.predict(x) / want - 1).max() < 1e-9
    again = bo.Forest.of_rows(forest.rows())
    assert (again.predict(x) == forest.predict(x)).all()


def test_bins_beyond_the_limit_lie_at_even_ranks():
    x = np.random.default_rng(1).normal(size=(5000, 1))
    cuts = bo.cut_points(x, 16)[0]
    assert len(cuts) == 15
    share = np.diff(np.searchsorted(np.sort(x[:, 0]), [-np.inf, *cuts, np.inf])) / 5000
    assert abs(share - 1 / 16).max() < 0.001


def test_missing_values_go_right_and_rows_without_label_do_not_train(spark):
    x = np.array([[1.0], [2.0], [np.nan], [3.0]] * 20)
    y = np.array([0.0, 0.0, 10.0, 10.0] * 20)
    p = bo.BoostParams(n_estimators=200, max_depth=1, learning_rate=0.5)
    assert np.allclose(bo.boost(x, y, np.arange(80), p).predict(x), y, atol=1e-3)
    rows = [(i, float(v) if v == v else None, float(t) if i % 8 else None) for i, (v, t) in enumerate(zip(x[:, 0], y))]
    df = spark.createDataFrame(rows, "id int, f double, y double")
    model = bo.fit_one(df, {"n_estimators": 200, "max_depth": 1, "learning_rate": 0.5}, ["f"], "y", ["id"])
    got = {r.id: r.predicted for r in model.transform(df).collect()}
    assert np.allclose([got[i] for i in range(80)], y, atol=1e-3)
    with pytest.raises(ValueError):
        bo.fit_one(df.limit(0), {}, ["f"], "y", ["id"])


def frame(spark, x, y):
    rows = [(i, float(t), *map(float, v)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, y double, " + ", ".join(f"f{j} double" for j in range(x.shape[1])))


def test_spread_rows_give_the_model_of_one_task(spark):
    x, y, _ = data(n=400)
    df, names = frame(spark, x, y), [f"f{j}" for j in range(6)]
    params = {k: getattr(PARAMS, k) for k in PARAMS.__dataclass_fields__} | {"n_estimators": 6}
    one = bo.fit_one(df, params, names, "y", ["id"])
    many = bo.fit_one(df, params, names, "y", ["id"], rows_per_task=150)
    assert (one.forest.feature == many.forest.feature).all() and (one.forest.cut == many.forest.cut).all()
    assert np.abs(one.forest.predict(x) / many.forest.predict(x) - 1).max() < 1e-9


def test_fits_in_bulk_equal_single_fits(spark):
    x, y, _ = data(n=200)
    df, names = frame(spark, x, y), [f"f{j}" for j in range(6)]
    split = F.floor(F.col("id") / 50).cast("int")
    rows = df.withColumns({"train_from": split, "test_at": split - 1})
    params = [bo.BoostParams(n_estimators=5, max_depth=d, subsample=0.9) for d in (2, 3)]
    fits = [bo.Fit(i, s, p) for i, p in enumerate(params) for s in range(3)]
    got = {(r.draw, r.split, r.id): r.predicted for r in bo.run_fits(rows, fits, names, "y", ["id"]).collect()}
    assert len(got) == 2 * 150
    sharded = bo.run_fits(rows, fits, names, "y", ["id"], rows_per_task=90).collect()
    assert {(r.draw, r.split, r.id) for r in sharded} == set(got)
    assert max(abs(r.predicted / got[r.draw, r.split, r.id] - 1) for r in sharded) < 1e-9
    for i, p in enumerate(params):
        model = bo.fit_one(df.where("id < 100"), {"n_estimators": 5, "max_depth": p.max_depth, "subsample": 0.9},
                           names, "y", ["id"])
        for r in model.transform(df.where("id >= 100 and id < 150")).collect():
            assert abs(r.predicted / got[i, 1, r.id] - 1) < 1e-9


def shapley_by_subsets(forest, x):
    """Shapley values from their definition, over all subsets of features."""
    n = x.shape[1]

    def value(known):
        total = np.full(len(x), forest.base)
        for r in range(len(forest.feature)):
            stack = [(0, np.ones(len(x)))]
            while stack:
                node, part = stack.pop()
                f = forest.feature[r, node]
                if f < 0:
                    total += part * forest.value[r, node]
                    continue
                left = (x[:, f] < forest.cut[r, node]) if f in known else \
                    forest.cover[r, 2 * node + 1] / forest.cover[r, node]
                stack += [(2 * node + 1, part * left), (2 * node + 2, part * (1 - left))]
        return total

    out = np.zeros(x.shape)
    for size in range(n):
        for j in range(n):
            for known in itertools.combinations([i for i in range(n) if i != j], size):
                out[:, j] += (value({*known, j}) - value({*known})) / (n * math.comb(n - 1, size))
    return out


def test_attributions_equal_shapley_values():
    x, y, row = data(n=200)
    x = x[:, :4].copy()
    forest = bo.boost(x, y, row, bo.BoostParams(n_estimators=8, max_depth=4, learning_rate=0.3, subsample=0.9))
    base, got = forest.attributions(x[:40])
    assert np.abs(got - shapley_by_subsets(forest, x[:40])).max() < 1e-3
    assert np.abs(got.sum(axis=1) + base - forest.predict(x[:40])).max() < 1e-3     # of 3e6


def test_saved_models_score_and_explain_alike(spark, tmp_path):
    x, y, _ = data(n=120)
    df, names = frame(spark, x, y), [f"f{j}" for j in range(6)]
    model = bo.fit_one(df, {"n_estimators": 12}, names, "y", ["id"])
    model.save(spark, f"{tmp_path}/model")
    again = bo.BoostedTrees.load(spark, f"{tmp_path}/model")
    assert again.features == names
    a, b = (m.transform(df).orderBy("id").toPandas().predicted for m in (model, again))
    assert (a == b).all()
    parts = again.attributions(df, ["id"]).groupBy("id").agg(F.sum("attribution").alias("s"), F.max("base").alias("base"))
    got = {r.id: r.s + r.base for r in parts.collect()}
    assert np.allclose([got[i] for i in range(120)], a, rtol=1e-9)


def test_walk_forward_refits_at_each_origin(spark):
    """Keys are P4's, also for 25 nations; a prediction is that of a model of the weeks before."""
    from hebdo.operators import features as fe
    from hebdo.plans import queries as q
    ready = fe.model_ready(q.Ledger(spark, "/root/testdata/sf0.01", ["nation"]).weekly(), ["nation"]).persist()
    small = {"n_estimators": 3, "learning_rate": 0.3}
    initial = ready.groupBy("nation").count().agg(F.max("count")).first()[0] - 5
    out = tr.walk_forward(ready, ["nation"], small, initial=initial).persist()
    due = fo.walk_forward_origins(ready, ["nation"], initial).select("nation", "week")
    assert due.count() > 0 and out.count() == due.count()
    assert out.select("nation", "week").exceptAll(due).count() == 0
    week = out.agg(F.max("week")).first()[0]
    model = tr.fit(ready.where(F.col("week") < week), small, ["nation"])
    want = {r.nation: r.predicted for r in model.transform(ready.where(F.col("week") == week)).collect()}
    got = {r.nation: r.predicted for r in out.where(F.col("week") == week).collect()}
    assert got and all(abs(got[k] / want[k] - 1) < 1e-9 for k in got)
