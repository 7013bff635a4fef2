"""Pooled boosted-tree regressor (T1, T2, T7-T9, J5) over the feature rows of every series.

One forest is trained on all series at once, so the number of series does not
multiply the number of fits. Tuning draws, folds and walk-forward origins are
fits over one table of expanding splits, dealt over the tasks (see
``hebdo.operators.boosting``).
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hebdo.operators.boosting import BoostedTrees, BoostParams, Fit, fit_one, run_fits
from hebdo.operators.features import FEATURES, TARGET
from hebdo.operators.folds import calibration_tail, expanding_folds, holdout_split, walk_forward_origins

# Tuned parameters of the reference run (fixed values).
TUNED_PARAMS = {
    "colsample_bytree": 0.7812872927545389,
    "gamma": 0.1331851252237497,
    "learning_rate": 0.024478072123840997,
    "max_depth": 3,
    "min_child_weight": 2,
    "n_estimators": 505,
    "reg_alpha": 1.1623252423616526,
    "reg_lambda": 4.676706207342239,
    "subsample": 0.7248245260105918,
}

# Search space (fixed values): integer ranges are [low, high), uniform ones
# are (low, width).
SPACE_INT = {"n_estimators": (250, 900), "max_depth": (2, 5), "min_child_weight": (1, 8)}
SPACE_UNIFORM = {
    "learning_rate": (0.01, 0.19), "subsample": (0.70, 0.30),
    "colsample_bytree": (0.70, 0.30), "gamma": (0.0, 1.0),
    "reg_alpha": (0.0, 2.0), "reg_lambda": (1.0, 4.0),
}
SEED = 42


def fit(train: DataFrame, params: dict | None = None, keys: list[str] | None = None) -> BoostedTrees:
    """Fit the pooled model; ``keys`` and ``week`` identify a row."""
    return fit_one(train, {**TUNED_PARAMS, **(params or {})}, FEATURES, TARGET, [*(keys or []), "week"])


def calibration_residuals(ready: DataFrame, keys: list[str] | None = None, params: dict | None = None,
                          h: int = 12, size: int = 20) -> DataFrame:
    """P5: (keys, week, actual, predicted, abs_error) of the last ``size`` training weeks, by a
    forest of the weeks before them; the ``h`` holdout weeks take no part."""
    keys = list(keys or [])
    train = holdout_split(ready, keys, h).where("role = 'train'").drop("role")
    rows = calibration_tail(train, keys, size).withColumns({
        "train_from": F.when(F.col("role") == "fit", 0), "test_at": F.when(F.col("role") == "calibration", 0)})
    fits = [Fit(0, 0, BoostParams.of({**TUNED_PARAMS, **(params or {})}))]
    return run_fits(rows, fits, FEATURES, TARGET, [*keys, "week"]).select(
        *keys, "week", "actual", "predicted", F.abs(F.col("actual") - F.col("predicted")).alias("abs_error"))


def predict(model: BoostedTrees, df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, week, actual, predicted) for any feature rows."""
    return (model.transform(df)
            .select(*keys, "week", F.col(TARGET).alias("actual"), "predicted"))


def holdout(ready: DataFrame, keys: list[str] | None = None, params: dict | None = None,
            h: int = 12) -> tuple[BoostedTrees, DataFrame]:
    """Train on all but the last ``h`` weeks of every series; return the
    model and its predictions for every row with ``role``."""
    keys = list(keys or [])
    split = holdout_split(ready, keys, h).persist()
    model = fit(split.where("role = 'train'"), params, keys)
    pred = model.transform(split).select(*keys, "week", "role",
                                         F.col(TARGET).alias("actual"), "predicted")
    return model, pred


def sample_params(n_iter: int, seed: int = SEED) -> list[dict]:
    """Seeded random draws from the search space."""
    rng = random.Random(seed)
    out = []
    for _ in range(n_iter):
        d = {k: rng.randrange(lo, hi) for k, (lo, hi) in SPACE_INT.items()}
        d.update({k: lo + rng.random() * width for k, (lo, width) in SPACE_UNIFORM.items()})
        out.append(d)
    return out


def tune(ready: DataFrame, keys: list[str] | None = None, n_iter: int = 100, h: int = 12,
         n_splits: int = 5, seed: int = SEED) -> DataFrame:
    """Random search; returns the leaderboard (draw, cv_mape, params...)
    sorted by cv_mape, the mean over folds of the mean absolute percentage
    error. Every draw is fitted with the settings its row lists; ``n_iter``
    is the only budget. The holdout weeks are excluded from tuning."""
    from hebdo.operators.evaluate import EPS
    keys = list(keys or [])
    train = holdout_split(ready, keys, h).where("role = 'train'").drop("role")
    folds = expanding_folds(train, keys, n_splits).groupBy(*keys, "week").agg(
        F.min(F.when(F.col("role") == "train", F.col("fold"))).cast("int").alias("train_from"),
        F.min(F.when(F.col("role") == "test", F.col("fold"))).cast("int").alias("test_at"))
    rows = train.join(folds, keys + ["week"]).persist()
    draws = sample_params(n_iter, seed)
    fits = [Fit(i, f, BoostParams.of(d)) for i, d in enumerate(draws) for f in range(n_splits)]
    scored = run_fits(rows, fits, FEATURES, TARGET, [*keys, "week"])
    error = F.abs(F.col("actual") - F.col("predicted")) / F.greatest(F.abs("actual"), F.lit(EPS))
    board = (scored.groupBy("draw", "split").agg((F.avg(error) * 100).alias("mape"))
             .groupBy("draw").agg(F.avg("mape").alias("cv_mape")))
    listed = ready.sparkSession.createDataFrame(
        [{"draw": i, **{k: float(v) for k, v in d.items()}} for i, d in enumerate(draws)])
    return board.join(listed, "draw").orderBy("cv_mape", "draw")


def best_params(board: DataFrame) -> dict:
    """The settings of the best draw of a leaderboard."""
    best = board.orderBy("cv_mape", "draw").first()
    return {k: (int(best[k]) if k in SPACE_INT else float(best[k])) for k in [*SPACE_INT, *SPACE_UNIFORM]}


def feature_importance(spark: SparkSession, model: BoostedTrees, top: int = 20) -> DataFrame:
    """Mean gain of a feature's splits, as a share of all features' mean
    gains; the ``top`` features. Features without a split have 0."""
    gains = (model.nodes(spark).where("feature is not null").groupBy("feature")
             .agg(F.avg("gain").alias("gain")))
    names = spark.createDataFrame([(f,) for f in model.features], "feature string")
    gain = F.coalesce("gain", F.lit(0.0))
    share = gain / F.greatest(F.sum(gain).over(Window.partitionBy()), F.lit(1e-300))
    return (names.join(gains, "feature", "left").select("feature", share.alias("importance"))
            .orderBy(F.desc("importance"), "feature").limit(top))


def attributions(model: BoostedTrees, rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, week, feature, attribution, base), exact Shapley values of
    every prediction; a row's attributions add up to prediction - base."""
    return model.attributions(rows, [*(keys or []), "week"])


def permutation_importance(model: BoostedTrees, test: DataFrame, keys: list[str],
                           features: list[str] = FEATURES, seed: int = SEED) -> DataFrame:
    """T9, by permutation: increase in MAE when one feature's values are permuted among the
    weeks of the same series; ``features`` are the ones to permute, the
    model always sees all 38.

    One pass for all features: the test rows are copied once per permuted
    feature, the feature values are unpivoted into (series, feature, value)
    donors ranked at random within (series, feature), and one equi-join on
    (series, feature, rank) swaps the donor value into the copy."""
    part = Window.partitionBy(*keys, "feature") if keys else Window.partitionBy("feature")
    names = F.array(*[F.lit(f) for f in features])
    rows = (test.select(*keys, "week", TARGET, *FEATURES)
            .withColumn("feature", F.explode(names))
            .withColumn("_r", F.row_number().over(part.orderBy("week"))))
    values = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("_v"))
                       for f in features])
    donors = (test.select(*keys, "week", F.explode(values).alias("d"))
              .select(*keys, "week", "d.feature", "d._v")
              .withColumn("_r", F.row_number().over(part.orderBy(F.rand(seed), "week")))
              .drop("week"))
    swapped = rows.join(donors, keys + ["feature", "_r"]).select(
        *keys, "week", TARGET, "feature",
        *[F.when(F.col("feature") == f, F.col("_v")).otherwise(F.col(f)).alias(f) if f in features
          else F.col(f) for f in FEATURES])
    mae = F.avg(F.abs(F.col(TARGET) - F.col("predicted")))
    base = model.transform(test).agg(mae.alias("m"))
    out = model.transform(swapped).groupBy("feature").agg(mae.alias("permuted_mae"))
    return (out.withColumn("base_mae", base.select("m").scalar())
            .withColumn("importance", F.col("permuted_mae") - F.col("base_mae")))


def walk_forward(ready: DataFrame, keys: list[str] | None = None, params: dict | None = None,
                 initial: int = 104, refit_every: int = 1) -> DataFrame:
    """J5 for the pooled trees: origins are each series' weeks at position >=
    ``initial`` (P4); the model is refitted on all rows before an origin every
    ``refit_every`` weeks (1 = refit at each origin) and predicts the following
    weeks one step ahead from their actual features. The driver only sees the
    list of origin weeks (a few hundred dates); all fits are one Spark job."""
    keys = list(keys or [])
    due = walk_forward_origins(ready, keys, initial).select(*keys, "week", F.lit(True).alias("_due"))
    origins = [r.week for r in due.select("week").distinct().orderBy("week").collect()]
    starts = origins[::refit_every]
    passed = F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= F.col("week"))) if starts else F.lit(0)
    rows = ready.join(due, [*keys, "week"], "left").withColumns({
        "train_from": passed, "test_at": F.when(F.col("_due"), passed - 1)}).drop("_due").persist()
    settings = BoostParams.of({**TUNED_PARAMS, **(params or {})})
    fits = [Fit(0, i, settings) for i in range(len(starts))]
    if not fits:  # no series is long enough to have an origin
        return ready.limit(0).select(*keys, "week", F.col(TARGET).alias("actual"), F.lit(0.0).alias("predicted"))
    return run_fits(rows, fits, FEATURES, TARGET, [*keys, "week"]).select(*keys, "week", "actual", "predicted")
