"""Evaluation, conformal intervals and model health.

Inputs are prediction tables ``(keys..., week, actual, predicted)``; every
operator works per series. Nothing is collected: quantiles are order
statistics picked with a per-series window, summaries are aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.columns import round_half_up, series_window
from hebdo.functions.frames import attach

EPS = 2.220446049250313e-16  # float64 machine epsilon, the MAPE floor
CONFIDENCE = 0.95
DRIFT_THRESHOLD = 75


def with_errors(pred: DataFrame) -> DataFrame:
    """J2 + J3: ``error`` = actual - predicted, ``abs_error`` = |error|."""
    e = F.col("actual") - F.col("predicted")
    return pred.withColumn("error", e).withColumn("abs_error", F.abs(e))


def metric_columns():
    e = F.col("actual") - F.col("predicted")
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e) / F.greatest(F.abs("actual"), F.lit(EPS))) * 100).alias("mape"),
    ]


def metrics(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE, MAPE (percent) per group."""
    return pred.groupBy(*(by or [])).agg(*metric_columns())


def train_test_metrics(pred: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Metrics per series and role (train / test)."""
    return metrics(pred, list(keys or []) + ["role"])


def conformal_quantile(residuals: DataFrame, keys: list[str] | None = None,
                       confidence: float = CONFIDENCE, col: str = "abs_error") -> DataFrame:
    """Per series, the order statistic at 0-based position
    ceil(confidence * (n - 1)) of the absolute residuals (the 'higher'
    quantile, no finite-sample correction). Returns (keys, n, quantile)."""
    keys = list(keys or [])
    part = Window.partitionBy(*keys) if keys else Window.partitionBy()
    ranked = residuals.select(*keys, col,
                              (F.row_number().over(part.orderBy(col)) - 1).alias("_pos"),
                              F.count(F.lit(1)).over(part).alias("n"))
    k = F.ceil(F.lit(confidence) * (F.col("n") - 1))
    return ranked.where(F.col("_pos") == k).select(*keys, "n", F.col(col).alias("quantile"))


def interval_constant(pred: DataFrame, q: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Predicted +- quantile (lower bound not clipped)."""
    keys = list(keys or [])
    j = attach(pred, q, keys, ["quantile"])
    return (j.withColumn("lower_bound", F.col("predicted") - F.col("quantile"))
            .withColumn("upper_bound", F.col("predicted") + F.col("quantile")))


def interval_horizon(forecast: DataFrame, q: DataFrame, keys: list[str] | None = None,
                     value: str = "predicted") -> DataFrame:
    """Value +- quantile * sqrt(step), step = 1, 2, ... per series."""
    keys = list(keys or [])
    step = F.row_number().over(series_window(keys))
    j = attach(forecast, q, keys, ["quantile"])
    width = F.col("quantile") * F.sqrt(F.col("step").cast("double"))
    return (j.withColumn("step", step.cast("long"))
            .withColumn("lower_bound", F.col(value) - width)
            .withColumn("upper_bound", F.col(value) + width))


def _clip(c, lo=0.0, hi=100.0):
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def confidence_column(q, mean_pred):
    """J9 formula on columns."""
    return round_half_up(_clip((1 - q / F.greatest(mean_pred, F.lit(1.0))) * 100), 2)


def forecast_confidence(pred: DataFrame, q: DataFrame, keys: list[str] | None = None,
                        value: str = "predicted") -> DataFrame:
    """clip((1 - q / max(mean prediction, 1)) * 100, 0, 100), 2 dp."""
    keys = list(keys or [])
    m = pred.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    j = attach(m, q, keys, ["quantile"])
    return j.select(*keys, confidence_column(F.col("quantile"), F.col("_mean"))
                    .alias("forecast_confidence"))


def model_stability(pred: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """J10 + J11: stability = clip(100 / (1 + std_pop(|e|) / max(mean |e|, 1)),
    0, 100) at 2 dp; drift when stability < 75."""
    keys = list(keys or [])
    ae = F.abs(F.col("actual") - F.col("predicted"))
    s = pred.groupBy(*keys).agg(F.avg(ae).alias("_m"), F.stddev_pop(ae).alias("_s"))
    stab = round_half_up(_clip(100 / (1 + F.col("_s") / F.greatest("_m", F.lit(1.0)))), 2)
    return s.select(*keys, stab.alias("model_stability"),
                    (stab < DRIFT_THRESHOLD).alias("drift_detected"))


def drift_flag(stability_col: str = "model_stability", threshold: float = DRIFT_THRESHOLD):
    """J11 as a column."""
    return F.col(stability_col) < threshold


def health_summary(pred: DataFrame, q: DataFrame, keys: list[str] | None = None,
                   value: str = "predicted") -> DataFrame:
    """Last prediction of each series with its interval, confidence,
    stability and drift flag (one row per series)."""
    keys = list(keys or [])
    last = pred.groupBy(*keys).agg(
        F.max_by(value, "week").alias("forecast"),
        F.max("week").alias("week"),
        F.avg(value).alias("_mean"))
    j = attach(last, q, keys, ["quantile"])
    j = attach(j, model_stability(pred, keys), keys, ["model_stability", "drift_detected"])
    return j.select(
        *keys, "week", "forecast",
        (F.col("forecast") - F.col("quantile")).alias("lower_bound"),
        (F.col("forecast") + F.col("quantile")).alias("upper_bound"),
        confidence_column(F.col("quantile"), F.col("_mean")).alias("forecast_confidence"),
        "model_stability", "drift_detected")


def rolling_rmse_band(pred: DataFrame, keys: list[str] | None = None,
                      window: int = 12, min_periods: int = 4) -> DataFrame:
    """RMSE of the previous ``window`` errors (at least ``min_periods``),
    back-filled from the first available value; band = predicted +- rmse."""
    keys = list(keys or [])
    w = series_window(keys)
    e = F.col("actual") - F.col("predicted")
    prev = w.rowsBetween(-window, -1)
    staged = pred.withColumn("_e2", e * e)
    rmse = F.when(F.count("_e2").over(prev) >= min_periods, F.sqrt(F.avg("_e2").over(prev)))
    staged = staged.withColumn("_rmse", rmse)
    filled = F.first("_rmse", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return (staged.withColumn("rolling_rmse", filled).drop("_e2", "_rmse")
            .withColumn("lower_bound", F.col("predicted") - F.col("rolling_rmse"))
            .withColumn("upper_bound", F.col("predicted") + F.col("rolling_rmse")))


def walk_forward_summary(pred: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Number of predictions, first/last week, MAE/RMSE/MAPE."""
    keys = list(keys or [])
    return pred.groupBy(*keys).agg(
        F.min("week").alias("first_week"), F.max("week").alias("last_week"), *metric_columns())


def coverage(intervals: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Share of actuals inside [lower_bound, upper_bound] per series."""
    keys = list(keys or [])
    inside = (F.col("actual") >= F.col("lower_bound")) & (F.col("actual") <= F.col("upper_bound"))
    return intervals.groupBy(*keys).agg(F.count_if(inside).alias("covered"),
                                        F.count(F.lit(1)).alias("n"))


def calibrated_intervals(test: DataFrame, keys: list[str] | None = None,
                         calibration: str = "self", pool: DataFrame | None = None,
                         confidence: float = CONFIDENCE) -> DataFrame:
    """J6 + J7 with a choice of calibration residuals.

    ``self``: the quantile of the test rows' own residuals (what the
    reference does for its holdout: every interval then covers its own
    actual). ``prior``: the quantile of ``pool`` residuals (e.g. walk-forward
    predictions) strictly before each series' first test week, so no test
    row calibrates its own interval."""
    keys = list(keys or [])
    if calibration == "self":
        source = with_errors(test)
    elif calibration == "prior":
        if pool is None:
            raise ValueError("calibration='prior' needs a residual pool")
        first = test.groupBy(*keys).agg(F.min("week").alias("_first"))
        source = with_errors(attach(pool, first, keys, ["_first"])
                             .where(F.col("week") < F.col("_first")))
    else:
        raise ValueError(f"unknown calibration {calibration!r}")
    q = conformal_quantile(source, keys, confidence)
    return interval_constant(test, q, keys)
