"""Trend with changepoints and a yearly season per series (T5).

y = k t + m + sum_j delta_j (t - s_j)+ + Fourier terms, the maximum a posteriori fit
with a Laplace prior on the slope changes and normal priors on the rest. A
series is a group of weekly rows (bounded by the calendar); its fit works on the
Gram matrix alone: coordinate descent with soft thresholds, in turn with the
noise variance. The fitted table holds all that a forecast needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.operators.features import TARGET
from hebdo.operators.folds import holdout_split

YEAR_DAYS = 365.25
_EPOCH = date(1970, 1, 1)
_MODEL = [("n", T.LongType()), ("first_week", T.DateType()), ("last_week", T.DateType()), ("scale", T.DoubleType()),
          ("sigma", T.DoubleType()), ("changepoints", T.ArrayType(T.DateType())), ("coef", T.ArrayType(T.DoubleType()))]


@dataclass(frozen=True)
class TrendParams:
    changepoints: int = 25        # at even ranks of the first weeks
    share: float = 0.8            # of the weeks, counted from the first
    order: int = 10               # pairs of Fourier terms
    slope_scale: float = 5.0      # normal prior of slope and level
    change_scale: float = 0.05    # Laplace prior of the slope changes; 0: no penalties at all
    season_scale: float = 10.0
    noise_scale: float = 0.5


def season(days: np.ndarray, order: int) -> np.ndarray:
    angle = 2 * np.pi * days[:, None] / YEAR_DAYS * np.arange(1, order + 1)
    return np.stack([np.sin(angle), np.cos(angle)], axis=2).reshape(len(days), 2 * order)


def basis(days: np.ndarray, first: int, span: int, changes: np.ndarray, order: int) -> np.ndarray:
    """Columns level, slope, hinges, season; time runs from 0 to 1 over the training weeks."""
    t = (days - first) / span
    hinge = np.maximum(t[:, None] - (changes - first) / span, 0.0)
    return np.concatenate([np.ones((len(t), 1)), t[:, None], hinge, season(days.astype(float), order)], axis=1)


def places(days: np.ndarray, p: TrendParams) -> np.ndarray:
    """Days of the changepoints: at even ranks of the first ``share`` of the weeks."""
    early = int(np.floor(len(days) * p.share))
    k = min(p.changepoints, max(early - 1, 0))
    return days[np.linspace(0, max(early - 1, 0), k + 1).round().astype(int)[1:]]


def descend(gram: np.ndarray, xy: np.ndarray, yy: float, n: int, soft: np.ndarray, ridge: np.ndarray,
            noise_scale: float, sweeps: int = 20_000) -> tuple[np.ndarray, float]:
    """Coefficients and noise variance. ``soft`` and ``ridge`` are the penalties of each coefficient as
    multiples of the variance: |b| * soft and b^2 / 2 * ridge."""
    b, s2 = np.zeros(len(xy)), max(yy / n, 1e-12)
    diag = np.diag(gram)
    for sweep in range(sweeps):
        moved = 0.0
        for j in range(len(b)):
            r = xy[j] - gram[j] @ b + diag[j] * b[j]
            low = diag[j] + s2 * ridge[j]
            new = np.sign(r) * max(abs(r) - s2 * soft[j], 0.0) / low if low > 0 else 0.0
            moved = max(moved, abs(new - b[j]) * np.sqrt(diag[j] / n))
            b[j] = new
        rss = max(yy - 2 * b @ xy + b @ gram @ b, 0.0)
        # the variance that is likeliest given the residuals, with a half-normal prior on its root
        v = 1 / noise_scale ** 2
        after = max((-n + np.sqrt(n * n + 4 * v * rss)) / (2 * v), 1e-12)
        done = moved < 1e-9 and abs(after - s2) < 1e-9 * s2
        s2 = after
        if done:
            break
    return b, float(s2)


def fit_series(days: np.ndarray, y: np.ndarray, p: TrendParams) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(changepoint days, coefficients, scale of y, noise); without penalties by least squares."""
    scale = float(np.abs(y).max()) or 1.0
    first, span = int(days[0]), max(int(days[-1] - days[0]), 1)
    changes = places(days, p)
    x, z = basis(days, first, span, changes, p.order), y / scale
    if not p.change_scale:
        b = np.linalg.lstsq(x, z, rcond=None)[0]
        return changes, b, scale, float(np.sqrt(np.mean((z - x @ b) ** 2)) * scale)
    k = len(changes)
    soft = np.concatenate([[0.0, 0.0], np.full(k, 1 / p.change_scale), np.zeros(2 * p.order)])
    ridge = np.concatenate([np.full(2, p.slope_scale ** -2.0), np.zeros(k), np.full(2 * p.order, p.season_scale ** -2.0)])
    b, s2 = descend(x.T @ x, x.T @ z, float(z @ z), len(z), soft, ridge, p.noise_scale)
    return changes, b, scale, float(np.sqrt(s2) * scale)


def changepoint_fit(df: DataFrame, keys: list[str] | None = None, y: str = TARGET,
                    params: TrendParams = TrendParams()) -> DataFrame:
    """(keys, n, first_week, last_week, scale, sigma, changepoints, coef): level, slope, slope changes and
    season of y / scale. Weeks without a value take no part; a series of less than two has no row."""
    keys = list(keys or [])
    rows = df.select(*keys, "week", F.col(y).cast("double").alias("_y")).where("_y is not null")
    schema = T.StructType([rows.schema[k] for k in keys] + [T.StructField(n, t) for n, t in _MODEL])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week")
        if len(pdf) < 2:
            return pd.DataFrame([], columns=schema.names)
        days = pd.to_datetime(pdf["week"]).to_numpy().astype("datetime64[D]").astype(np.int64)
        changes, b, scale, sigma = fit_series(days, pdf["_y"].to_numpy(), params)
        day = lambda d: _EPOCH + timedelta(days=int(d))
        row = [*(pdf[k].iloc[0] for k in keys), len(pdf), day(days[0]), day(days[-1]), scale, sigma,
               [day(c) for c in changes], b.tolist()]
        return pd.DataFrame([row], columns=schema.names)

    tasks = 8 * df.sparkSession.sparkContext.defaultParallelism   # so that few series share a task
    dealt = rows.repartition(tasks, *keys) if keys else rows
    return dealt.groupBy(*keys).applyInPandas(run, schema)


def predict_row(m: dict, days: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, trend without season) of a fitted row."""
    number = lambda d: (d - _EPOCH).days
    b = np.asarray(m["coef"], dtype=float)
    k = len(m["changepoints"])
    first = number(m["first_week"])
    x = basis(days, first, max(number(m["last_week"]) - first, 1),
              np.array([number(d) for d in m["changepoints"]], dtype=np.int64), (len(b) - 2 - k) // 2)
    return x @ b * m["scale"], x[:, :2 + k] @ b[:2 + k] * m["scale"]


def changepoint_forecast(fits: DataFrame, keys: list[str] | None = None, horizon: int = 26) -> DataFrame:
    """(keys, week, step, predicted, trend), ``horizon`` weeks on, from the fitted table alone; the
    last slope goes on."""
    keys = list(keys or [])
    schema = T.StructType([fits.schema[k] for k in keys] + [
        T.StructField("week", T.DateType()), T.StructField("step", T.LongType()),
        T.StructField("predicted", T.DoubleType()), T.StructField("trend", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for m in pdf.to_dict("records"):
                weeks = [m["last_week"] + timedelta(weeks=i) for i in range(1, horizon + 1)]
                value, trend = predict_row(m, np.array([(w - _EPOCH).days for w in weeks]))
                out += [[*(m[k] for k in keys), w, i + 1, float(value[i]), float(trend[i])] for i, w in enumerate(weeks)]
            yield pd.DataFrame(out, columns=schema.names)

    return fits.mapInPandas(run, schema)


def changepoint_holdout(ready: DataFrame, keys: list[str] | None = None, h: int = 12, y: str = TARGET,
                        params: TrendParams = TrendParams()) -> DataFrame:
    """(keys, ds, y, yhat, trend, role) of every week, by the fit to all but the last ``h`` weeks
    of each series; NULL for a series without a fit."""
    keys = list(keys or [])
    split = holdout_split(ready.select(*keys, "week", y), keys, h)
    fits = changepoint_fit(split.where("role = 'train'"), keys, y, params)
    model = F.struct(*[n for n, _ in _MODEL])
    told = fits.select(*keys, model.alias("_m"))
    joined = split.join(told, keys, "left") if keys else split.withColumn("_m", told.select("_m").scalar())
    schema = T.StructType([ready.schema[k] for k in keys] + [
        T.StructField("ds", T.DateType()), T.StructField("y", T.DoubleType()), T.StructField("yhat", T.DoubleType()),
        T.StructField("trend", T.DoubleType()), T.StructField("role", T.StringType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week")
        m = pdf["_m"].iloc[0]
        value = trend = np.full(len(pdf), np.nan)
        if m is not None:
            days = pd.to_datetime(pdf["week"]).to_numpy().astype("datetime64[D]").astype(np.int64)
            value, trend = predict_row(m if isinstance(m, dict) else m.asDict(), days)
        out = {**{k: pdf[k] for k in keys}, "ds": pdf["week"], "y": pdf[y], "yhat": value, "trend": trend, "role": pdf["role"]}
        return pd.DataFrame(out)[schema.names]

    return joined.groupBy(*keys).applyInPandas(run, schema)
