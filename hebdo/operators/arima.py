"""ARIMA(p, d, q) per series with stepwise order search.

Each series is one group of weekly rows (bounded by the calendar). Differencing
follows from a KPSS test; the likelihood is the Kalman filter's, for many
parameter vectors at once, so a gradient costs one pass over the weeks and a missing
week is a step without a measurement. Orders move by one step at a time from the
best so far until no neighbour has a lower AIC; nothing caps p or q but the
number of weeks. The fitted table holds what a forecast needs: coefficients, the
filter's last state and the last levels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.functions.frames import attach
from hebdo.operators.features import TARGET
from hebdo.operators.folds import holdout_split

KPSS_5PCT = 0.463          # fixed value: level stationarity, 5 %
Z_95 = 1.959963984540054   # fixed value
MAX_D = 2
_MODEL = [("p", T.IntegerType()), ("d", T.IntegerType()), ("q", T.IntegerType()), ("n", T.LongType()),
          ("mean", T.DoubleType()), ("ar", T.ArrayType(T.DoubleType())), ("ma", T.ArrayType(T.DoubleType())),
          ("sigma2", T.DoubleType()), ("aic", T.DoubleType()), ("last_week", T.DateType()),
          ("state", T.ArrayType(T.DoubleType())), ("levels", T.ArrayType(T.DoubleType()))]


# ------------------------------------------------------------------ parameters

def from_partial(u: np.ndarray) -> np.ndarray:
    """Unconstrained (rows, k) -> coefficients of stationary autoregressions: squashed to
    partial autocorrelations, then one order at a time (Durbin and Levinson)."""
    r = u / np.sqrt(1 + u * u)
    phi = np.zeros_like(r)
    for k in range(r.shape[1]):
        before = phi[:, :k].copy()
        phi[:, :k] = before - r[:, k:k + 1] * before[:, ::-1]
        phi[:, k] = r[:, k]
    return phi


def unpack(x: np.ndarray, p: int, q: int, mean: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ar, ma = from_partial(x[:, :p]), -from_partial(x[:, p:p + q])
    return ar, ma, x[:, -1] if mean else np.zeros(len(x))


# ------------------------------------------------------------------ likelihood

def _companion(ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, r = len(ar), max(ar.shape[1], ma.shape[1] + 1)
    t = np.zeros((rows, r, r))
    t[:, :ar.shape[1], 0] = ar
    t[:, np.arange(r - 1), np.arange(1, r)] = 1
    noise = np.zeros((rows, r))
    noise[:, 0] = 1
    noise[:, 1:1 + ma.shape[1]] = ma
    return t, noise


@np.errstate(all="ignore")   # a hopeless parameter vector gives an infinite or undefined likelihood
def kalman(z: np.ndarray, ar: np.ndarray, ma: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Concentrated log likelihoods, noise variances and last predicted states of ARMA models
    (one per row of the coefficients) of the series ``z``; NaN is a missing week."""
    t, noise = _companion(ar, ma)
    rows, r = noise.shape
    drive = noise[:, :, None] * noise[:, None, :]
    p, a = drive.copy(), t.copy()
    for _ in range(40):                       # stationary covariance, doubling the steps summed
        more = a @ p @ a.transpose(0, 2, 1)
        p, a = p + more, a @ a
        if np.abs(more).max() <= 1e-13 * np.abs(p).max():
            break
    state = np.zeros((rows, r))
    squares, logs, n, steady = np.zeros(rows), np.zeros(rows), 0, False
    shifted = np.zeros((rows, r))
    ar_full = t[:, :, 0]
    for value in z:
        if np.isnan(value):
            steady = False
            filtered, cov = state, p
        else:
            if not steady:
                f = np.maximum(p[:, 0, 0], 1e-300)
                gain = p[:, :, 0] / f[:, None]
                cov = p - gain[:, :, None] * p[:, 0, None, :]
            v = value - mean - state[:, 0]
            squares += v * v / f
            logs += np.log(f)
            n += 1
            filtered = state + gain * v[:, None]
        shifted[:, :-1] = filtered[:, 1:]
        state = ar_full * filtered[:, :1] + shifted
        if not steady:
            after = t @ cov @ t.transpose(0, 2, 1) + drive
            steady = not np.isnan(value) and bool(np.abs(after - p).max() <= 1e-11 * np.abs(after).max())
            p = after
    sigma2 = np.maximum(squares / max(n, 1), 1e-300)
    return -0.5 * (n * (math.log(2 * math.pi) + 1 + np.log(sigma2)) + logs), sigma2, state


def maximise(z: np.ndarray, p: int, q: int, mean: bool, rounds: int = 60) -> tuple[float, np.ndarray]:
    """Quasi-Newton ascent (BFGS); a gradient and a line search are one batch each."""
    k = p + q + mean
    x = np.zeros(k)
    if mean:
        x[-1] = np.nanmean(z)
    if p:
        x[0] = 0.3
    if q:
        x[p] = -0.2

    def value(points: np.ndarray) -> np.ndarray:
        out = -kalman(z, *unpack(points, p, q, mean))[0] / len(z)
        return np.where(np.isfinite(out), out, 1e10)

    if not k:
        return -float(value(np.zeros((1, 0)))[0]) * len(z), x
    step = 1e-5 * np.eye(k)
    inverse, lengths = np.eye(k), 2.0 ** -np.arange(0, 12)
    f = float(value(x[None])[0])
    g_old = x_old = None
    for _ in range(rounds):
        both = value(np.concatenate([x + step, x - step]))
        g = (both[:k] - both[k:]) / 2e-5
        if np.abs(g).max() < 1e-6:
            break
        if g_old is not None:
            s, y = x - x_old, g - g_old
            sy = s @ y
            if sy > 1e-12:
                left = np.eye(k) - np.outer(s, y) / sy
                inverse = left @ inverse @ left.T + np.outer(s, s) / sy
        way = -inverse @ g
        if way @ g >= 0:
            inverse, way = np.eye(k), -g
        tried = value(x + lengths[:, None] * way)
        best = int(tried.argmin())
        if tried[best] >= f - 1e-10:
            break
        g_old, x_old = g, x
        x, f = x + lengths[best] * way, float(tried[best])
    return -f * len(z), x


# ------------------------------------------------------------------ orders

def kpss(z: np.ndarray) -> float:
    """KPSS statistic of level stationarity, Bartlett weights up to 3 sqrt(n) / 13 lags."""
    z = z[~np.isnan(z)]
    e = z - z.mean()
    n, lags = len(e), int(3 * math.sqrt(len(e)) / 13)
    s2 = e @ e / n + 2 / n * sum((1 - i / (lags + 1)) * (e[i:] @ e[:-i]) for i in range(1, lags + 1))
    return float((np.cumsum(e) ** 2).sum() / (n * n * s2)) if s2 > 0 else 0.0


def differences(y: np.ndarray) -> int:
    """How often to difference: until KPSS no longer rejects a level at 5 %."""
    z = y
    for d in range(MAX_D + 1):
        seen = z[~np.isnan(z)]
        if d == MAX_D or len(seen) < 10 or np.ptp(seen) == 0 or kpss(z) <= KPSS_5PCT:
            return d
        z = np.diff(z)
    return MAX_D


def _inside(ar: np.ndarray, ma: np.ndarray) -> bool:
    """Whether all roots lie clear of the unit circle."""
    for c in (-ar, ma):
        roots = np.roots(np.concatenate([c[::-1], [1.0]])) if len(c) else np.array([2.0])
        if len(roots) and np.abs(roots).min() < 1.001:
            return False
    return True


def stepwise(z: np.ndarray, d: int) -> tuple[float, int, int, bool, np.ndarray] | None:
    """(aic, p, q, mean, parameters) of the best order that neighbourly moves lead to."""
    n = int((~np.isnan(z)).sum())
    seen: dict[tuple[int, int, bool], tuple] = {}

    def fit(p: int, q: int, mean: bool) -> tuple:
        key = (p, q, mean)
        if key not in seen:
            seen[key] = (math.inf, *key, None)
            if min(p, q) >= 0 and n > p + q + mean + 2:
                ll, x = maximise(z, p, q, mean)
                ar, ma, _ = unpack(x[None], p, q, mean)
                aic = -2 * ll + 2 * (p + q + mean + 1)
                if math.isfinite(aic) and _inside(ar[0], ma[0]):
                    seen[key] = (aic, *key, x)
        return seen[key]

    mean = d < 2
    best = min((fit(p, q, mean) for p, q in ((2, 2), (0, 0), (1, 0), (0, 1))), key=lambda m: m[0])
    while best[4] is not None:
        _, p, q, mean, _ = best
        moves = [(p + i, q + j, mean) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]
        if d < 2:
            moves.append((p, q, not mean))
        found = min((fit(*m) for m in moves), key=lambda m: m[0])
        if found[0] >= best[0] - 1e-9:
            return best
        best = found
    return None


def fit_series(weeks: np.ndarray, y: np.ndarray) -> dict | None:
    """The model of one series (weeks as dates, ascending), or None if it has none."""
    place = (weeks.astype("datetime64[D]").astype(np.int64) - weeks[0].astype("datetime64[D]").astype(np.int64)) // 7
    full = np.full(int(place[-1]) + 1, np.nan)
    full[place] = y
    d = differences(full)
    z = np.diff(full, n=d)
    sd = np.nanstd(z) if (~np.isnan(z)).sum() > 3 else 0.0
    if not sd > 1e-9 * max(1.0, np.nanmax(np.abs(full))):
        return None
    scaled = z / sd
    found = stepwise(scaled, d)
    if found is None:
        return None
    aic, p, q, mean, x = found
    ar, ma, mu = unpack(x[None], p, q, mean)
    _, s2, state = kalman(scaled, ar, ma, mu)
    n = int((~np.isnan(z)).sum())
    levels = [float(np.diff(full, n=i)[-1]) for i in range(d)]
    if np.isnan(levels).any():                 # a gap at the very end: differences have no start
        return None
    return {"p": p, "d": d, "q": q, "n": n, "mean": float(mu[0] * sd), "ar": ar[0].tolist(), "ma": ma[0].tolist(),
            "sigma2": float(s2[0] * sd * sd), "aic": float(aic + 2 * n * math.log(sd)),
            "state": (state[0] * sd).tolist(), "levels": levels}


def arima_fit(df: DataFrame, keys: list[str] | None = None, y: str = TARGET) -> DataFrame:
    """(keys, order, coefficients, variance, AIC, last state) per series. A series that is constant,
    too short, or whose last differences a gap leaves unknown, has no row."""
    keys = list(keys or [])
    rows = df.select(*keys, "week", F.col(y).cast("double").alias("_y")).where("_y is not null")
    schema = T.StructType([rows.schema[k] for k in keys] + [T.StructField(n, t) for n, t in _MODEL])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week")
        weeks = pd.to_datetime(pdf["week"])
        m = fit_series(weeks.to_numpy(), pdf["_y"].to_numpy())
        out = [] if m is None else [{**{k: pdf[k].iloc[0] for k in keys}, **m, "last_week": weeks.iloc[-1].date()}]
        return pd.DataFrame(out, columns=schema.names)

    # fits take seconds each: many partitions, so that few series share a task
    tasks = 8 * df.sparkSession.sparkContext.defaultParallelism
    dealt = rows.repartition(tasks, *keys) if keys else rows
    return dealt.groupBy(*keys).applyInPandas(run, schema)


# ------------------------------------------------------------------ forecast

def psi_weights(ar: np.ndarray, ma: np.ndarray, d: int, steps: int) -> np.ndarray:
    """Weights of past shocks in the level, of an ARMA summed ``d`` times."""
    psi = np.zeros(steps)
    for i in range(steps):
        psi[i] = (1.0 if i == 0 else ma[i - 1] if i <= len(ma) else 0.0) + sum(
            ar[j] * psi[i - 1 - j] for j in range(min(len(ar), i)))
    for _ in range(d):
        psi = np.cumsum(psi)
    return psi


def forecast_series(m: dict, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected levels and their standard errors."""
    ar, ma = np.asarray(m["ar"], dtype=float), np.asarray(m["ma"], dtype=float)
    state = np.asarray(m["state"], dtype=float)
    t = _companion(ar[None], ma[None])[0][0]
    path = np.empty(steps)
    for i in range(steps):
        path[i] = m["mean"] + state[0]
        state = t @ state
    for level in list(m["levels"])[::-1]:
        path = level + np.cumsum(path)
    return path, np.sqrt(m["sigma2"] * np.cumsum(psi_weights(ar, ma, int(m["d"]), steps) ** 2))


def arima_forecast(fits: DataFrame, keys: list[str] | None = None, horizon: int = 26,
                   until: DataFrame | None = None) -> DataFrame:
    """(keys, week, step, predicted, lower_bound, upper_bound) from the fitted table alone:
    ``horizon`` weeks on, or as far as ``until`` (keys, until) if that is later. Bounds are
    95 % by the weights of the shocks to come."""
    keys = list(keys or [])
    table = fits if until is None else attach(fits, until, keys, ["until"])
    schema = T.StructType([fits.schema[k] for k in keys] + [
        T.StructField("week", T.DateType()), T.StructField("step", T.LongType()),
        *(T.StructField(c, T.DoubleType()) for c in ("predicted", "lower_bound", "upper_bound"))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for m in pdf.to_dict("records"):
                far = (m["until"] - m["last_week"]).days // 7 if m.get("until") is not None else 0
                path, se = forecast_series(m, max(horizon, far))
                out += [[*(m[k] for k in keys), m["last_week"] + timedelta(weeks=i + 1), i + 1, v, v - Z_95 * e, v + Z_95 * e]
                        for i, (v, e) in enumerate(zip(path, se))]
            yield pd.DataFrame(out, columns=schema.names)

    return table.mapInPandas(run, schema)


def arima_holdout(ready: DataFrame, keys: list[str] | None = None, h: int = 12, y: str = TARGET) -> DataFrame:
    """Order and coefficients from all but the last ``h`` weeks of each series, which are
    forecast without seeing their actuals; NULL for a series without a model."""
    keys = list(keys or [])
    split = holdout_split(ready.select(*keys, "week", y), keys, h)
    train, test = split.where("role = 'train'"), split.where("role = 'test'")
    until = test.groupBy(*keys).agg(F.max("week").alias("until"))
    path = arima_forecast(arima_fit(train, keys, y), keys, h, until)
    return (test.join(path, keys + ["week"], "left")
            .select(*keys, "week", F.col(y).alias("actual"), "predicted", "lower_bound", "upper_bound"))
