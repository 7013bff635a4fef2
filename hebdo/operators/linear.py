"""Per-series linear and smoothing models.

* AR(1) by ``regr_slope`` / ``regr_intercept``: one grouped aggregate for a
  holdout fit, one expanding-window aggregate for all walk-forward origins.
* Simple exponential smoothing (the ARIMA(0,1,1) forecast): a fold over the
  series' weekly values for every alpha of a grid, best alpha by SSE.
* Dickey-Fuller statistic from ``regr_*`` aggregates.
* Grouped normal equations (T6): sufficient statistics by a distributed
  ``groupBy(...).agg`` and one tiny solve per group in ``mapInPandas``; used
  for the trend + Fourier-season model and, about the means, for AR(p) order
  selection and the Dickey-Fuller test with lagged differences.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.functions.columns import safe_div, series_window
from hebdo.functions.frames import attach
from hebdo.operators.folds import holdout_split, with_position

Y = "weekly_revenue"
SES_GRID = [round(0.05 * i, 2) for i in range(1, 20)]
# Dickey-Fuller critical values, regression with constant, large sample
# (fixed values).
DF_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}
YEAR_WEEKS = 365.25 / 7
# what is left of a sum of squares by rounding alone, as a share of it
NOISE = 1e-12


def calendar_lag(c: str, i: int, w) -> F.Column:
    """``c`` of ``i`` weeks before; NULL where the series misses a week in between."""
    return F.when(F.datediff("week", F.lag("week", i).over(w)) == 7 * i, F.lag(c, i).over(w))


# ------------------------------------------------------------------ AR(1)
def ar1_fit(train: DataFrame, keys: list[str], y: str = Y, x: str = "lag_1") -> DataFrame:
    return train.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"),
                                    F.regr_intercept(y, x).alias("intercept"),
                                    F.regr_count(y, x).alias("n_fit"))


def ar1_holdout(ready: DataFrame, keys: list[str] | None = None, h: int = 12,
                y: str = Y, x: str = "lag_1") -> DataFrame:
    """Fit y_t = a + b * y_{t-1} on all but the last ``h`` weeks of each
    series; predict every week from its actual previous value (like the
    tree model's holdout, which also sees actual lag features)."""
    keys = list(keys or [])
    split = holdout_split(ready.select(*keys, "week", y, x), keys, h)
    j = attach(split, ar1_fit(split.where("role = 'train'"), keys, y, x), keys, ["slope", "intercept"])
    return j.select(*keys, "week", "role", F.col(y).alias("actual"),
                    (F.col("intercept") + F.col("slope") * F.col(x)).alias("predicted"))


def ar1_walk_forward(ready: DataFrame, keys: list[str] | None = None, initial: int = 104,
                     y: str = Y, x: str = "lag_1") -> DataFrame:
    """J5 for AR(1): refit at every origin on all earlier weeks and predict
    one step. All origins come from one expanding-window aggregate."""
    keys = list(keys or [])
    w = series_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    pos = with_position(ready.select(*keys, "week", y, x), keys)
    fitted = pos.select("*", F.regr_slope(y, x).over(w).alias("slope"),
                        F.regr_intercept(y, x).over(w).alias("intercept"))
    return (fitted.where(F.col("idx") >= initial)
            .select(*keys, "week", F.col(y).alias("actual"),
                    (F.col("intercept") + F.col("slope") * F.col(x)).alias("predicted")))


# ------------------------------------------------------------------ SES
def series_values(df: DataFrame, keys: list[str], y: str = Y) -> DataFrame:
    """(keys, values) with the series' weekly values in week order. A weekly
    series is one value per calendar week, so its length is bounded by the
    calendar, not by the ledger size."""
    return (df.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("week", y))).alias("_h"),
                 F.max("week").alias("last_week"))
            .select(*keys, "last_week", F.transform("_h", lambda s: s[y]).alias("values")))


def ses_grid_fit(df: DataFrame, keys: list[str] | None = None, y: str = Y,
                 grid: list[float] = SES_GRID) -> DataFrame:
    """Level and one-step SSE of simple exponential smoothing for every
    alpha of the grid: level_1 = y_1, e_t = y_t - level_{t-1},
    level_t = level_{t-1} * (1 - alpha) + y_t * alpha."""
    keys = list(keys or [])
    vals = series_values(df, keys, y)
    a = F.col("alpha")
    start = F.struct(F.element_at("values", 1).alias("level"), F.lit(0.0).alias("sse"))
    fold = F.aggregate(
        F.slice("values", 2, F.size("values") - 1), start,
        lambda acc, x: F.struct(
            (acc["level"] * (1 - a) + x * a).alias("level"),
            (acc["sse"] + (x - acc["level"]) * (x - acc["level"])).alias("sse")))
    return (vals.where(F.size("values") > 0)
            .select(*keys, "last_week", F.size("values").cast("long").alias("n"),
                    F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("alpha"), "values")
            .select(*keys, "last_week", "n", "alpha", fold.alias("_f"))
            .select(*keys, "last_week", "n", "alpha",
                    F.col("_f.level").alias("level"), F.col("_f.sse").alias("sse")))


def ses_fit(df: DataFrame, keys: list[str] | None = None, y: str = Y,
            grid: list[float] = SES_GRID) -> DataFrame:
    """T3 (smoothing form): best alpha per series by SSE, with its final
    level (the flat forecast)."""
    keys = list(keys or [])
    g = ses_grid_fit(df, keys, y, grid)
    best = F.min_by(F.struct("alpha", "level", "sse"), "sse")
    return (g.groupBy(*keys).agg(best.alias("_b"), F.first("n").alias("n"),
                                 F.first("last_week").alias("last_week"))
            .select(*keys, "n", "last_week", "_b.alpha", "_b.level", "_b.sse"))


def ses_holdout(ready: DataFrame, keys: list[str] | None = None, h: int = 12,
                y: str = Y) -> DataFrame:
    """SES fitted on the training weeks; the flat level predicts every test
    week (the committed ARIMA holdout is such a constant)."""
    keys = list(keys or [])
    split = holdout_split(ready.select(*keys, "week", y), keys, h)
    fit = ses_fit(split.where("role = 'train'"), keys, y)
    j = attach(split.where("role = 'test'"), fit, keys, ["level"])
    return j.select(*keys, "week", F.col(y).alias("actual"), F.col("level").alias("predicted"))


# ------------------------------------------------------------------ Dickey-Fuller
def df_test(df: DataFrame, keys: list[str] | None = None, y: str = Y) -> DataFrame:
    """T4: Dickey-Fuller t statistic of gamma in dy_t = a + gamma * y_{t-1},
    compared with the 5 % critical value (stationary when below it). Weeks
    whose previous week is missing from the series take no part. The statistic
    is NULL for up to two weeks, a constant series or a fit without residuals."""
    keys = list(keys or [])
    w = series_window(keys)
    d = df.select(*keys, (F.col(y) - calendar_lag(y, 1, w)).alias("dy"),
                  calendar_lag(y, 1, w).alias("ylag"))
    s = d.groupBy(*keys).agg(
        F.regr_count("dy", "ylag").alias("n"),
        F.regr_slope("dy", "ylag").alias("gamma"),
        F.regr_sxx("dy", "ylag").alias("sxx"),
        F.regr_syy("dy", "ylag").alias("syy"),
        F.regr_sxy("dy", "ylag").alias("sxy"))
    ssr = F.col("syy") - safe_div(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    se = F.sqrt(safe_div(safe_div(ssr, F.col("n") - 2), F.col("sxx")))
    t = F.when((F.col("n") > 2) & (ssr > NOISE * F.col("syy")), safe_div(F.col("gamma"), se))
    return s.select(*keys, "n", "gamma", t.alias("t_stat"),
                    F.lit(DF_CRITICAL["5%"]).alias("critical_5pct"),
                    (t < DF_CRITICAL["5%"]).alias("stationary"))


def adf_test(df: DataFrame, keys: list[str] | None = None, y: str = Y, lags: int = 1) -> DataFrame:
    """T4 with ``lags`` lagged differences: t statistic of gamma in
    dy_t = a + gamma * y_{t-1} + sum_i delta_i dy_{t-i}, compared with the 5 %
    critical value. Weeks with a missing week among their lags take no part.
    Without more weeks than coefficients, or with regressors that don't vary
    apart, gamma and the statistic are NULL; a fit without residuals has no
    statistic."""
    keys = list(keys or [])
    w = series_window(keys)
    d = df.select(*keys, "week", (F.col(y) - calendar_lag(y, 1, w)).alias("dy"), calendar_lag(y, 1, w).alias("ylag"))
    names = [f"dy_l{i}" for i in range(1, lags + 1)]
    d = d.withColumns({c: calendar_lag("dy", i, w) for i, c in enumerate(names, 1)}).dropna(
        subset=["dy", "ylag", *names])
    size = lags + 2
    stats = centred_moments(d, keys, ["ylag", *names], "dy")
    schema = T.StructType([*stats.select(*keys, "n").schema.fields, T.StructField("gamma", T.DoubleType()),
                           T.StructField("t_stat", T.DoubleType())])

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                m, n = _moment_matrix(row["cov"], size), row["n"]
                gamma = t = None
                if n > size and _independent(m[:-1, :-1]):
                    inverse = np.linalg.inv(m[:-1, :-1])
                    beta = inverse @ m[:-1, -1]
                    left = m[-1, -1] - beta @ m[:-1, -1]  # RSS / n
                    gamma = float(beta[0])
                    if left > NOISE * m[-1, -1]:
                        t = float(gamma / np.sqrt(left / (n - size) * inverse[0, 0]))
                out.append([*(row[k] for k in keys), n, gamma, t])
            yield pd.DataFrame(out, columns=schema.names).astype({"gamma": float, "t_stat": float})

    solved = stats.mapInPandas(solve, schema)
    t = F.col("t_stat")
    return solved.select(*keys, "n", "gamma", "t_stat", F.lit(DF_CRITICAL["5%"]).alias("critical_5pct"),
                         (t < DF_CRITICAL["5%"]).alias("stationary"))


# ------------------------------------------------------------------ normal equations
def normal_equations(df: DataFrame, group: list[str], xcols: list[str], y: str) -> DataFrame:
    """Sufficient statistics of least squares per group: X'X (upper
    triangle, row-major), X'y, y'y and n. One partial+final aggregate."""
    p = len(xcols)
    xtx = [F.sum(F.col(xcols[i]) * F.col(xcols[j])) for i in range(p) for j in range(i, p)]
    xty = [F.sum(F.col(c) * F.col(y)) for c in xcols]
    return df.groupBy(*group).agg(
        F.array(*xtx).alias("xtx"), F.array(*xty).alias("xty"),
        F.sum(F.col(y) * F.col(y)).alias("yty"), F.count(F.lit(1)).alias("n"))


def solve_normal_equations(stats: DataFrame, p: int, ridge: float = 0.0,
                           penalise_first: bool = False) -> DataFrame:
    """Solve (X'X + ridge*I) b = X'y per row with numpy; adds ``coef``
    (array<double>) and ``rss``. Rows are groups, so each task solves a
    handful of p x p systems."""
    iu = np.triu_indices(p)
    schema = T.StructType(stats.schema.fields + [
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("rss", T.DoubleType())])

    def solve(batches):
        for pdf in batches:
            coefs, rss = [], []
            for xtx, xty, yty in zip(pdf["xtx"], pdf["xty"], pdf["yty"]):
                a = np.zeros((p, p))
                a[iu] = np.asarray(xtx, dtype=float)
                a = a + np.triu(a, 1).T
                b = np.asarray(xty, dtype=float)
                reg = np.eye(p) * ridge
                if not penalise_first:
                    reg[0, 0] = 0.0
                try:
                    beta = np.linalg.solve(a + reg, b)
                except np.linalg.LinAlgError:
                    beta = np.linalg.lstsq(a + reg, b, rcond=None)[0]
                coefs.append(beta.tolist())
                rss.append(float(yty - 2 * beta @ b + beta @ a @ beta))
            yield pdf.assign(coef=pd.Series(coefs, index=pdf.index, dtype=object),
                             rss=np.asarray(rss, dtype=float))

    return stats.mapInPandas(solve, schema)


def linear_predict(df: DataFrame, xcols: list[str], coef: str = "coef") -> F.Column:
    terms = [F.element_at(coef, i + 1) * F.col(c) for i, c in enumerate(xcols)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


# ------------------------------------------------------------------ AR(p), d in {0, 1}
def centred_moments(df: DataFrame, group: list[str], xcols: list[str], y: str) -> DataFrame:
    """T6 about the means: (n, means, cov), the means of the xcols and ``y``
    and the upper triangle of their population covariances, row-major. One
    partial+final aggregate."""
    cols = [*xcols, y]
    cov = [F.covar_pop(cols[i], cols[j]) for i in range(len(cols)) for j in range(i, len(cols))]
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cols]).alias("means"),
                                  F.array(*cov).alias("cov"))


def _independent(cov: np.ndarray) -> bool:
    """Whether the variables of a covariance matrix all vary and none is, within
    rounding, a combination of the others: the determinant of their correlations."""
    sd = np.sqrt(np.diag(cov))
    return bool((sd > 0).all() and np.linalg.det(cov / np.outer(sd, sd)) > NOISE)


def _moment_matrix(cov, size: int) -> np.ndarray:
    m = np.zeros((size, size))
    m[np.triu_indices(size)] = np.asarray(cov, dtype=float)
    return m + np.triu(m, 1).T


def _ar_lags(df: DataFrame, keys: list[str], y: str, max_p: int, max_d: int) -> DataFrame:
    """(keys, week, z{d}, z{d}_l{i}): differences of ``y`` and their lags, NULL
    where a week in between is missing."""
    w = series_window(keys)
    zcols = {0: F.col(y), 1: F.col(y) - calendar_lag(y, 1, w)}
    staged = df.select(*keys, "week", *[zcols[d].alias(f"z{d}") for d in range(max_d + 1)])
    return staged.withColumns({f"z{d}_l{i}": calendar_lag(f"z{d}", i, w)
                               for d in range(max_d + 1) for i in range(1, max_p + 1)})


def ar_order_selection(df: DataFrame, keys: list[str] | None = None, y: str = Y,
                       max_p: int = 2, max_d: int = 1) -> DataFrame:
    """T3 (autoregressive form): for d in 0..max_d and p in 0..max_p fit
    z_t = c + sum phi_i z_{t-i} (z = d-th difference of y) on a common
    sample (the weeks whose lags all fall on weeks of the series) and keep
    the lowest AIC = n ln(RSS/n) + 2k per series, k = p + 1; RSS counts as
    rounding at least, so of several perfect fits the smallest stays. Orders with
    n <= k, or lags that don't vary apart, are no candidates; a series without a
    candidate has no row. ``coef`` is (c, phi_1, ...), zero beyond p. The orders of
    one d share their moments."""
    keys = list(keys or [])
    staged = _ar_lags(df, keys, y, max_p, max_d).dropna()
    lags = [f"x{i}" for i in range(1, max_p + 1)]
    rows = [F.struct(F.lit(d).alias("d"), F.col(f"z{d}").alias("target"),
                     *[F.col(f"z{d}_l{i}").alias(f"x{i}") for i in range(1, max_p + 1)])
            for d in range(max_d + 1)]
    long = staged.select(*keys, F.explode(F.array(*rows)).alias("s")).select(*keys, "s.*")
    stats = centred_moments(long, keys + ["d"], lags, "target")
    schema = T.StructType([*stats.select(*keys, "d").schema.fields, T.StructField("p", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("coef", T.ArrayType(T.DoubleType())),
                           T.StructField("rss", T.DoubleType())])

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                m, mean = _moment_matrix(row["cov"], max_p + 1), np.asarray(row["means"], dtype=float)
                for p in range(max_p + 1):
                    if row["n"] <= p + 1 or (p and not _independent(m[:p, :p])):
                        continue
                    phi = np.linalg.solve(m[:p, :p], m[:p, -1]) if p else np.zeros(0)
                    coef = np.zeros(max_p + 1)
                    coef[0], coef[1:p + 1] = mean[-1] - phi @ mean[:p], phi
                    out.append([*(row[k] for k in keys), row["d"], p, row["n"], coef.tolist(),
                                float(row["n"] * max(m[-1, -1] - phi @ m[:p, -1], NOISE * m[-1, -1]))])
            yield pd.DataFrame(out, columns=schema.names)

    aic = F.col("n") * F.log(F.greatest(F.col("rss"), F.lit(1e-12)) / F.col("n")) + 2 * (F.col("p") + 1)
    scored = stats.mapInPandas(solve, schema).withColumn("aic", aic)
    best = F.min_by(F.struct("d", "p", "aic", "coef", "n"), F.struct("aic", "d", "p"))
    return scored.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def ar_forecast(df: DataFrame, fits: DataFrame, keys: list[str] | None = None, horizon: int = 26,
                y: str = Y, until: DataFrame | None = None, max_p: int = 2) -> DataFrame:
    """The fitted AR(p) of ``ar_order_selection`` iterated ``horizon`` weeks
    on from each series' last week, or as far as ``until`` (keys, until) if that
    is later: (keys, week, step, predicted).

    One fold over the steps per series. ``predicted`` is NULL for a series
    without a fit, or whose last weeks have a gap within the lags it needs.
    """
    keys = list(keys or [])
    lagged = _ar_lags(df.select(*keys, "week", y), keys, y, max_p - 1, 1)
    recent = F.array(*[F.array(F.col(f"z{d}"), *[F.col(f"z{d}_l{i}") for i in range(1, max_p)]) for d in (0, 1)])
    last = (lagged.groupBy(*keys)
            .agg(F.max_by(F.struct("week", F.col("z0").alias("level"), recent.alias("recent")), "week").alias("_s"))
            .select(*keys, F.col("_s.week").alias("last_week"), "_s.level", "_s.recent"))
    last = attach(last, fits, keys, ["d", "p", "coef"])
    steps = F.lit(horizon)
    if until is not None:
        last = attach(last, until, keys, ["until"])
        steps = F.greatest(steps, F.floor(F.datediff("until", "last_week") / 7).cast("int"))
    phi = F.slice("coef", 2, F.col("p"))
    start = F.struct(F.slice(F.element_at("recent", F.col("d") + 1), 1, F.col("p")).alias("z"),
                     F.col("level").alias("level"), F.array().cast("array<double>").alias("path"))

    def step(acc, _):
        z = F.aggregate(F.zip_with(phi, acc["z"], lambda a, b: a * b), F.element_at("coef", 1), lambda s, v: s + v)
        level = F.when(F.col("d") == 0, z).otherwise(acc["level"] + z)
        return F.struct(F.slice(F.concat(F.array(z), acc["z"]), 1, F.col("p")).alias("z"), level.alias("level"),
                        F.concat(acc["path"], F.array(level)).alias("path"))

    path = F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda acc: acc["path"])
    return (last.select(*keys, "last_week", F.posexplode(path).alias("i", "predicted"))
            .select(*keys, F.date_add("last_week", (F.col("i") + 1) * 7).alias("week"),
                    (F.col("i") + 1).cast("long").alias("step"), "predicted"))


def ar_holdout(ready: DataFrame, keys: list[str] | None = None, h: int = 12, y: str = Y) -> DataFrame:
    """T3 on a holdout: order and coefficients from all but the last ``h`` weeks
    of each series, which are forecast from there without seeing their actuals."""
    keys = list(keys or [])
    split = holdout_split(ready.select(*keys, "week", y), keys, h)
    train, test = split.where("role = 'train'"), split.where("role = 'test'")
    until = test.groupBy(*keys).agg(F.max("week").alias("until"))
    path = ar_forecast(train, ar_order_selection(train, keys, y), keys, h, y, until)
    return (test.join(path, keys + ["week"], "left")
            .select(*keys, "week", F.col(y).alias("actual"), "predicted"))


# ------------------------------------------------------------------ trend + season (T5)
def season_angle(k):
    """Angle of a week in the ``k``-th yearly wave, for a number or a column."""
    return k * (2 * math.pi) / YEAR_WEEKS


def fourier_terms(t: F.Column, order: int) -> dict[str, F.Column]:
    out = {}
    for k in range(1, order + 1):
        ang = F.lit(season_angle(k)) * t
        out[f"sin{k}"], out[f"cos{k}"] = F.sin(ang), F.cos(ang)
    return out


def fourier_trend(ready: DataFrame, keys: list[str] | None = None, h: int = 12, order: int = 3,
                  ridge: float = 1.0, y: str = Y) -> DataFrame:
    """T5: y = b0 + b1 * t + sum_k (a_k sin(2 pi k t / 52.18) + c_k cos(...))
    fitted by ridge normal equations on the training weeks of each series,
    t being weeks since its first one, so missing weeks shift no season;
    returns (keys, ds, y, yhat, role) for every week."""
    keys = list(keys or [])
    split = holdout_split(ready.select(*keys, "week", y), keys, h)
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    pos = split.withColumn("_first", F.min("week").over(whole))
    t = F.datediff("week", "_first") / 7.0
    terms = {"one": F.lit(1.0), "trend": t / 52.0, **fourier_terms(t, order)}
    design = pos.select(*keys, "week", "role", y, *[c.alias(n) for n, c in terms.items()])
    xcols = list(terms)
    stats = normal_equations(design.where("role = 'train'"), keys, xcols, y)
    coef = solve_normal_equations(stats, len(xcols), ridge=ridge).select(*keys, "coef")
    j = attach(design, coef, keys, ["coef"])
    return j.select(*keys, F.col("week").alias("ds"), F.col(y).alias("y"),
                    linear_predict(j, xcols).alias("yhat"), "role")
