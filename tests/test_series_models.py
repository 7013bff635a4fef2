"""ARIMA, changepoint trend, automatic Dickey-Fuller lag, model table."""

import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hebdo.operators import arima as ai
from hebdo.operators import features as fe
from hebdo.operators import forecast as fc
from hebdo.operators import linear as li
from hebdo.operators import model_table as mt
from hebdo.operators import trend as tn
from hebdo.operators import unit_root as ur

MONDAY = date(2015, 1, 5)
WEEKS = np.datetime64(MONDAY) + 7 * np.arange(600)


def arma(ar, ma, n, mean=50.0, seed=1):
    rng = np.random.default_rng(seed)
    e, z = rng.normal(size=n + 100), np.zeros(n + 100)
    for t in range(5, n + 100):
        z[t] = sum(a * z[t - 1 - i] for i, a in enumerate(ar)) + e[t] + sum(m * e[t - 1 - i] for i, m in enumerate(ma))
    return z[100:] + mean


def frame(spark, y, name="g", skip=()):
    rows = [(name, MONDAY + timedelta(weeks=i), float(v)) for i, v in enumerate(y) if i not in skip]
    return spark.createDataFrame(rows, "segment string, week date, weekly_revenue double")


# ------------------------------------------------------------------ ARIMA

@pytest.mark.parametrize("ar, ma", [([0.7], [0.4]), ([], [0.6]), ([0.5, -0.3], [])])
def test_likelihood_equals_the_dense_gaussian(ar, ma):
    z = arma(ar, ma, 60)
    ll, s2, _ = ai.kalman(z, np.array([ar]).reshape(1, -1), np.array([ma]).reshape(1, -1), np.array([50.0]))
    psi = ai.psi_weights(np.array(ar), np.array(ma), 0, 500)
    acf = np.array([psi[:500 - k] @ psi[k:] for k in range(60)])
    cov = acf[np.abs(np.subtract.outer(np.arange(60), np.arange(60)))]

    def dense(keep):
        e, c = (z - 50)[keep], cov[np.ix_(keep, keep)]
        v = e @ np.linalg.solve(c, e) / len(e)
        return -0.5 * (len(e) * (math.log(2 * math.pi) + 1 + math.log(v)) + np.linalg.slogdet(c)[1]), v

    assert np.allclose([ll[0], s2[0]], dense(np.arange(60)), rtol=1e-8)
    gappy = z.copy()
    gappy[[20, 21, 40]] = np.nan
    ll, s2, _ = ai.kalman(gappy, np.array([ar]).reshape(1, -1), np.array([ma]).reshape(1, -1), np.array([50.0]))
    assert np.allclose([ll[0], s2[0]], dense(np.flatnonzero(~np.isnan(gappy))), rtol=1e-8)


@pytest.mark.parametrize("ar, ma", [([], [0.6]), ([0.7], [0.4]), ([0.6, 0.0, 0.0, 0.0, 0.0, 0.0, 0.3], [])])
def test_coefficients_are_recovered(ar, ma):
    """Also an order beyond five."""
    z = arma(ar, ma, 600)
    _, x = ai.maximise(z, len(ar), len(ma), True)
    got = ai.unpack(x[None], len(ar), len(ma), True)
    assert np.abs(got[0][0] - ar).max(initial=0) < 0.12 and np.abs(got[1][0] - ma).max(initial=0) < 0.12


def test_stepwise_search_is_no_worse_than_the_true_order():
    z = arma([0.7], [0.4], 300)
    m = ai.fit_series(WEEKS[:300], z)
    assert m["d"] == 0
    ll, _ = ai.maximise(z, 1, 1, True)
    assert m["aic"] <= -2 * ll + 2 * 4 + 1e-3
    walk = np.cumsum(arma([], [], 300, mean=0.0))
    assert ai.fit_series(WEEKS[:300], walk)["d"] == 1


def test_arima_forecasts_from_its_table(spark):
    walk = np.cumsum(arma([0.6], [], 160, mean=0.3)) + 100
    df = frame(spark, walk).union(frame(spark, [5.0] * 30, "flat")).union(frame(spark, [1.0, 2.0], "short"))
    fits = ai.arima_fit(df, ["segment"]).persist()
    (m,) = fits.collect()                     # constant and short series have no model
    assert m.segment == "g" and m.d == 1 and m.last_week == MONDAY + timedelta(weeks=159)
    out = ai.arima_forecast(fits, ["segment"], 5).orderBy("step").collect()
    z, level = list(np.diff(walk)), walk[-1]
    if (m.p, m.q) == (1, 0):
        for r in out:
            z.append(m.mean + m.ar[0] * (z[-1] - m.mean))
            level += z[-1]
            assert abs(r.predicted - level) < 1e-6 * abs(level)
    width = [r.upper_bound - r.lower_bound for r in out]
    assert abs(width[0] - 2 * ai.Z_95 * math.sqrt(m.sigma2)) < 1e-9 and width == sorted(width)
    assert out[0].week == MONDAY + timedelta(weeks=160)
    held = ai.arima_holdout(df, ["segment"], 12).collect()
    assert sum(r.segment == "g" for r in held) == 12 and all((r.predicted is None) == (r.segment != "g") for r in held)


def test_arima_of_one_global_series_with_gaps(spark):
    z = arma([0.7], [], 140)
    df = frame(spark, z, skip=(30, 31, 90)).drop("segment")
    (m,) = ai.arima_fit(df).collect()
    assert m.n == 137 and ai.arima_forecast(ai.arima_fit(df), [], 3).count() == 3


# ------------------------------------------------------------------ trend

def test_a_planted_slope_change_is_found(spark):
    t = np.arange(208.0)
    y = 1e6 * (5 + 0.01 * t + 0.05 * np.maximum(t - 100, 0) + 0.3 * np.sin(2 * np.pi * t * 7 / tn.YEAR_DAYS))
    df = frame(spark, y)
    (m,) = tn.changepoint_fit(df, ["segment"]).collect()
    k = len(m.changepoints)
    jump = np.array(m.coef[2:2 + k])
    places = np.array([(c - MONDAY).days / 7 for c in m.changepoints])
    assert k == 25 and abs(places[np.abs(jump) > 0.2 * np.abs(jump).max()] - 100).max() <= 10
    out = tn.changepoint_forecast(tn.changepoint_fit(df, ["segment"]), ["segment"], 8).orderBy("step").collect()
    due = 1e6 * (5 + 0.01 * (t[-1] + 8) + 0.05 * (t[-1] + 8 - 100))
    assert abs(out[-1].trend / due - 1) < 0.05
    assert out[0].week == MONDAY + timedelta(weeks=208)


def test_no_penalty_is_least_squares():
    rng = np.random.default_rng(2)
    days, y = 7 * np.arange(150), rng.normal(size=150) + 10
    p = tn.TrendParams(changepoints=5, order=2, change_scale=0.0)
    changes, b, scale, _ = tn.fit_series(days, y, p)
    x = tn.basis(days, 0, int(days[-1]), changes, 2)
    assert np.allclose(x @ b * scale, x @ np.linalg.lstsq(x, y, rcond=None)[0])


def test_descent_meets_the_optimality_conditions():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6))
    y = x @ np.array([1.0, 0, 0, 2.0, 0, 0.02]) + rng.normal(size=200) * 0.1
    soft, ridge = np.array([0, 20.0, 20, 20, 20, 20]), np.array([0.1, 0, 0, 0, 0, 0])
    b, s2 = tn.descend(x.T @ x, x.T @ y, y @ y, 200, soft, ridge, 0.5)
    grad = x.T @ (y - x @ b) - s2 * ridge * b
    assert np.abs(grad[0]) < 1e-5
    for j in range(1, 6):
        assert abs(grad[j]) <= s2 * soft[j] * (1 + 1e-6) and (b[j] == 0 or abs(grad[j] - np.sign(b[j]) * s2 * soft[j]) < 1e-5)


def test_short_series_have_no_trend(spark):
    df = frame(spark, [1.0] * 40).union(frame(spark, [1.0], "one"))
    out = tn.changepoint_holdout(df, ["segment"], 12).collect()
    assert len(out) == 41 and all((r.yhat is None) == (r.segment == "one") for r in out)
    assert {r.role for r in out if r.segment == "g"} == {"train", "test"}
    assert tn.changepoint_holdout(df.where("segment = 'g'").drop("segment"), [], 12).count() == 40


# ------------------------------------------------------------------ Dickey-Fuller

def plain_adf(y):
    """Lag by AIC on the weeks with all lags, then the fit on all weeks with its own."""
    n = len(y)
    most = max(min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2), 0)
    dy = np.diff(y)

    def fit(lags, first):
        rows = np.arange(first, len(dy))
        x = np.column_stack([np.ones(len(rows)), y[rows], *[dy[rows - i] for i in range(1, lags + 1)]])
        beta, *_ = np.linalg.lstsq(x, dy[rows], rcond=None)
        rss = ((dy[rows] - x @ beta) ** 2).sum()
        se = math.sqrt(rss / (len(rows) - lags - 2) * np.linalg.inv(x.T @ x)[1, 1])
        return len(rows) * math.log(rss / len(rows)) + 2 * (lags + 2), beta[1] / se, len(rows)

    lags = min(range(most + 1), key=lambda k: (fit(k, most)[0], k))
    return lags, fit(lags, lags)[2], fit(lags, lags)[1]


@pytest.mark.parametrize("ar", [[], [0.9], [0.5, 0.2, 0.0, 0.25]])
def test_lag_and_statistic_equal_the_plain_regressions(spark, ar):
    y = arma(ar, [], 150)
    lags, n, t = plain_adf(y)
    r = ur.adf_auto(frame(spark, y), ["segment"]).first()
    assert (r.lags, r.n) == (lags, n) and abs(r.t_stat - t) < 1e-6


def test_p_values(spark):
    """The response surface meets the tabulated critical values; the normal tail is exact."""
    df = spark.createDataFrame([(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)], "t double, p double")
    for r in df.select("p", ur.mackinnon_p(F.col("t")).alias("got")).collect():
        assert abs(r.got - r.p) < 0.001
    z = spark.createDataFrame([(x / 4,) for x in range(-40, 41)], "z double")
    for r in z.select("z", ur.normal_cdf(F.col("z")).alias("p")).collect():
        want = 0.5 * math.erfc(-r.z / math.sqrt(2))
        assert abs(r.p - want) <= 1e-7 * min(want, 1)


def test_degenerate_series_have_no_statistic(spark):
    df = frame(spark, [3.0] * 40).union(frame(spark, [1.0, 5.0, 2.0], "short"))
    got = {r.segment: r for r in ur.adf_auto(df, ["segment"]).collect()}
    assert got["g"].t_stat is None and got["g"].p_value is None and got["short"].t_stat is None
    walk = np.cumsum(arma([], [], 120, mean=0.0))
    one = ur.adf_auto(frame(spark, walk, skip=(50,)).drop("segment")).first()
    assert one.p_value > 0.05 and not one.stationary


# ------------------------------------------------------------------ model table

def test_forecasts_from_the_table_equal_those_of_the_fits(spark, tmp_path):
    y = [1e6 * (1 + v / 100) for v in arma([0.5, 0.2], [], 200)]
    df = frame(spark, y).union(frame(spark, [v * 2 for v in y], "h", skip=(60,)))
    mt.fit_table(df, ["segment"]).write.parquet(f"{tmp_path}/models")
    table = spark.read.parquet(f"{tmp_path}/models")
    got = {(r.model, r.segment, r.step): r for r in mt.forecast_table(table, ["segment"], 9).collect()}
    assert len(got) == 3 * 2 * 9
    ar = li.ar_forecast(df, li.ar_order_selection(df, ["segment"]), ["segment"], 9).collect()
    ses = fc.flat_forecast(li.ses_fit(df, ["segment"]), ["segment"], 9).collect()
    for name, rows in (("ar", ar), ("ses", ses)):
        for r in rows:
            g = got[name, r.segment, r.step]
            assert g.week == r.week and abs(g.predicted / r.predicted - 1) < 1e-12
    whole = df.where("segment = 'g'")
    held = {r.ds: r.yhat for r in li.fourier_trend(whole, ["segment"], 12).where("role = 'test'").collect()}
    train = whole.where(F.col("week") < min(held))
    out = mt.forecast_table(mt.fourier_rows(train, ["segment"]), ["segment"], 12).collect()
    assert {r.week for r in out} == set(held) and all(abs(r.predicted / held[r.week] - 1) < 1e-9 for r in out)
    assert mt.forecast_table(table.withColumn("version", F.lit(99)), ["segment"], 9).count() == 0
    assert mt.forecast_table(mt.fit_table(whole.drop("segment")), [], 2).count() == 6


# ------------------------------------------------------------------ averages in one fold, checks in one scan

def test_averages_equal_the_running_ones(spark):
    y = arma([0.5], [], 60)
    weekly = frame(spark, y).withColumn("extra", F.lit("x"))
    for keys, df in ((["segment"], weekly.union(weekly.withColumn("segment", F.lit("h")))), ([], weekly.drop("segment"))):
        out = fe.with_averages(df, keys).orderBy(*keys, "week").limit(60).collect()
        assert out[0]._ema_4 is None and list(out[0].asDict())[:len(df.columns)] == df.columns
        e4 = e12 = y[0]
        for r, v in zip(out[1:], y[1:]):
            assert (r._ema_4, r._ema_12) == (e4, e12)
            e4, e12 = e4 * (1 - 2 / 5) + v * (2 / 5), e12 * (1 - 2 / 13) + v * (2 / 13)


def test_checks_read_a_table_once(spark):
    from hebdo.operators import checks as ck
    from test_plans import plan_of
    rows = [(1, "a", 2.0), (1, "a", -1.0), (2, None, float("nan")), (None, "b", 3.0)]
    df = spark.createDataFrame(rows, "id int, name string, x double")
    got = {r.rule: r.violations for r in ck.check_table(df, ["id"], non_negative=["x"], not_null=["name", "x"], finite=["x"]).collect()}
    assert got == {"non_empty": 0, "non_negative:x": 1, "not_null:name": 1, "not_null:x": 1, "finite:x": 1, "unique:id": 1}
    empty = {r.rule: r.violations for r in ck.check_table(df.limit(0), ["id"], non_negative=["x"]).collect()}
    assert empty == {"non_empty": 1, "non_negative:x": 0, "unique:id": 0}
    assert plan_of(ck.check_table(df, ["id"], non_negative=["x"])).count("Scan ExistingRDD") <= 2


