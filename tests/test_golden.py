"""Small golden literals (semantics that must survive)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hebdo.functions.columns import (
    ema_of_array, safe_lag_of_array, week_start, weighted_recent_average,
)
from hebdo.operators import evaluate as ev
from hebdo.operators import forecast as fc
from hebdo.operators.folds import expanding_folds
from hebdo.operators.weekly import week_calendar


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_sunday_night_belongs_to_previous_monday(spark):
    ts = F.lit("2024-03-03 23:59:59").cast("timestamp_ntz")
    assert one(spark, week_start(ts)) == dt.date(2024, 2, 26)


def test_iso_week_53(spark):
    assert one(spark, F.weekofyear(F.lit(dt.date(2020, 12, 28)))) == 53


def test_horizon_to_end_of_month(spark):
    h = fc.horizon_weeks(F.lit(dt.date(2025, 12, 22)), None, F.lit(2), F.lit(2026))
    assert one(spark, h) == 9
    assert one(spark, fc.horizon_weeks(F.lit(dt.date(2025, 12, 22)), weeks=26)) == 26


def test_target_month_clips_to_month_end(spark):
    assert one(spark, fc.target_month(F.lit(dt.date(2025, 12, 31)), 2)) == dt.date(2026, 2, 28)


def test_ema_span4(spark):
    arr = F.array(*[F.lit(float(x)) for x in (1, 2, 3)])
    assert one(spark, ema_of_array(arr, 4)) == pytest.approx(2.04)
    assert one(spark, ema_of_array(F.array().cast("array<double>"), 4)) is None


def test_ema_matches_pandas(spark):
    xs = [5.0, 7.5, 3.25, 10.0, 8.0, 1.0, 4.0]
    arr = F.array(*[F.lit(x) for x in xs])
    expect = pd.Series(xs).ewm(span=12, adjust=False).mean().iloc[-1]
    assert one(spark, ema_of_array(arr, 12)) == pytest.approx(expect, rel=1e-14)


def test_weighted_recent_average_and_safe_lag(spark):
    xs = [float(x) for x in range(1, 12)]
    arr = F.array(*[F.lit(x) for x in xs])
    assert one(spark, weighted_recent_average(arr)) == pytest.approx(
        np.average(xs[-8:], weights=np.arange(1, 9)))
    short = F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, weighted_recent_average(short)) == pytest.approx((3 + 8) / 3)
    assert one(spark, weighted_recent_average(F.array().cast("array<double>"))) == 0.0
    assert one(spark, safe_lag_of_array(arr, 1)) == 11.0
    assert one(spark, safe_lag_of_array(arr, 26)) == 1.0  # too short -> first


def test_calendar_208_weeks(spark):
    inv = spark.createDataFrame(
        [(dt.datetime(2022, 1, 3, 9),), (dt.datetime(2025, 12, 24, 18),)], "date timestamp_ntz")
    cal = week_calendar(inv, [])
    weeks = [r.week for r in cal.orderBy("week").collect()]
    assert len(weeks) == 208 and weeks[0] == dt.date(2022, 1, 3) and weeks[-1] == dt.date(2025, 12, 22)
    assert all((b - a).days == 7 for a, b in zip(weeks, weeks[1:]))


@pytest.mark.parametrize("n", [1, 12, 20, 21, 40, 60])
def test_conformal_quantile_is_numpy_higher(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.permutation(np.arange(n, dtype=float) * 1.5)
    df = spark.createDataFrame([(float(v),) for v in vals], "abs_error double")
    q = ev.conformal_quantile(df, []).first()["quantile"]
    assert q == float(np.quantile(vals, 0.95, method="higher"))
    if n == 12:
        assert q == vals.max()


def test_percentile_disc_differs_at_20_and_40(spark):
    for n in (20, 40):
        vals = np.arange(n, dtype=float)
        df = spark.createDataFrame([(float(v),) for v in vals], "abs_error double")
        ours = ev.conformal_quantile(df, []).first()["quantile"]
        disc = df.agg(F.percentile_disc(0.95, F.col("abs_error")).alias("p")).first()["p"] \
            if hasattr(F, "percentile_disc") else \
            df.selectExpr("percentile_disc(0.95) WITHIN GROUP (ORDER BY abs_error) AS p").first()["p"]
        assert ours != disc


def test_expanding_folds_match_time_series_split(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 6) + dt.timedelta(weeks=i),) for i in range(170)],
                               "week date")
    folds = expanding_folds(df, []).groupBy("fold", "role").count().collect()
    got = {(r.fold, r.role): r["count"] for r in folds}
    for f, train in enumerate([30, 58, 86, 114, 142]):
        assert got[(f, "train")] == train and got[(f, "test")] == 28


def test_confidence_stability_drift(spark):
    pred = spark.createDataFrame([(100.0, 90.0), (200.0, 230.0), (300.0, 300.0)],
                                 "actual double, predicted double")
    q = spark.createDataFrame([(30.0,)], "quantile double")
    conf = ev.forecast_confidence(pred, q, []).first()["forecast_confidence"]
    mean_pred = (90 + 230 + 300) / 3
    assert conf == round((1 - 30 / mean_pred) * 100, 2)
    st = ev.model_stability(pred, []).first()
    errs = np.abs(np.array([10.0, 30.0, 0.0]))
    assert st.model_stability == round(100 / (1 + errs.std() / max(errs.mean(), 1)), 2)
    assert st.drift_detected == (st.model_stability < 75)


def test_horizon_interval_widens_with_sqrt_step(spark):
    f = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(weeks=i), 10.0) for i in range(4)],
                              "week date, predicted double")
    q = spark.createDataFrame([(2.0,)], "quantile double")
    rows = ev.interval_horizon(f, q, []).orderBy("week").collect()
    for i, r in enumerate(rows, start=1):
        assert r.upper_bound == pytest.approx(10 + 2 * math.sqrt(i))
        assert r.lower_bound == pytest.approx(10 - 2 * math.sqrt(i))


# A published 12-week boosted-tree holdout (week, actual,
# predicted) and the interval / confidence / stability it yields.
HOLDOUT_12 = [
    ("2025-10-06", 6208719.76, 6339416.5),
    ("2025-10-13", 7160603.15, 6430697.0),
    ("2025-10-20", 7112510.58, 6490568.5),
    ("2025-10-27", 6864275.47, 6045760.0),
    ("2025-11-03", 6137731.93, 6330638.5),
    ("2025-11-10", 7219149.02, 6141251.0),
    ("2025-11-17", 6761632.43, 6168629.0),
    ("2025-11-24", 6343397.84, 6473685.0),
    ("2025-12-01", 7256302.47, 6349226.5),
    ("2025-12-08", 7790523.58, 7009562.5),
    ("2025-12-15", 8146737.54, 6357588.5),
    ("2025-12-22", 7879617.09, 6340619.5),
]
EXPECT_QUANTILE = 1789149.04
EXPECT_CONFIDENCE = 71.93
EXPECT_STABILITY = 61.01


def test_published_holdout_health(spark):
    pred = spark.createDataFrame(
        [(dt.date.fromisoformat(w), a, p) for w, a, p in HOLDOUT_12],
        "week date, actual double, predicted double")
    q = ev.conformal_quantile(ev.with_errors(pred), [])
    assert q.first()["quantile"] == pytest.approx(EXPECT_QUANTILE, abs=0.01)
    assert ev.forecast_confidence(pred, q, []).first()[0] == EXPECT_CONFIDENCE
    st = ev.model_stability(pred, []).first()
    assert st.model_stability == EXPECT_STABILITY and st.drift_detected
    cov = ev.coverage(ev.interval_constant(pred, q, []), []).first()
    assert (cov.covered, cov.n) == (12, 12)


def test_rolling_rmse_band_matches_pandas(spark):
    rng = np.random.default_rng(7)
    n = 30
    actual = rng.normal(100, 10, n)
    predicted = actual + rng.normal(0, 5, n)
    weeks = [dt.date(2024, 1, 1) + dt.timedelta(weeks=i) for i in range(n)]
    df = spark.createDataFrame([(w, float(a), float(p)) for w, a, p in zip(weeks, actual, predicted)],
                               "week date, actual double, predicted double")
    got = ev.rolling_rmse_band(df, []).orderBy("week").toPandas()
    err = pd.Series(actual - predicted)
    expect = err.shift(1).pow(2).rolling(window=12, min_periods=4).mean().pow(0.5).bfill()
    np.testing.assert_allclose(got["rolling_rmse"], expect, rtol=1e-12)
    np.testing.assert_allclose(got["upper_bound"], predicted + expect, rtol=1e-12)
