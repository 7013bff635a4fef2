"""Tree model, tuning, walk-forward and recursive forecasting on sf0.001
with tiny budgets (the registered queries use the full tables)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hebdo.operators import evaluate as ev
from hebdo.operators import features as fe
from hebdo.operators import forecast as fc
from hebdo.operators import trees as tr
from hebdo.operators import weekly as wk
from hebdo.sources import tpch

KEYS = ["segment"]
SMALL = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def ready(spark):
    weekly = wk.build_weekly_metrics(tpch.invoices(spark, SF_SMALL, KEYS),
                                     tpch.payments(spark, SF_SMALL, KEYS),
                                     tpch.customers(spark, SF_SMALL, KEYS), KEYS)
    return fe.model_ready(weekly, KEYS).persist()


@pytest.fixture(scope="module")
def fitted(ready):
    return tr.holdout(ready, KEYS, SMALL)


def test_holdout_roles_and_metrics(fitted):
    model, pred = fitted
    roles = {r.role: r["count"] for r in pred.groupBy("role").count().collect()}
    n_series = pred.select("segment").distinct().count()
    assert roles["test"] == 12 * n_series
    m = ev.train_test_metrics(pred, KEYS).collect()
    assert all(r.mae >= 0 and r.rmse >= r.mae for r in m)


def test_recursive_forecast_first_step_uses_next_week_features(spark, ready, fitted):
    model, _ = fitted
    state = fc.forecast_state(ready, KEYS)
    out = fc.recursive_forecast(model, state, KEYS, 3, checkpoint_every=2)
    assert out.count() == 3 * state.count()
    first = out.where("step = 1").select("segment", "week", *fe.FEATURES)
    direct = fc.next_week_features(state, KEYS)
    a = sorted(tuple(r) for r in first.collect())
    b = sorted(tuple(r) for r in direct.collect())
    assert a == b
    # the prediction of step 1 is the model applied to those features
    scored = {r.segment: r.predicted for r in model.transform(direct).collect()}
    for r in out.where("step = 1").collect():
        assert r.weekly_revenue == pytest.approx(scored[r.segment])
    # the second step sees the first prediction as lag_1
    s2 = {r.segment: r.lag_1 for r in out.where("step = 2").collect()}
    for r in out.where("step = 1").collect():
        assert s2[r.segment] == pytest.approx(r.weekly_revenue)


def test_run_forecast_to_month_end(spark, ready, fitted):
    model, pred = fitted
    res = ev.with_errors(pred.where("role = 'test'"))
    out = fc.run_forecast(ready, model, res, KEYS, forecast_type="months", months_ahead=1)
    assert out.count() > 0
    row = out.orderBy(F.desc("step")).first()
    assert row.upper_bound >= row.weekly_revenue >= row.lower_bound
    assert row.best_case == row.upper_bound and row.confidence == 95.0


def test_walk_forward_refit_schedule(ready):
    from hebdo.operators.folds import walk_forward_origins
    due = walk_forward_origins(ready, KEYS, 30).select("segment", "week")
    out = tr.walk_forward(ready, KEYS, SMALL, initial=30, refit_every=200).select("segment", "week")
    assert due.count() > 0 and out.exceptAll(due).count() == 0 and due.exceptAll(out).count() == 0
    assert tr.walk_forward(ready, KEYS, SMALL, initial=10_000).count() == 0


def test_tuning_lists_the_settings_it_ran(ready, monkeypatch):
    draws = [{**p, "n_estimators": 3 + i} for i, p in enumerate(tr.sample_params(2, tr.SEED))]
    ran, run = [], tr.run_fits
    monkeypatch.setattr(tr, "sample_params", lambda *a: draws)
    monkeypatch.setattr(tr, "run_fits", lambda df, fits, *a: (ran.extend(fits), run(df, fits, *a))[1])
    board = tr.tune(ready, KEYS, n_iter=2, n_splits=2)
    rows = board.collect()
    assert sorted((f.params.n_estimators, f.params.learning_rate) for f in ran) == sorted(
        (r.n_estimators, r.learning_rate) for r in rows for _ in range(2))
    assert tr.best_params(board) == draws[rows[0].draw]


def test_walk_forward_of_ragged_series_follows_its_own_origins(ready):
    late = ready.where("segment <> 'BUILDING' or week >= date'1994-01-03'")
    out = tr.walk_forward(late, KEYS, SMALL, initial=20, refit_every=200)
    from hebdo.operators.folds import walk_forward_origins
    due = walk_forward_origins(late, KEYS, 20).select("segment", "week")
    assert out.select("segment", "week").exceptAll(due).count() == 0
    assert due.exceptAll(out.select("segment", "week")).count() == 0


def test_importances(ready, fitted):
    model, _ = fitted
    top = tr.feature_importance(ready.sparkSession, model).collect()
    assert len(top) == 20 and top[0].importance >= top[-1].importance >= 0
    test = ready.join(fitted[1].where("role = 'test'").select("segment", "week"), ["segment", "week"])
    perm = tr.permutation_importance(model, test, KEYS, features=fe.FEATURES[:3]).collect()
    assert len(perm) == 3


def _gappy(spark, weeks, value):
    from datetime import date, timedelta
    rows = [("g", date(2020, 1, 6) + timedelta(weeks=i), float(value(i))) for i in weeks]
    return spark.createDataFrame(rows, "segment string, week date, weekly_revenue double")


def test_fourier_season_follows_the_calendar(spark):
    import math
    from hebdo.operators import linear as li
    wave = lambda i: 100 + 10 * math.sin(2 * math.pi * i / li.YEAR_WEEKS)
    weeks = [i for i in range(220) if not 60 <= i < 87]
    out = li.fourier_trend(_gappy(spark, weeks, wave), ["segment"], ridge=1e-9).collect()
    assert len(out) == len(weeks)
    assert max(abs(r.y - r.yhat) for r in out) < 1e-3


def test_lags_skip_missing_weeks(spark):
    import numpy as np
    from hebdo.operators import linear as li
    rng = np.random.default_rng(3)
    y = np.cumsum(rng.normal(size=200)) * 0.1 + rng.normal(size=200) + 50
    weeks = [i for i in range(200) if i % 41 != 40]
    df = _gappy(spark, weeks, lambda i: y[i])
    have = set(weeks)
    pairs = [(y[i - 1], y[i] - y[i - 1]) for i in weeks if i - 1 in have]
    r = li.df_test(df, ["segment"]).first()
    assert r.n == len(pairs)
    assert abs(r.gamma - np.polyfit(*map(np.array, zip(*pairs)), 1)[0]) < 1e-9
    full = [i for i in weeks if {i - 1, i - 2, i - 3} <= have]
    assert li.ar_order_selection(df, ["segment"]).first().n == len(full)


def _ar2(n, seed=11):
    import numpy as np
    rng = np.random.default_rng(seed)
    y = [1e6, 1.1e6]
    for _ in range(n - 2):
        y.append(4e5 + 0.5 * y[-1] + 0.2 * y[-2] + rng.normal() * 1e5)
    return y


def test_adf_equals_least_squares(spark):
    import numpy as np
    from hebdo.operators import linear as li
    y = np.array(_ar2(180))
    for lags in (0, 1, 3):
        dy = np.diff(y)
        target = dy[lags:]
        x = np.column_stack([np.ones(len(target)), y[lags:-1], *[dy[lags - i:len(dy) - i] for i in range(1, lags + 1)]])
        beta, rss, *_ = np.linalg.lstsq(x / [1, *[1e6] * (lags + 1)], target, rcond=None)
        se = np.sqrt(rss[0] / (len(target) - lags - 2) * np.linalg.inv((x / [1, *[1e6] * (lags + 1)]).T
                                                                       @ (x / [1, *[1e6] * (lags + 1)]))[1, 1])
        r = li.adf_test(_gappy(spark, range(180), lambda i: y[i]), ["segment"], lags=lags).first()
        assert r.n == len(target)
        assert abs(r.t_stat - beta[1] / se) < 1e-6
    assert li.adf_test(_gappy(spark, range(180), lambda i: 5.0), ["segment"]).first().t_stat is None


def test_ar_forecast_iterates_the_chosen_model(spark):
    from datetime import date, timedelta
    from hebdo.operators import linear as li
    y = _ar2(200)
    for d, values in ((0, y), (1, [sum(y[:i + 1]) for i in range(200)])):
        df = _gappy(spark, range(200), lambda i: values[i])
        fit = li.ar_order_selection(df, ["segment"])
        one = fit.first()
        z = list(values) if one.d == 0 else [b - a for a, b in zip(values, values[1:])]
        assert one.d == d
        level, due = values[-1], []
        for _ in range(9):
            z.append(one.coef[0] + sum(one.coef[i] * z[-i] for i in range(1, one.p + 1)))
            level = z[-1] if one.d == 0 else level + z[-1]
            due.append(level)
        for keys, table in ((["segment"], df), ([], df.drop("segment"))):
            fits = fit if keys else li.ar_order_selection(table)
            out = li.ar_forecast(table, fits, keys, 9).orderBy("step").collect()
            assert [r.step for r in out] == list(range(1, 10))
            assert out[0].week == date(2020, 1, 6) + timedelta(weeks=200)
            assert max(abs(r.predicted / v - 1) for r, v in zip(out, due)) < 1e-9


def test_short_and_gappy_series_stay(spark):
    from datetime import date, timedelta
    from pyspark.sql import functions as F
    from hebdo.operators import linear as li
    y = _ar2(120)
    long = _gappy(spark, [i for i in range(120) if i not in (50, 113)], lambda i: y[i])
    short = _gappy(spark, range(3), lambda i: y[i]).withColumn("segment", F.lit("short"))
    both = long.unionByName(short)
    out = li.ar_forecast(both, li.ar_order_selection(both, ["segment"]), ["segment"], 4).collect()
    assert sorted((r.segment, r.step) for r in out) == [(s, i) for s in ("g", "short") for i in range(1, 5)]
    assert all((r.predicted is None) == (r.segment == "short") for r in out)
    held = {r.week: r for r in li.ar_holdout(long, ["segment"]).collect()}
    assert len(held) == 12 and all(r.predicted is not None for r in held.values())
    # the twelve test weeks span thirteen weeks: the last one is the thirteenth step
    train = long.where(F.col("week") < min(held))
    path = li.ar_forecast(train, li.ar_order_selection(train, ["segment"]), ["segment"], 13).collect()
    assert held[date(2020, 1, 6) + timedelta(weeks=119)].predicted == [r.predicted for r in path if r.step == 13][0]
