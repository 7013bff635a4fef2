"""Properties of the operators on small fixtures and on the sf0.001 tables."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hebdo.operators import checks as ck
from hebdo.operators import features as fe
from hebdo.operators import linear as li
from hebdo.operators import weekly as wk
from hebdo.sources import tpch

KEYS = ["segment"]


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_active_customers_rewrite_equals_range_join_fixture(spark):
    # mid-week joiners, Monday-midnight joiners, pre-calendar joiners,
    # inactive ones and joiners after the last calendar week
    cust = spark.createDataFrame([
        ("a", "x", dt.datetime(2023, 12, 1, 10), "active"),    # before calendar
        ("b", "x", dt.datetime(2024, 1, 8, 0), "active"),      # Monday midnight
        ("c", "x", dt.datetime(2024, 1, 10, 13), "active"),    # mid-week
        ("d", "x", dt.datetime(2024, 1, 10, 13), "inactive"),
        ("e", "y", dt.datetime(2024, 1, 21, 23, 59), "active"),  # Sunday night
        ("f", "x", dt.datetime(2024, 3, 1), "active"),         # after calendar
    ], "customer_id string, segment string, created_time timestamp_ntz, status string")
    inv = spark.createDataFrame([("x", dt.datetime(2024, 1, 2)), ("y", dt.datetime(2024, 2, 1))],
                                "segment string, date timestamp_ntz")
    cal = wk.week_calendar(inv, KEYS)
    a = rows(wk.active_customers(cust, cal, KEYS), ["segment", "week"])
    b = rows(wk.active_customers_range_join(cust, cal, KEYS).select("segment", "week", "active_customers"),
             ["segment", "week"])
    assert a == b
    assert a[0] == ("x", dt.date(2024, 1, 1), 1)


def test_active_customers_rewrite_equals_range_join_tables(spark):
    cust = tpch.customers(spark, SF_SMALL, KEYS)
    cal = wk.week_calendar(tpch.invoices(spark, SF_SMALL, KEYS), KEYS)
    a = rows(wk.active_customers(cust, cal, KEYS), ["segment", "week"])
    b = rows(wk.active_customers_range_join(cust, cal, KEYS).select("segment", "week", "active_customers"),
             ["segment", "week"])
    assert a == b


@pytest.fixture(scope="module")
def weekly(spark):
    inv = tpch.invoices(spark, SF_SMALL, KEYS)
    pay = tpch.payments(spark, SF_SMALL, KEYS)
    cus = tpch.customers(spark, SF_SMALL, KEYS)
    return wk.build_weekly_metrics(inv, pay, cus, KEYS).persist()


def test_calendar_gap_free_and_checks_pass(spark, weekly):
    g = weekly.groupBy("segment").agg(F.count("*").alias("n"), F.min("week").alias("lo"),
                                      F.max("week").alias("hi")).collect()
    for r in g:
        assert r.n == (r.hi - r.lo).days // 7 + 1
    ck.require(ck.check_weekly(weekly, KEYS))


def test_require_raises_on_violation(spark):
    bad = spark.createDataFrame([(dt.date(2024, 1, 1), -1.0), (dt.date(2024, 1, 1), 2.0)],
                                "week date, weekly_revenue double")
    res = {r.rule: r.violations for r in ck.check_table(bad, ["week"], non_negative=["weekly_revenue"]).collect()}
    assert res["non_negative:weekly_revenue"] == 1 and res["unique:week"] == 1
    with pytest.raises(ValueError):
        ck.require(ck.check_table(bad, ["week"], non_negative=["weekly_revenue"]))


def test_features_match_pandas_twin(spark, weekly):
    seg = weekly.select("segment").first()[0]
    one = weekly.where(F.col("segment") == seg).drop("segment")
    ours = fe.add_features(one, []).orderBy("week").toPandas()
    y = ours["weekly_revenue"]
    s = y.shift(1)
    twin = {
        "lag_26": y.shift(26),
        "rolling_mean_12": s.rolling(12).mean(),
        "rolling_std_8": s.rolling(8).std(),
        "ema_12": s.ewm(span=12, adjust=False).mean(),
        "revenue_growth_4w": (y.shift(1) / y.shift(4)).replace([np.inf, -np.inf], np.nan) - 1,
        "customer_trend_4": ours["active_customers"].shift(1).rolling(4).mean(),
    }
    for name, expect in twin.items():
        got = ours[name].astype(float)
        assert (got.isna() == expect.isna()).all(), name
        m = ~expect.isna()
        np.testing.assert_allclose(got[m], expect[m], rtol=1e-9, atol=1e-6, err_msg=name)


def test_no_feature_leaks_the_current_week(spark, weekly):
    seg = weekly.select("segment").first()[0]
    one = weekly.where(F.col("segment") == seg).drop("segment")
    target_week = one.orderBy("week").collect()[100].week
    bumped = one.withColumn("weekly_revenue", F.when(F.col("week") == target_week,
                                                     F.col("weekly_revenue") * 7 + 123.0)
                            .otherwise(F.col("weekly_revenue")))
    a = fe.add_features(one, []).where(F.col("week") == target_week).select(*fe.FEATURES).first()
    b = fe.add_features(bumped, []).where(F.col("week") == target_week).select(*fe.FEATURES).first()
    assert tuple(a) == tuple(b)


def test_keyed_equals_single_series(spark, weekly):
    keyed = fe.model_ready(weekly, KEYS)
    seg = weekly.select("segment").first()[0]
    single = fe.model_ready(weekly.where(F.col("segment") == seg).drop("segment"), [])
    a = rows(keyed.where(F.col("segment") == seg).drop("segment"), ["week"])
    b = rows(single, ["week"])
    assert a == b


def test_ses_fold_matches_numpy(spark, weekly):
    seg = weekly.select("segment").first()[0]
    one = weekly.where(F.col("segment") == seg)
    g = li.ses_grid_fit(one, KEYS).where(F.col("alpha") == 0.3).first()
    y = [r.weekly_revenue for r in one.orderBy("week").select("weekly_revenue").collect()]
    level, sse = y[0], 0.0
    for x in y[1:]:
        sse += (x - level) ** 2
        level = level * (1 - 0.3) + x * 0.3
    assert g.level == pytest.approx(level, rel=1e-12)
    assert g.sse == pytest.approx(sse, rel=1e-9)


def test_normal_equations_recover_coefficients(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": np.repeat(["a", "b"], 50), "x1": rng.normal(size=100)})
    pdf["one"] = 1.0
    coef = {"a": (2.0, -3.0), "b": (0.5, 4.0)}
    pdf["y"] = [coef[g][0] + coef[g][1] * x for g, x in zip(pdf.g, pdf.x1)]
    df = spark.createDataFrame(pdf)
    st = li.normal_equations(df, ["g"], ["one", "x1"], "y")
    out = {r.g: r.coef for r in li.solve_normal_equations(st, 2).collect()}
    for g, c in coef.items():
        np.testing.assert_allclose(out[g], c, atol=1e-9)


def test_ar1_walk_forward_equals_per_origin_least_squares(spark, weekly):
    ready = fe.model_ready(weekly, KEYS)
    seg = ready.select("segment").first()[0]
    one = ready.where(F.col("segment") == seg).orderBy("week").toPandas()
    wf = li.ar1_walk_forward(ready.where(F.col("segment") == seg), KEYS, initial=30).orderBy("week").toPandas()
    i = 30
    x, y = one["lag_1"].to_numpy()[:i], one["weekly_revenue"].to_numpy()[:i]
    b, a = np.polyfit(x, y, 1)
    assert wf["predicted"].iloc[0] == pytest.approx(a + b * one["lag_1"].iloc[i], rel=1e-8)


def test_drop_partial_last_week(spark):
    cust = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), "active")],
                                 "customer_id string, created_time timestamp_ntz, status string")
    def ledger(last):
        inv = spark.createDataFrame([("i1", dt.datetime(2024, 1, 1), 10.0), ("i2", last, 5.0)],
                                    "invoice_id string, date timestamp_ntz, total double")
        pay = spark.createDataFrame([], "payment_id string, date timestamp_ntz, amount double")
        return inv, pay
    inv, pay = ledger(dt.datetime(2024, 1, 10))          # Wednesday: partial week
    kept = wk.build_weekly_metrics(inv, pay, cust, []).count()
    dropped = wk.build_weekly_metrics(inv, pay, cust, [], drop_partial_last=True).count()
    assert (kept, dropped) == (2, 1)
    inv, pay = ledger(dt.datetime(2024, 1, 14, 12))      # Sunday: complete week
    assert wk.build_weekly_metrics(inv, pay, cust, [], drop_partial_last=True).count() == 2
