"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver
tables, series key = market segment. Each has a DuckDB twin in
``hebdo.plans.oracle`` unless it is a model fit (rows-only check)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hebdo.functions.columns import round_half_up as rnd
from hebdo.functions.columns import round_significant
from hebdo.operators import arima as ai
from hebdo.operators import checks as ck
from hebdo.operators import evaluate as ev
from hebdo.operators import features as fe
from hebdo.operators import folds as fo
from hebdo.operators import forecast as fc
from hebdo.operators import ledger as lg
from hebdo.operators import linear as li
from hebdo.operators import model_table as mt
from hebdo.operators import report as rp
from hebdo.operators import trees as tr
from hebdo.operators import trend as tn
from hebdo.operators import unit_root as ur
from hebdo.operators import weekly as wk
from hebdo.session import configure
from hebdo.sources import tpch

KEYS = ["segment"]
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


class Ledger:
    """Canonical ledger tables of one driver directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, keys=KEYS):
        self.keys = list(keys)
        self.invoices = tpch.invoices(spark, sf_dir, self.keys)
        self.payments = tpch.payments(spark, sf_dir, self.keys)
        self.customers = tpch.customers(spark, sf_dir, self.keys)

    def calendar(self):
        return wk.week_calendar(self.invoices, self.keys)

    def weekly(self):
        return wk.build_weekly_metrics(self.invoices, self.payments, self.customers, self.keys)


@query
def weekly_revenue(spark, sf_dir):
    return wk.weekly_revenue(tpch.invoices(spark, sf_dir, KEYS), KEYS)


@query
def weekly_payments(spark, sf_dir):
    return wk.weekly_payments(tpch.payments(spark, sf_dir, KEYS), KEYS)


@query
def new_customers(spark, sf_dir):
    return wk.new_customers(tpch.customers(spark, sf_dir, KEYS), KEYS)


@query
def week_calendar(spark, sf_dir):
    return Ledger(spark, sf_dir).calendar()


@query
def active_customers(spark, sf_dir):
    led = Ledger(spark, sf_dir)
    return wk.active_customers(led.customers, led.calendar(), KEYS)


@query
def weekly_metrics(spark, sf_dir):
    return Ledger(spark, sf_dir).weekly()


@query
def weekly_summary(spark, sf_dir):
    s = wk.weekly_summary(Ledger(spark, sf_dir).weekly(), KEYS)
    return s.select(
        *KEYS, "weeks", "first_week", "last_week", "total_revenue",
        rnd("mean_weekly_revenue", 4).alias("mean_weekly_revenue"),
        rnd("mean_active_customers", 6).alias("mean_active_customers"),
        rnd("mean_invoice_count", 6).alias("mean_invoice_count"),
        rnd("mean_payment_count", 6).alias("mean_payment_count"),
    )


# ---------------------------------------------------------------- features

TRIG_DIGITS = 9


def _present(df: DataFrame, names) -> DataFrame:
    """Round the four trig features (JVM vs C libm may differ in the last
    ulp); everything else is computed bit-identically to the SQL twin."""
    return df.select(*[rnd(n, TRIG_DIGITS).alias(n) if n in fe.CALENDAR_FEATURES else F.col(n)
                       for n in names])


def _feature_query(name, cols):
    def q(spark, sf_dir):
        weekly = Ledger(spark, sf_dir).weekly()
        return _present(fe.add_features(weekly, KEYS, cols), KEYS + ["week"] + cols)
    q.__name__ = name
    query(q)


def _register_feature_queries():
    from hebdo.plans.oracle import FEATURE_GROUPS
    for name, cols in FEATURE_GROUPS.items():
        _feature_query(name, list(cols))


_register_feature_queries()


_CACHE: dict = {}


def cached(spark, sf_dir, name, build):
    """Persist an intermediate table that several branches of a query (and
    later queries on the same data) read; keyed by application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _CACHE:
        _CACHE[key] = build().persist()
    return _CACHE[key]


def clear_cache(spark) -> None:
    """Drop every persisted intermediate (bench runs call this between
    queries so each one pays its full cost)."""
    _CACHE.clear()
    _MODELS.clear()
    spark.catalog.clearCache()


def ready_table(spark, sf_dir):
    """Model-ready table of the driver folder, series = segment (persisted:
    it is small - series x weeks x 40 columns - and read by most queries)."""
    return cached(spark, sf_dir, "ready",
                  lambda: fe.model_ready(Ledger(spark, sf_dir).weekly(), KEYS))


@query
def model_ready(spark, sf_dir):
    return _present(ready_table(spark, sf_dir), KEYS + ["week", fe.TARGET] + fe.FEATURES)


@query
def feature_summary(spark, sf_dir):
    s = fe.feature_summary(ready_table(spark, sf_dir), KEYS)
    return s.select(*KEYS, "rows", "columns", "features",
                    rnd("mean_revenue", 4).alias("mean_revenue"),
                    rnd("std_revenue", 4).alias("std_revenue"), "first_week", "last_week")


# ---------------------------------------------------------------- checks, ledger


@query
def checks_ledger(spark, sf_dir):
    led = Ledger(spark, sf_dir, keys=[])
    settled = lg.invoice_settlement(led.invoices, led.payments)
    return ck.check_ledger(settled, led.payments, led.customers)


@query
def checks_weekly(spark, sf_dir):
    return ck.check_weekly(Ledger(spark, sf_dir).weekly(), KEYS)


@query
def checks_features(spark, sf_dir):
    return ck.check_features(ready_table(spark, sf_dir), KEYS)


@query
def invoice_settlement(spark, sf_dir):
    led = Ledger(spark, sf_dir, keys=[])
    return lg.invoice_settlement(led.invoices, led.payments)


@query
def ledger_summary(spark, sf_dir):
    led = Ledger(spark, sf_dir, keys=[])
    s = lg.ledger_summary(led.invoices, led.payments, led.customers)
    return s.select("metric", rnd("value", 6).alias("value"))


# ---------------------------------------------------------------- folds, models, evaluation


def _money(df: DataFrame, cols, digits: int = 2) -> DataFrame:
    """Round money columns computed by order-dependent aggregates."""
    return df.withColumns({c: rnd(c, digits) for c in cols})


def _ready_split(spark, sf_dir):
    return fo.holdout_split(ready_table(spark, sf_dir), KEYS)


@query
def holdout_split(spark, sf_dir):
    return _ready_split(spark, sf_dir).select(*KEYS, "week", "role")


@query
def expanding_folds(spark, sf_dir):
    train = _ready_split(spark, sf_dir).where("role = 'train'")
    return fo.expanding_folds(train, KEYS)


@query
def walk_forward_origins(spark, sf_dir):
    return fo.walk_forward_origins(ready_table(spark, sf_dir), KEYS)


@query
def calibration_tail(spark, sf_dir):
    train = _ready_split(spark, sf_dir).where("role = 'train'").drop("role")
    return fo.calibration_tail(train, KEYS).select(*KEYS, "week", "role")


def _ar1(spark, sf_dir):
    return li.ar1_holdout(ready_table(spark, sf_dir), KEYS)


def _ar1_test(spark, sf_dir):
    return _ar1(spark, sf_dir).where("role = 'test'").drop("role")


def _wf(spark, sf_dir):
    return li.ar1_walk_forward(ready_table(spark, sf_dir), KEYS)


@query
def ar1_holdout(spark, sf_dir):
    return _money(_ar1(spark, sf_dir), ["predicted"])


@query
def ar1_walk_forward(spark, sf_dir):
    return _money(_wf(spark, sf_dir), ["predicted"])


def _metrics_out(df):
    return df.withColumns({"mae": rnd("mae", 2), "rmse": rnd("rmse", 2), "mape": round_significant("mape")})


@query
def metrics(spark, sf_dir):
    return _metrics_out(ev.metrics(_ar1_test(spark, sf_dir), KEYS))


@query
def train_test_metrics(spark, sf_dir):
    return _metrics_out(ev.train_test_metrics(_ar1(spark, sf_dir), KEYS))


@query
def residuals(spark, sf_dir):
    return _money(ev.with_errors(_ar1_test(spark, sf_dir)).select(*KEYS, "week", "abs_error"),
                  ["abs_error"])


@query
def signed_error(spark, sf_dir):
    return _money(ev.with_errors(_ar1_test(spark, sf_dir)).select(*KEYS, "week", "error"),
                  ["error"])


def _q(test):
    return ev.conformal_quantile(ev.with_errors(test), KEYS)


@query
def conformal_quantile(spark, sf_dir):
    return _money(_q(_ar1_test(spark, sf_dir)), ["quantile"])


@query
def interval_constant(spark, sf_dir):
    test = _ar1_test(spark, sf_dir)
    out = ev.interval_constant(test, _q(test), KEYS)
    return _money(out.select(*KEYS, "week", "predicted", "lower_bound", "upper_bound"),
                  ["predicted", "lower_bound", "upper_bound"])


@query
def interval_horizon(spark, sf_dir):
    test = _ar1_test(spark, sf_dir)
    out = ev.interval_horizon(test, _q(test), KEYS)
    return _money(out.select(*KEYS, "week", "step", "lower_bound", "upper_bound"),
                  ["lower_bound", "upper_bound"])


@query
def interval_coverage(spark, sf_dir):
    test = _ar1_test(spark, sf_dir)
    return ev.coverage(ev.interval_constant(test, _q(test), KEYS), KEYS)


@query
def forecast_confidence(spark, sf_dir):
    test = _ar1_test(spark, sf_dir)
    return ev.forecast_confidence(test, _q(test), KEYS)


@query
def model_stability(spark, sf_dir):
    return ev.model_stability(_ar1_test(spark, sf_dir), KEYS)


@query
def drift_flag(spark, sf_dir):
    return ev.model_stability(_wf(spark, sf_dir), KEYS).select(*KEYS, "drift_detected")


@query
def health_summary(spark, sf_dir):
    wf = _wf(spark, sf_dir)
    out = ev.health_summary(wf, _q(wf), KEYS)
    return _money(out, ["forecast", "lower_bound", "upper_bound"])


@query
def rolling_rmse_band(spark, sf_dir):
    out = ev.rolling_rmse_band(_wf(spark, sf_dir), KEYS)
    return _money(out.select(*KEYS, "week", "rolling_rmse", "lower_bound", "upper_bound"),
                  ["rolling_rmse", "lower_bound", "upper_bound"])


@query
def walk_forward_summary(spark, sf_dir):
    return _metrics_out(ev.walk_forward_summary(_wf(spark, sf_dir), KEYS))


def _ses_train(spark, sf_dir):
    return _ready_split(spark, sf_dir).where("role = 'train'")


@query
def ses_forecast(spark, sf_dir):
    return li.ses_fit(_ses_train(spark, sf_dir), KEYS)


@query
def ses_holdout(spark, sf_dir):
    return li.ses_holdout(ready_table(spark, sf_dir), KEYS)


@query
def df_test(spark, sf_dir):
    out = li.df_test(ready_table(spark, sf_dir), KEYS)
    return out.withColumns({"gamma": rnd("gamma", 9), "t_stat": rnd("t_stat", 6)})


@query
def adf_test(spark, sf_dir):
    """T4 with one lagged difference"""
    out = li.adf_test(ready_table(spark, sf_dir), KEYS, lags=1)
    return out.withColumns({"gamma": rnd("gamma", 9), "t_stat": rnd("t_stat", 6)})


@query
def adf_auto(spark, sf_dir):
    """T4: lag count by AIC, p-value from the response surface"""
    out = ur.adf_auto(ready_table(spark, sf_dir), KEYS)
    return out.withColumns({"gamma": rnd("gamma", 9), "t_stat": rnd("t_stat", 6), "p_value": rnd("p_value", 6)})


@query
def ar_order_selection(spark, sf_dir):
    fit = li.ar_order_selection(ready_table(spark, sf_dir), KEYS)
    coef = {f: rnd(F.element_at("coef", i), digits)
            for i, (f, digits) in enumerate((("intercept", 2), ("phi_1", 9), ("phi_2", 9)), 1)}
    return fit.select(*KEYS, "d", "p", "n", rnd("aic", 6).alias("aic"), *[c.alias(f) for f, c in coef.items()])


@query
def ar_holdout(spark, sf_dir):
    """12 weeks forecast by the AR(p) chosen and fitted on the weeks before"""
    return _money(li.ar_holdout(ready_table(spark, sf_dir), KEYS), ["predicted"])


@query
def forecast_ar(spark, sf_dir):
    """26 weeks by the AR(p) of the whole history; interval from its holdout residuals"""
    ready = ready_table(spark, sf_dir)
    path = li.ar_forecast(ready, li.ar_order_selection(ready, KEYS), KEYS, HORIZON)
    q = ev.conformal_quantile(ev.with_errors(li.ar_holdout(ready, KEYS)), KEYS)
    return _money(fc.with_confidence(path, q, KEYS), _BOUNDS)


@query
def arima_order(spark, sf_dir):
    """rows only: T3 orders by stepwise search, coefficients and variance"""
    return ai.arima_fit(ready_table(spark, sf_dir), KEYS)


@query
def arima_holdout(spark, sf_dir):
    """rows only: T3, 12 weeks forecast by the ARIMA of the weeks before"""
    return ai.arima_holdout(ready_table(spark, sf_dir), KEYS)


@query
def forecast_arima(spark, sf_dir):
    """rows only: T3 / H9, 26 weeks by the ARIMA of the whole history"""
    return ai.arima_forecast(ai.arima_fit(ready_table(spark, sf_dir), KEYS), KEYS, HORIZON)


@query
def fourier_trend(spark, sf_dir):
    """T5: ridge trend + yearly Fourier terms, 12 weeks held out"""
    return _money(li.fourier_trend(ready_table(spark, sf_dir), KEYS), ["yhat"])


@query
def changepoint_trend(spark, sf_dir):
    """rows only: T5, trend with changepoints + yearly season, 12 weeks held out"""
    return tn.changepoint_holdout(ready_table(spark, sf_dir), KEYS)


@query
def forecast_changepoint(spark, sf_dir):
    """rows only: T5 / H9, 26 weeks by the trend with changepoints of the whole history"""
    return tn.changepoint_forecast(tn.changepoint_fit(ready_table(spark, sf_dir), KEYS), KEYS, HORIZON)


@query
def model_table(spark, sf_dir):
    """rows only: W8, smoothing, AR and Fourier models of every series as one table"""
    return mt.fit_table(ready_table(spark, sf_dir), KEYS)


@query
def forecast_model_table(spark, sf_dir):
    """26 weeks from the model table alone"""
    return _money(mt.forecast_table(mt.fit_table(ready_table(spark, sf_dir), KEYS), KEYS, HORIZON), ["predicted"])


@query
def model_leaderboard(spark, sf_dir):
    """rows only: holdout metrics of all models, apart by
    what they see: ``steps`` 12 forecasts the holdout unseen, 1 sees the week
    before. ``wape`` (sum of errors by sum of actuals, percent) bears weeks of
    no revenue, which blow up ``mape``."""
    ready = ready_table(spark, sf_dir)
    ft = (li.fourier_trend(ready, KEYS).where("role = 'test'")
          .select(*KEYS, F.col("ds").alias("week"), F.col("y").alias("actual"), F.col("yhat").alias("predicted")))
    ar1 = li.ar1_holdout(ready, KEYS).where("role = 'test'").drop("role")
    cp = (tn.changepoint_holdout(ready, KEYS).where("role = 'test'")
          .select(*KEYS, F.col("ds").alias("week"), F.col("y").alias("actual"), F.col("yhat").alias("predicted")))
    arima = ai.arima_holdout(ready, KEYS).select(*KEYS, "week", "actual", "predicted")
    trees = _tree(spark, sf_dir)[2].where("role = 'test'").drop("role")
    parts = [(ar1, "ar1", 1), (trees, "trees", 1), (li.ar_holdout(ready, KEYS), "ar", 12), (arima, "arima", 12),
             (li.ses_holdout(ready, KEYS), "ses", 12), (ft, "fourier_trend", 12), (cp, "changepoint_trend", 12)]
    allp = reduce(DataFrame.unionByName, [
        df.withColumns({"model": F.lit(name), "steps": F.lit(steps)}) for df, name, steps in parts])
    wape = 100 * F.sum(F.abs(F.col("actual") - F.col("predicted"))) / F.nullif(F.sum(F.abs("actual")), F.lit(0.0))
    by = KEYS + ["model", "steps"]
    out = allp.groupBy(*by).agg(*ev.metric_columns(), wape.alias("wape"))
    return _metrics_out(out).withColumn("wape", rnd("wape", 6))


# ---------------------------------------------------------------- forecasting, reporting

HORIZON = 26
MONTHS_AHEAD = 2


def _state(spark, sf_dir):
    return fc.forecast_state(ready_table(spark, sf_dir), KEYS)


@query
def next_week(spark, sf_dir):
    st = _state(spark, sf_dir)
    return st.select(*KEYS, F.col("week").alias("last_week"), fc.next_week(F.col("week")).alias("next_week"))


@query
def target_month(spark, sf_dir):
    st = _state(spark, sf_dir)
    t = fc.target_month(F.col("week"), MONTHS_AHEAD)
    return st.select(*KEYS, F.col("week").alias("last_week"), t.alias("target_date"),
                     F.month(t).alias("target_month"), F.year(t).alias("target_year"))


@query
def forecast_horizon(spark, sf_dir):
    st = _state(spark, sf_dir)
    t = fc.target_month(F.col("week"), MONTHS_AHEAD)
    return st.select(*KEYS, F.col("week").alias("last_week"),
                     fc.horizon_weeks(F.col("week"), weeks=HORIZON).alias("horizon_weeks"),
                     fc.horizon_weeks(F.col("week"), None, F.month(t), F.year(t)).alias("horizon_to_month"))


@query
def weighted_recent_avg(spark, sf_dir):
    from hebdo.functions.columns import weighted_recent_average
    st = _state(spark, sf_dir)
    return st.select(*KEYS, *[weighted_recent_average(F.col(f"h_{c}")).alias(c) for c in fc.BUSINESS])


@query
def safe_lag(spark, sf_dir):
    from hebdo.functions.columns import safe_lag_of_array
    st = _state(spark, sf_dir)
    return st.select(*KEYS, *[safe_lag_of_array(F.col(f"h_{fe.TARGET}"), k).alias(f"lag_{k}")
                              for k in fc.REVENUE_LAGS])


@query
def next_week_features(spark, sf_dir):
    return _present(fc.next_week_features(_state(spark, sf_dir), KEYS), KEYS + ["week"] + fe.FEATURES)


def _ses_forecast(spark, sf_dir):
    ready = ready_table(spark, sf_dir)
    fit = li.ses_fit(ready, KEYS)
    hold = li.ses_holdout(ready, KEYS)
    q = ev.conformal_quantile(ev.with_errors(hold), KEYS)
    return ready, fc.with_confidence(fc.flat_forecast(fit, KEYS, HORIZON), q, KEYS)


_BOUNDS = ["predicted", "lower_bound", "upper_bound", "best_case", "worst_case"]


@query
def forecast_ses(spark, sf_dir):
    return _money(_ses_forecast(spark, sf_dir)[1], _BOUNDS)


@query
def forecast_summary(spark, sf_dir):
    out = fc.forecast_summary(_ses_forecast(spark, sf_dir)[1], KEYS)
    return _money(out, ["final_value", "final_lower", "final_upper"])


@query
def growth(spark, sf_dir):
    ready, f = _ses_forecast(spark, sf_dir)
    return _money(rp.growth(ready, f, KEYS), ["current", "future", "growth_pct"], 6)


@query
def chart_series(spark, sf_dir):
    ready, f = _ses_forecast(spark, sf_dir)
    return _money(rp.chart_series(ready, f, KEYS), ["value", "lower_bound", "upper_bound"])


@query
def display_table(spark, sf_dir):
    return rp.display_table(_ses_forecast(spark, sf_dir)[1], KEYS)


@query
def kpi_row(spark, sf_dir):
    ready, f = _ses_forecast(spark, sf_dir)
    return rp.kpi_row(ready, f, KEYS)


# ---------------------------------------------------------------- trees (rows-only checks)

TUNING_DRAWS = 20
_MODELS: dict = {}


def _tree(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        ready = ready_table(spark, sf_dir).persist()
        _MODELS[key] = (ready,) + tr.holdout(ready, KEYS)
    return _MODELS[key]


@query
def tree_holdout(spark, sf_dir):
    """rows only: pooled boosted trees, last 12 weeks held out per series"""
    return _tree(spark, sf_dir)[2]


@query
def tree_metrics(spark, sf_dir):
    """rows only: train / test metrics of the pooled trees"""
    return ev.train_test_metrics(_tree(spark, sf_dir)[2], KEYS)


@query
def forecast_trees(spark, sf_dir):
    """rows only: recursive 26-week forecast with the pooled trees"""
    ready, model, pred = _tree(spark, sf_dir)
    q = ev.conformal_quantile(ev.with_errors(pred.where("role = 'test'")), KEYS)
    out = fc.recursive_forecast(model, fc.forecast_state(ready, KEYS), KEYS, HORIZON)
    return fc.with_confidence(out, q, KEYS, value=fe.TARGET)


@query
def feature_importance(spark, sf_dir):
    """rows only: top-20 split gains of the pooled trees"""
    return tr.feature_importance(spark, _tree(spark, sf_dir)[1])


@query
def tree_attributions(spark, sf_dir):
    """rows only: exact Shapley values of the pooled trees' holdout predictions"""
    ready, model, _ = _tree(spark, sf_dir)
    return tr.attributions(model, fo.holdout_split(ready, KEYS).where("role = 'test'"), KEYS)


@query
def calibration_residuals(spark, sf_dir):
    """rows only: P5, errors of the pooled trees on the last 20 training weeks"""
    return tr.calibration_residuals(ready_table(spark, sf_dir), KEYS)


@query
def permutation_importance(spark, sf_dir):
    """rows only: MAE increase per permuted feature on the holdout weeks"""
    ready, model, _ = _tree(spark, sf_dir)
    test = fo.holdout_split(ready, KEYS).where("role = 'test'").drop("role")
    return tr.permutation_importance(model, test, KEYS)


@query
def tuning_leaderboard(spark, sf_dir):
    """rows only: random search, 20 draws over five forward-only folds, run as listed"""
    return tr.tune(ready_table(spark, sf_dir), KEYS, n_iter=TUNING_DRAWS)


def _tree_walk(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir, "walk")
    if key not in _MODELS:
        _MODELS[key] = tr.walk_forward(ready_table(spark, sf_dir), KEYS, initial=104).persist()
    return _MODELS[key]


@query
def tree_walk_forward(spark, sf_dir):
    """rows only: pooled trees refitted at every origin from week 104"""
    return _tree_walk(spark, sf_dir)


@query
def tree_walk_forward_frame(spark, sf_dir):
    """keys, weeks and actuals of the trees' walk-forward, and that every origin has a prediction"""
    return _tree_walk(spark, sf_dir).select(*KEYS, "week", "actual", F.col("predicted").isNotNull().alias("has_prediction"))


@query
def tree_attribution_sums(spark, sf_dir):
    """that the attributions of every holdout prediction add up to it"""
    parts = tree_attributions(spark, sf_dir).groupBy(*KEYS, "week").agg(
        F.count("*").alias("features"), (F.sum("attribution") + F.max("base")).alias("total"))
    held = _tree(spark, sf_dir)[2].where("role = 'test'")
    gap = F.abs(F.col("total") - F.col("predicted"))
    return parts.join(held, [*KEYS, "week"]).select(*KEYS, "week", "features",
                                                    (gap <= 1e-9 * F.abs("predicted")).alias("adds_up"))


@query
def forecast_trees_frame(spark, sf_dir):
    """weeks and steps of the trees' forecast, and that its bounds enclose it and widen"""
    wide = F.col("upper_bound") - F.col("lower_bound")
    before = F.lag(wide).over(Window.partitionBy(*KEYS).orderBy("step"))
    inside = (F.col("lower_bound") <= F.col(fe.TARGET)) & (F.col(fe.TARGET) <= F.col("upper_bound"))
    return forecast_trees(spark, sf_dir).select(
        *KEYS, "week", F.col("step").cast("long").alias("step"), inside.alias("enclosed"),
        F.coalesce(wide > before, F.lit(True)).alias("widens"))


# ---------------------------------------------------------------- single global series (keys=[])
def _total_ready(spark, sf_dir):
    return fe.model_ready(Ledger(spark, sf_dir, keys=[]).weekly(), [])


@query
def weekly_metrics_total(spark, sf_dir):
    return Ledger(spark, sf_dir, keys=[]).weekly()


@query
def model_ready_total(spark, sf_dir):
    return _present(_total_ready(spark, sf_dir), ["week", fe.TARGET] + fe.FEATURES)


@query
def ar1_walk_forward_total(spark, sf_dir):
    return _money(li.ar1_walk_forward(_total_ready(spark, sf_dir), []), ["predicted"])


@query
def interval_prior(spark, sf_dir):
    """J7 calibrated on walk-forward residuals before the holdout weeks"""
    out = ev.calibrated_intervals(_ar1_test(spark, sf_dir), KEYS, "prior", pool=_wf(spark, sf_dir))
    return _money(out.select(*KEYS, "week", "predicted", "lower_bound", "upper_bound"),
                  ["predicted", "lower_bound", "upper_bound"])


# ---------------------------------------------------------------- 25 series keyed by nation
NATION = ["nation"]


@query
def weekly_metrics_by_nation(spark, sf_dir):
    return Ledger(spark, sf_dir, keys=NATION).weekly()


@query
def model_ready_by_nation(spark, sf_dir):
    ready = fe.model_ready(Ledger(spark, sf_dir, keys=NATION).weekly(), NATION)
    return _present(ready, NATION + ["week", fe.TARGET] + fe.FEATURES)


@query
def forecast_ar1(spark, sf_dir):
    """H8 closed form for AR(1): fit on the whole history, iterate 26 weeks
    from the last actual; interval from the AR(1) holdout residuals."""
    ready = ready_table(spark, sf_dir)
    coef = li.ar1_fit(ready, KEYS)
    last = ready.groupBy(*KEYS).agg(F.max("week").alias("last_week"),
                                    F.max_by(fe.TARGET, "week").alias("last_value"))
    path = fc.ar1_forecast(last.join(coef, KEYS), KEYS, HORIZON)
    q = ev.conformal_quantile(ev.with_errors(_ar1_test(spark, sf_dir)), KEYS)
    return _money(fc.with_confidence(path, q, KEYS), _BOUNDS)
