"""Recursive multi-step forecasting.

State is one row per series holding its history as arrays (revenue and the
14 business features, in week order; bounded by the calendar length). One
forecast step is a narrow ``select`` over that state - no shuffle - so all
series advance together. Closed-form models (SES, AR(1)) need no loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.functions.columns import (
    ema_of_array, isoweek_angle, month_angle, safe_div, safe_lag_of_array,
    weighted_recent_average,
)
from hebdo.functions.frames import attach
from hebdo.operators.boosting import BoostedTrees
from hebdo.operators.features import (
    CUSTOMER_FEATURES, EMA_SPANS, FEATURES, INVOICE_FEATURES, PAYMENT_FEATURES, TARGET,
)
from hebdo.session import checkpoint_dir

BUSINESS = CUSTOMER_FEATURES + INVOICE_FEATURES + PAYMENT_FEATURES
REVENUE_LAGS = (1, 2, 4, 8, 12, 26)
INTERVAL_CONFIDENCE = 95.0


# ------------------------------------------------------------------ horizon
def target_month(last_week: Column, months: int) -> Column:
    """H2: the date ``months`` after the last week (month-end clipped)."""
    return F.add_months(last_week, months)


def horizon_weeks(last_week: Column, weeks: int | None = None,
                  target_month_col: Column | None = None,
                  target_year_col: Column | None = None) -> Column:
    """H1: ``weeks`` as given, or whole weeks from the last week to the end of
    the target month, at least 1."""
    if weeks is not None:
        return F.lit(int(weeks))
    end = F.last_day(F.make_date(target_year_col, target_month_col, F.lit(1)))
    return F.greatest(F.lit(1), F.floor(F.datediff(end, last_week) / 7).cast("int"))


def next_week(week: Column) -> Column:
    """H3."""
    return F.date_add(week, 7)


# ------------------------------------------------------------------ state
def forecast_state(ready: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per series: last week, revenue history and business-feature
    histories as week-ordered arrays."""
    keys = list(keys or [])
    cols = [TARGET] + BUSINESS
    hist = (ready.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("week", *cols))).alias("_h"),
                 F.max("week").alias("week")))
    def field(name):
        return lambda s: s[name]
    return hist.select(*keys, "week",
                       *[F.transform("_h", field(c)).alias(f"h_{c}") for c in cols])


def _tail(arr: Column, k: int) -> Column:
    return F.slice(arr, F.greatest(F.size(arr) - k + 1, F.lit(1)), k)


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def tail_mean(arr: Column, k: int) -> Column:
    t = _tail(arr, k)
    return F.when(F.size(t) > 0, _sum(t) / F.size(t))


def tail_std(arr: Column, k: int) -> Column:
    """Sample std of the last k values (NULL below two values)."""
    t = _tail(arr, k)
    m = _sum(t) / F.size(t)
    ss = F.aggregate(t, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
    return F.when(F.size(t) > 1, F.sqrt(ss / (F.size(t) - 1)))


def step_features(ys: Column, week: Column) -> dict[str, Column]:
    """H6 + H7: the 38 features of the week after the history ends.
    Revenue features come from the revenue history (which already ends at
    t-1); business features are linearly weighted means of their own recent
    values; calendar features use the new week."""
    f: dict[str, Column] = {}
    for k in REVENUE_LAGS:
        f[f"lag_{k}"] = safe_lag_of_array(ys, k)
    for k in (4, 8, 12):
        f[f"rolling_mean_{k}"] = tail_mean(ys, k)
        f[f"rolling_std_{k}"] = tail_std(ys, k)
    for name, span in EMA_SPANS.items():
        f[name] = ema_of_array(ys, span)
    f["revenue_vs_4w_avg"] = safe_div(f["lag_1"], f["rolling_mean_4"])
    f["revenue_vs_8w_avg"] = safe_div(f["lag_1"], f["rolling_mean_8"])
    f["revenue_growth_4w"] = safe_div(f["lag_1"], f["lag_4"]) - 1
    f["revenue_acceleration"] = f["lag_1"] - f["lag_2"]
    f["revenue_deviation"] = f["lag_1"] - f["rolling_mean_12"]
    f["rolling_cv_4"] = safe_div(f["rolling_std_4"], f["rolling_mean_4"])
    for c in BUSINESS:
        f[c] = weighted_recent_average(F.col(f"h_{c}"))
    m, k = month_angle(week), isoweek_angle(week)
    f.update(month_sin=F.sin(m), month_cos=F.cos(m), week_sin=F.sin(k), week_cos=F.cos(k))
    return f


def next_week_features(state: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, week = next week, 38 features) for every series."""
    keys = list(keys or [])
    nw = next_week(F.col("week"))
    f = step_features(F.col(f"h_{TARGET}"), nw)
    return state.select(*keys, nw.alias("week"),
                        *[f[n].cast("double").alias(n) for n in FEATURES])


# ------------------------------------------------------------------ recursive loop
def recursive_forecast(model: BoostedTrees, state: DataFrame, keys: list[str] | None,
                       horizon: int, checkpoint_every: int = 8) -> DataFrame:
    """H8: features -> predict -> append, ``horizon`` times, all series at
    once. Step outputs accumulate in an array column of the state, so only
    the final state is materialised; the lineage is cut with a reliable
    checkpoint (``spark.checkpoint.dir``) every ``checkpoint_every`` steps."""
    keys = list(keys or [])
    checkpoint_dir(state.sparkSession)
    out_type = F.struct(F.lit(None).cast("date").alias("week"), F.lit(None).cast("int").alias("step"),
                        F.lit(None).cast("double").alias(TARGET),
                        *[F.lit(None).cast("double").alias(n) for n in FEATURES])
    st = (state.withColumn("_out", F.filter(F.array(out_type), lambda x: F.lit(False)))
          .withColumn("_step", F.lit(0)))
    hist_cols = [f"h_{c}" for c in [TARGET] + BUSINESS]
    # Column expressions are built once and reused by every step; only the
    # DataFrame they apply to changes.
    nw = next_week(F.col("week"))
    f = step_features(F.col(f"h_{TARGET}"), nw)
    feature_cols = [nw.alias("_nw"), (F.col("_step") + 1).alias("_next_step"),
                    *[f[n].cast("double").alias(n) for n in FEATURES]]
    row = F.struct(F.col("_nw").alias("week"), F.col("_next_step").alias("step"),
                   F.col("predicted").cast("double").alias(TARGET),
                   *[F.col(n) for n in FEATURES])
    new_hist = {f"h_{TARGET}": F.concat(F.col(f"h_{TARGET}"),
                                        F.array(F.col("predicted").cast("double")))}
    for c in BUSINESS:
        new_hist[f"h_{c}"] = F.concat(F.col(f"h_{c}"), F.array(F.col(c)))
    next_state = [*keys, F.col("_nw").alias("week"), *[new_hist[h].alias(h) for h in hist_cols],
                  F.concat("_out", F.array(row)).alias("_out"), F.col("_next_step").alias("_step")]
    for step in range(1, horizon + 1):
        scored = model.transform(st.select("*", *feature_cols))
        st = scored.select(*next_state)
        if step % checkpoint_every == 0 and step < horizon:
            st = st.checkpoint()
    return st.select(*keys, F.explode("_out").alias("o")).select(*keys, "o.*")


# ------------------------------------------------------------------ closed forms
def flat_forecast(fit: DataFrame, keys: list[str] | None, horizon: int,
                  level: str = "level", last_week: str = "last_week") -> DataFrame:
    """SES forecast: the final level for steps 1..horizon."""
    keys = list(keys or [])
    return (fit.select(*keys, last_week, level,
                       F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
            .select(*keys, F.date_add(last_week, F.col("step") * 7).alias("week"),
                    F.col("step").cast("long").alias("step"), F.col(level).alias("predicted")))


def ar1_forecast(coef: DataFrame, keys: list[str] | None, horizon: int) -> DataFrame:
    """AR(1) iterated forward from the last actual: y_{t+1} = a + b * y_t.
    ``coef`` needs (keys, last_week, last_value, slope, intercept)."""
    keys = list(keys or [])
    steps = coef.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    value = F.aggregate(F.sequence(F.lit(1), F.col("step")), F.col("last_value"),
                        lambda acc, _: F.col("intercept") + F.col("slope") * acc)
    return steps.select(*keys, F.date_add("last_week", F.col("step") * 7).alias("week"),
                        F.col("step").cast("long").alias("step"), value.alias("predicted"))


# ------------------------------------------------------------------ intervals and summary
def with_confidence(forecast: DataFrame, q: DataFrame, keys: list[str] | None = None,
                    value: str = "predicted") -> DataFrame:
    """H9: value +- q * sqrt(step); confidence 95; best = upper, worst = lower."""
    keys = list(keys or [])
    j = attach(forecast, q, keys, ["quantile"])
    width = F.col("quantile") * F.sqrt(F.col("step").cast("double"))
    return (j.withColumn("lower_bound", F.col(value) - width)
            .withColumn("upper_bound", F.col(value) + width)
            .withColumn("confidence", F.lit(INTERVAL_CONFIDENCE))
            .withColumn("best_case", F.col("upper_bound"))
            .withColumn("worst_case", F.col("lower_bound"))
            .drop("quantile"))


def forecast_summary(forecast: DataFrame, keys: list[str] | None = None,
                     value: str = "predicted") -> DataFrame:
    """Weeks, first/last week, final value and its bounds."""
    keys = list(keys or [])
    return forecast.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("weeks"), F.min("week").alias("start_week"),
        F.max("week").alias("end_week"),
        F.max_by(value, "week").alias("final_value"),
        F.max_by("lower_bound", "week").alias("final_lower"),
        F.max_by("upper_bound", "week").alias("final_upper"))


def run_forecast(ready: DataFrame, model: BoostedTrees, residuals: DataFrame,
                 keys: list[str] | None = None, forecast_type: str = "weeks",
                 weeks: int = 26, months_ahead: int | None = None,
                 month: int | None = None, year: int | None = None) -> DataFrame:
    """End-to-end forecast. ``forecast_type='weeks'`` forecasts
    ``weeks`` steps; ``'months'`` forecasts up to the end of the given
    ``month`` and ``year``, or of the month that lies ``months_ahead``
    (default 1, 0 = the current one) months after each series' last week
    (H2 + H1).
    ``residuals`` (keys, abs_error) calibrate the interval (J6, H9)."""
    from hebdo.operators.evaluate import conformal_quantile
    keys = list(keys or [])
    state = forecast_state(ready, keys)
    if forecast_type == "weeks":
        state = state.withColumn("_h", horizon_weeks(F.col("week"), weeks=weeks))
    else:
        if month is not None and year is not None:
            to = F.lit(int(month)), F.lit(int(year))
        else:
            t = target_month(F.col("week"), 1 if months_ahead is None else int(months_ahead))
            to = F.month(t), F.year(t)
        state = state.withColumn("_h", horizon_weeks(F.col("week"), None, *to))
    longest = state.agg(F.max("_h")).first()[0]
    out = recursive_forecast(model, state, keys, int(longest))
    out = attach(out, state, keys, ["_h"]).where(F.col("step") <= F.col("_h")).drop("_h")
    q = conformal_quantile(residuals, keys)
    return with_confidence(out, q, keys, value=TARGET)
