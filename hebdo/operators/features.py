"""The 38 leak-free features (section 2.6) and the model-ready table.

All features of a series are computed in one ``select`` over a single
per-series window ordered by week, so Catalyst plans one shuffle by series
key, one sort and one Window node. Every feature at week t uses only rows
before t, except the four calendar ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.functions.columns import (
    ema_step, isoweek_angle, mean_of, month_angle, safe_div, sample_std_of, series_window,
)

TARGET = "weekly_revenue"

REVENUE_FEATURES = [
    "lag_1", "lag_2", "lag_4", "lag_8", "lag_12", "lag_26",
    "rolling_mean_4", "rolling_std_4", "rolling_mean_8", "rolling_std_8",
    "rolling_mean_12", "rolling_std_12", "ema_4", "ema_12",
    "revenue_vs_4w_avg", "revenue_vs_8w_avg", "revenue_growth_4w",
    "revenue_acceleration", "revenue_deviation", "rolling_cv_4",
]
CUSTOMER_FEATURES = [
    "active_customers_lag_1", "customer_trend_4",
    "revenue_per_customer_lag_1", "new_customers_lag_1",
]
INVOICE_FEATURES = [
    "invoice_count_lag_1", "average_invoice_lag_1", "invoice_trend_4", "invoice_growth",
]
PAYMENT_FEATURES = [
    "payment_lag_1", "average_payment_lag_1", "payment_trend_4",
    "collection_rate_lag_1", "outstanding_lag_1", "payment_count_lag_1",
]
CALENDAR_FEATURES = ["month_sin", "month_cos", "week_sin", "week_cos"]
FEATURES = (REVENUE_FEATURES + CUSTOMER_FEATURES + INVOICE_FEATURES
            + PAYMENT_FEATURES + CALENDAR_FEATURES)
EMA_SPANS = {"ema_4": 4, "ema_12": 12}

# Raw same-week columns removed by F1 (they would leak the target week).
RAW_COLUMNS = [
    "active_customers", "invoice_count", "average_invoice", "weekly_payments",
    "average_payment", "payment_count", "new_customers",
]


# Lags each feature group needs, materialised once by the Window node.
LAGS = {
    TARGET: (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 26),
    "active_customers": (1, 2, 3, 4),
    "invoice_count": (1, 2, 3, 4),
    "weekly_payments": (1, 2, 3, 4),
    "new_customers": (1,),
    "average_invoice": (1,),
    "average_payment": (1,),
    "payment_count": (1,),
}


def L(c: str, k: int) -> Column:
    """Reference to the materialised lag column of ``c`` (see ``with_lags``)."""
    return F.col(f"_{c}_lag{k}")


def lag_list(c: str, k: int) -> list[Column]:
    return [L(c, i) for i in range(1, k + 1)]


def with_averages(weekly: DataFrame, keys: list[str], y: str = TARGET) -> DataFrame:
    """Add ``_ema_*``: the exponential averages of the weeks before, by one fold over
    each series that notes the averages as it passes a week. The series is laid out
    again on its keys, so the lags' window needs no further shuffle."""
    rest = [c for c in weekly.columns if c not in (*keys, "week")]
    series = weekly.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("week", *rest))).alias("_rows"))
    kind = ", ".join(f"_{n}: double" for n in EMA_SPANS)
    empty = F.array().cast(f"array<struct<{kind}>>")
    now = [F.lit(None).cast("double").alias(f"_{n}") for n in EMA_SPANS]

    def step(acc: Column, row: Column) -> Column:
        x, at = row[y].cast("double"), acc["now"]
        after = [F.when(x.isNull(), at[f"_{n}"]).otherwise(F.coalesce(ema_step(at[f"_{n}"], x, s), x)).alias(f"_{n}")
                 for n, s in EMA_SPANS.items()]
        return F.struct(F.concat(acc["path"], F.array(at)).alias("path"), F.struct(*after).alias("now"))

    path = F.aggregate("_rows", F.struct(empty.alias("path"), F.struct(*now).alias("now")), step, lambda acc: acc["path"])
    rows = series.select(*keys, F.explode(F.arrays_zip(F.col("_rows"), path.alias("_path"))).alias("_r"))
    return rows.select(*[F.col(c) if c in keys else F.col(f"_r._rows.{c}") for c in weekly.columns],
                       *[F.col(f"_r._path._{n}") for n in EMA_SPANS])


def with_lags(weekly: DataFrame, keys: list[str]) -> DataFrame:
    """One Window node: every lag in ``LAGS``."""
    w = series_window(keys)
    cols = [F.lag(c, k).over(w).alias(f"_{c}_lag{k}") for c, ks in LAGS.items() for k in ks]
    return weekly.select("*", *cols)


def revenue_features(y: str = TARGET) -> dict[str, Column]:
    f: dict[str, Column] = {}
    for k in (1, 2, 4, 8, 12, 26):
        f[f"lag_{k}"] = L(y, k)
    for k in (4, 8, 12):
        f[f"rolling_mean_{k}"] = mean_of(lag_list(y, k))
        f[f"rolling_std_{k}"] = sample_std_of(lag_list(y, k))
    for name in EMA_SPANS:
        f[name] = F.col(f"_{name}")
    f["revenue_vs_4w_avg"] = safe_div(f["lag_1"], f["rolling_mean_4"])
    f["revenue_vs_8w_avg"] = safe_div(f["lag_1"], f["rolling_mean_8"])
    f["revenue_growth_4w"] = safe_div(f["lag_1"], f["lag_4"]) - 1
    f["revenue_acceleration"] = f["lag_1"] - f["lag_2"]
    f["revenue_deviation"] = f["lag_1"] - f["rolling_mean_12"]
    f["rolling_cv_4"] = safe_div(f["rolling_std_4"], f["rolling_mean_4"])
    return f


def customer_features(y: str = TARGET) -> dict[str, Column]:
    return {
        "active_customers_lag_1": L("active_customers", 1),
        "customer_trend_4": mean_of(lag_list("active_customers", 4)),
        "revenue_per_customer_lag_1": safe_div(L(y, 1), L("active_customers", 1)),
        "new_customers_lag_1": L("new_customers", 1),
    }


def invoice_features() -> dict[str, Column]:
    return {
        "invoice_count_lag_1": L("invoice_count", 1),
        "average_invoice_lag_1": L("average_invoice", 1),
        "invoice_trend_4": mean_of(lag_list("invoice_count", 4)),
        "invoice_growth": safe_div(L("invoice_count", 1), L("invoice_count", 4)) - 1,
    }


def payment_features(y: str = TARGET) -> dict[str, Column]:
    return {
        "payment_lag_1": L("weekly_payments", 1),
        "average_payment_lag_1": L("average_payment", 1),
        "payment_trend_4": mean_of(lag_list("weekly_payments", 4)),
        "collection_rate_lag_1": safe_div(L("weekly_payments", 1), L(y, 1)),
        "outstanding_lag_1": L(y, 1) - L("weekly_payments", 1),
        "payment_count_lag_1": L("payment_count", 1),
    }


def calendar_features(week: str = "week") -> dict[str, Column]:
    m, k = month_angle(F.col(week)), isoweek_angle(F.col(week))
    return {"month_sin": F.sin(m), "month_cos": F.cos(m),
            "week_sin": F.sin(k), "week_cos": F.cos(k)}


def feature_columns() -> dict[str, Column]:
    """All 38 features as expressions over the columns ``with_lags`` adds."""
    out: dict[str, Column] = {}
    out.update(revenue_features())
    out.update(customer_features())
    out.update(invoice_features())
    out.update(payment_features())
    out.update(calendar_features())
    return out


def add_features(weekly: DataFrame, keys: list[str] | None = None,
                 names: list[str] | None = None) -> DataFrame:
    """weekly metrics + the requested (default: all 38) features as DOUBLE."""
    keys = list(keys or [])
    cols = feature_columns()
    names = names or FEATURES
    averaged = with_averages(weekly, keys) if set(names) & set(EMA_SPANS) else weekly
    staged = with_lags(averaged, keys)
    return staged.select(*weekly.columns, *[cols[n].cast("double").alias(n) for n in names])


def clean(features: DataFrame) -> DataFrame:
    """F1 + F2: drop the raw same-week columns, then every incomplete row
    (x/0 already became NULL, so +-inf rows go too)."""
    return features.drop(*RAW_COLUMNS).na.drop()


def model_ready(weekly: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = list(keys or [])
    return clean(add_features(weekly, keys)).select(*keys, "week", TARGET, *FEATURES)


def feature_summary(ready: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """rows, columns, features, target mean / sample std, week range."""
    keys = list(keys or [])
    n_cols = len([c for c in ready.columns if c not in keys])
    return ready.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(n_cols).cast("long").alias("columns"),
        F.lit(len(FEATURES)).cast("long").alias("features"),
        F.avg(TARGET).alias("mean_revenue"),
        F.stddev_samp(TARGET).alias("std_revenue"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
    )
