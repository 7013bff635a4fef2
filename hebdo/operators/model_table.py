"""Fitted per-series models as one typed table, and forecasts from it alone.

A row is a model of a series: its ``order``, its coefficients and the state a forecast
starts from, so nothing is fitted again and no history is read. ``version`` tells
which meaning of the columns a row follows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.frames import attach
from hebdo.operators import linear as li
from hebdo.operators.features import TARGET

VERSION = 1
COLUMNS = ["model", "version", "first_week", "last_week", "order", "coef", "state"]


def _none() -> Column:
    return F.array().cast("array<double>")


def _row(df: DataFrame, keys: list[str], model: str, order: Column, coef: Column, state: Column) -> DataFrame:
    return df.select(*keys, F.lit(model).alias("model"), F.lit(VERSION).alias("version"), "first_week", "last_week",
                     order.cast("array<int>").alias("order"), coef.cast("array<double>").alias("coef"),
                     state.cast("array<double>").alias("state"))


def _span(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min("week").alias("first_week"), F.max("week").alias("last_week"))


def ses_rows(df: DataFrame, keys: list[str], y: str = TARGET) -> DataFrame:
    """Smoothing: coefficient alpha, state the level."""
    fit = attach(li.ses_fit(df, keys, y).drop("last_week"), _span(df, keys), keys, ["first_week", "last_week"])
    return _row(fit, keys, "ses", F.array(), F.array("alpha"), F.array("level"))


def ar_rows(df: DataFrame, keys: list[str], y: str = TARGET, max_p: int = 2) -> DataFrame:
    """AR(p) of d-th differences: order (p, d), coefficients (c, phi...), state the last
    level and the last differences, newest first. NULL states (a gap among the last
    weeks) and series without a fit (NULL coefficients) stay and give NULL forecasts."""
    lagged = li._ar_lags(df.select(*keys, "week", y), keys, y, max_p - 1, 1)
    recent = F.array(*[F.array(F.col(f"z{d}"), *[F.col(f"z{d}_l{i}") for i in range(1, max_p)]) for d in (0, 1)])
    last = lagged.groupBy(*keys).agg(
        F.max_by(F.struct(F.col("z0").alias("level"), recent.alias("recent")), "week").alias("_s"),
        F.min("week").alias("first_week"), F.max("week").alias("last_week"))
    fits = attach(last, li.ar_order_selection(df, keys, y, max_p), keys, ["d", "p", "coef"])
    state = F.concat(F.array("_s.level"), F.slice(F.element_at("_s.recent", F.col("d") + 1), 1, F.col("p")))
    return _row(fits, keys, "ar", F.array("p", "d"), F.slice("coef", 1, F.col("p") + 1), state)


def fourier_rows(df: DataFrame, keys: list[str], y: str = TARGET, order: int = 3, ridge: float = 1.0) -> DataFrame:
    """Ridge trend and yearly season: order (pairs of terms), coefficients (level, slope a year,
    sine, cosine, ...) over weeks since the first one."""
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    t = F.datediff("week", "_first") / 7.0
    terms = {"one": F.lit(1.0), "trend": t / 52.0, **li.fourier_terms(t, order)}
    design = (df.select(*keys, "week", y).withColumn("_first", F.min("week").over(whole))
              .select(*keys, "week", y, *[c.alias(n) for n, c in terms.items()]))
    fit = li.solve_normal_equations(li.normal_equations(design, keys, list(terms), y), len(terms), ridge=ridge)
    fit = attach(fit, _span(df, keys), keys, ["first_week", "last_week"])
    return _row(fit, keys, "fourier", F.array(F.lit(order)), F.col("coef"), _none())


def fit_table(df: DataFrame, keys: list[str] | None = None, y: str = TARGET) -> DataFrame:
    """(keys, model, version, first_week, last_week, order, coef, state), one row per series and model."""
    keys = list(keys or [])
    return reduce(DataFrame.unionByName, [f(df, keys, y) for f in (ses_rows, ar_rows, fourier_rows)])


def _ar_path(horizon: int) -> Column:
    p, d = F.col("order")[0], F.col("order")[1]
    phi = F.slice("coef", 2, p)
    start = F.struct(F.slice("state", 2, p).alias("z"), F.col("state")[0].alias("level"), _none().alias("path"))

    def step(acc: Column, _: Column) -> Column:
        z = F.aggregate(F.zip_with(phi, acc["z"], lambda a, b: a * b), F.col("coef")[0], lambda s, v: s + v)
        level = F.when(d == 0, z).otherwise(acc["level"] + z)
        return F.struct(F.slice(F.concat(F.array(z), acc["z"]), 1, p).alias("z"), level.alias("level"),
                        F.concat(acc["path"], F.array(level)).alias("path"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda acc: acc["path"])


def _fourier_path(horizon: int) -> Column:
    def value(i: Column) -> Column:
        t = F.datediff("last_week", "first_week") / 7.0 + i
        season = F.transform(F.sequence(F.lit(1), F.col("order")[0]), lambda k: (
            F.get("coef", 2 * k) * F.sin(li.season_angle(k) * t) + F.get("coef", 2 * k + 1) * F.cos(li.season_angle(k) * t)))
        return F.aggregate(season, F.col("coef")[0] + F.col("coef")[1] * t / 52.0, lambda s, v: s + v)

    return F.transform(F.sequence(F.lit(1), F.lit(horizon)), value)


def forecast_table(table: DataFrame, keys: list[str] | None = None, horizon: int = 26) -> DataFrame:
    """(keys, model, week, step, predicted): ``horizon`` weeks on from each row's last week. Rows of
    another version, or of a model that this one does not know, raise nothing and give no rows."""
    keys = list(keys or [])
    flat = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda _: F.col("state")[0])
    path = (F.when(F.col("model") == "ses", flat).when(F.col("model") == "ar", _ar_path(horizon))
            .when(F.col("model") == "fourier", _fourier_path(horizon)))
    return (table.where(F.col("version") == VERSION).select(*keys, "model", "last_week", F.posexplode(path).alias("i", "predicted"))
            .select(*keys, "model", F.date_add("last_week", (F.col("i") + 1) * 7).alias("week"),
                    (F.col("i") + 1).cast("long").alias("step"), "predicted"))
