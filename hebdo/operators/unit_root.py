"""Augmented Dickey-Fuller test with automatic lag and p-value (T4), in built-in expressions.

The moments of the target, the lagged level and all lagged differences are one
grouped aggregate; sweeping its matrix one regressor at a time passes through the
nested regressions of every lag count, so all lags are scored by one fold.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.functions.columns import safe_div, series_window
from hebdo.functions.frames import attach
from hebdo.operators.features import TARGET
from hebdo.operators.linear import NOISE, calendar_lag

# MacKinnon's response surface for the test with a constant, one series (fixed
# values): the statistic lies between TAU_MIN and TAU_MAX, the normal quantile of the
# p-value is a polynomial in it, another one on either side of TAU_STAR.
TAU_MIN, TAU_MAX, TAU_STAR = -18.83, 2.74, -1.61
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
# The normal distribution function by rational approximation (Hart; fixed values),
# numerator and denominator, highest power first.
NORMAL_TOP = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
              221.213596169931, 220.206867912376)
NORMAL_LOW = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
              637.333633378831, 793.826512519948, 440.413735824752)


def _horner(z: Column, highest_first: tuple[float, ...]) -> Column:
    return reduce(lambda acc, c: acc * z + c, highest_first[1:], F.lit(highest_first[0]))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` standing once in the expression, however often it is used."""
    return F.transform(F.array(value), use)[0]


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, to about 1e-15."""

    def upper(a: Column) -> Column:
        tail = F.exp(-a * a / 2)
        deep = F.lit(2.506628274631) * (a + F.lit(1.0) / (a + F.lit(2.0) / (a + F.lit(3.0) / (a + F.lit(4.0) / (a + 0.65)))))
        return F.when(a < 7.07106781186547, tail * _horner(a, NORMAL_TOP) / _horner(a, NORMAL_LOW)).otherwise(tail / deep)

    return _let(z, lambda v: _let(_let(F.abs(v), upper), lambda u: F.when(v > 0, 1 - u).otherwise(u)))


def mackinnon_p(t: Column) -> Column:
    """p-value of a Dickey-Fuller statistic (constant, no trend)."""
    return _let(t, lambda v: (
        F.when(v > TAU_MAX, F.lit(1.0)).when(v < TAU_MIN, F.lit(0.0))
        .otherwise(normal_cdf(F.when(v <= TAU_STAR, _horner(v, TAU_SMALL[::-1])).otherwise(_horner(v, TAU_LARGE[::-1]))))))


def sweep(m: Column, k: Column, scale: Column) -> Column:
    """Sweep the symmetric matrix ``m`` (array of arrays) on its ``k``-th variable (from 0). One
    that is, within rounding of its own ``scale``, a combination of those before stays out."""
    pivot = m[k][k]
    swept = F.transform(m, lambda row, i: F.transform(row, lambda v, j: (
        F.when((i == k) & (j == k), 1 / pivot)
        .when(i == k, v / pivot)
        .when(j == k, -v / pivot)
        .otherwise(v - row[k] * m[k][j] / pivot))))
    return F.when(pivot > NOISE * scale[k], swept).otherwise(m)


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows(keys, _v), the variables as an array -> (keys, n, m): covariance matrix times n, as an
    array of arrays. One row per pair of variables goes into a partial aggregate, so the
    plan does not grow with the square of the lags."""
    long = (rows.select(*keys, "_v", F.posexplode("_v").alias("i", "x"))
            .select(*keys, "i", "x", F.posexplode("_v").alias("j", "y")).where("j >= i"))
    cells = long.groupBy(*keys, "i", "j").agg(F.covar_pop("x", "y").alias("c"), F.count(F.lit(1)).alias("n"))
    here, across = F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))
    mirrored = F.explode(F.when(F.col("i") == F.col("j"), F.array(here)).otherwise(F.array(here, across)))
    both = cells.select(*keys, "c", "n", mirrored.alias("_p")).select(*keys, "_p.i", "_p.j", "c", "n")
    lines = both.groupBy(*keys, "i").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("j", "c"))).alias("r"))
    return (lines.groupBy(*keys).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "r"))).alias("m"))
            .select(*keys, "n", F.transform("m", lambda line: F.transform(
                line["r"], lambda cell: cell["c"] * F.col("n"))).alias("m")))


def longest_lag(n: Column) -> Column:
    """Schwert's rule, as far as the weeks allow."""
    rule = F.ceil(12.0 * F.pow(n / 100.0, F.lit(0.25)))
    return F.greatest(F.least(rule, F.floor(n / 2) - 2), F.lit(0)).cast("int")


def adf_auto(df: DataFrame, keys: list[str] | None = None, y: str = TARGET, most: int | None = None) -> DataFrame:
    """(keys, lags, n, gamma, t_stat, p_value, stationary): the test regression
    dy_t = a + gamma y_{t-1} + sum_i delta_i dy_{t-i} with the lag count of the
    lowest AIC (smallest of several), searched up to Schwert's rule on the weeks that
    have all lags, then fitted on all weeks that have its own.

    ``most`` bounds the lags of all series; without it, it follows from the longest one.
    Lags over a missing week are unknown. Without more weeks than coefficients, or
    without residuals, statistic and p-value are NULL; a series without a complete
    week has no row."""
    keys = list(keys or [])
    w = series_window(keys)
    d = df.select(*keys, "week", (F.col(y) - calendar_lag(y, 1, w)).alias("dy"), calendar_lag(y, 1, w).alias("ylag"),
                  F.col(y).alias("_y"))
    length = d.groupBy(*keys).agg(longest_lag(F.count("_y").cast("double")).alias("most"))
    if most is None:
        most = length.agg(F.max("most")).first()[0] or 0
    lagged = [calendar_lag("dy", i, w) for i in range(1, most + 1)]
    d = d.select(*keys, "dy", "ylag", (F.array(*lagged) if lagged else F.array().cast("array<double>")).alias("lagged"))
    d = d.where("dy is not null")

    def regression(lags: DataFrame, column: str) -> DataFrame:
        """Moments over the weeks that have ``column`` lags; lags beyond are constant."""
        j = attach(d, lags, keys, [column])
        known = F.forall(F.slice("lagged", 1, F.col(column)), lambda v: v.isNotNull())
        values = F.transform("lagged", lambda v, i: F.when(i < F.col(column), v).otherwise(F.lit(0.0)))
        out = _moments(j.where(known).select(*keys, F.concat(F.array("ylag"), values, F.array("dy")).alias("_v")), keys)
        return attach(out, lags, keys, [column]).withColumn("scale", F.transform("m", lambda row, i: row[i]))

    last = most + 1                                  # place of the target
    first = regression(length, "most").withColumn("m", sweep(F.col("m"), F.lit(0), F.col("scale")))
    total = F.element_at("scale", last + 1)

    def aic(m: Column, lags: Column) -> Column:
        rss = F.greatest(m[last][last], NOISE * total, F.lit(1e-300))
        return F.col("n") * F.log(rss / F.col("n")) + 2 * (lags + 2)

    start = F.struct(F.col("m").alias("m"), F.lit(0).alias("lags"), aic(F.col("m"), F.lit(0)).alias("aic"))

    def longer(acc: Column, k: Column) -> Column:
        def judged(m: Column, score: Column) -> Column:
            better = (score < acc["aic"]) & (F.col("n") > k + 2)
            return F.struct(m.alias("m"), F.when(better, k).otherwise(acc["lags"]).alias("lags"),
                            F.when(better, score).otherwise(acc["aic"]).alias("aic"))

        return _let(sweep(acc["m"], k, F.col("scale")), lambda m: _let(aic(m, k), lambda score: judged(m, score)))

    steps = F.when(F.col("most") > 0, F.sequence(F.lit(1), F.greatest("most", F.lit(1)))).otherwise(F.array().cast("array<int>"))
    chosen = first.select(*keys, F.aggregate(steps, start, longer, lambda acc: acc["lags"]).alias("lags"))
    again = regression(chosen, "lags")
    done = F.aggregate(F.sequence(F.lit(0), F.col("lags")), F.col("m"), lambda m, k: sweep(m, k, F.col("scale")))
    free = F.col("n") - F.col("lags") - 2
    fitted = again.withColumn("m", done).select(
        *keys, "lags", "n", F.when(free > 0, F.element_at(F.element_at("m", 1), last + 1)).alias("gamma"),
        F.element_at(F.element_at("m", last + 1), last + 1).alias("rss"), F.element_at(F.element_at("m", 1), 1).alias("inv"),
        total.alias("tss"), free.alias("free"))
    t = F.when((F.col("free") > 0) & (F.col("rss") > NOISE * F.col("tss")) & (F.col("inv") > 0),
               safe_div(F.col("gamma"), F.sqrt(F.col("rss") / F.col("free") * F.col("inv"))))
    p = _let(t, lambda v: F.struct(v.alias("t"), F.when(v.isNotNull(), mackinnon_p(v)).alias("p")))
    return fitted.withColumn("_p", p).select(
        *keys, F.col("lags").cast("long").alias("lags"), "n", "gamma", F.col("_p.t").alias("t_stat"),
        F.col("_p.p").alias("p_value"), (F.col("_p.p") < 0.05).alias("stationary"))
