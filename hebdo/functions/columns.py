"""Column expressions shared by the operators.

All of these are built-in Spark SQL expressions (no Python at run time).
Means over a handful of lags are written out as explicit left-to-right
additions so that the arithmetic (and therefore the last bit of every
double) is the same on every partitioning.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def series_window(keys: list[str], order: str = "week") -> WindowSpec:
    """Per-series window ordered by week. ``keys=[]`` is one global series;
    only ever used on already-aggregated weekly tables."""
    return Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)


def week_start(c: str | Column) -> Column:
    """Monday 00:00 of the week containing ``c``, as DATE (A1)."""
    return F.date_trunc("week", col(c)).cast("date")


def cents(c: str | Column) -> Column:
    """Money as integer cents (round half up); sums of cents are exact and
    independent of partitioning and summation order."""
    return F.floor(col(c) * 100.0 + 0.5)


def from_cents(c: str | Column) -> Column:
    return col(c).cast("double") / 100


def round_half_up(c: str | Column, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d. From 2^52 at that scale a double has no
    further digits, so x itself is its rounding."""
    scale = float(10 ** digits)
    x = col(c)
    return (F.when(F.abs(x * scale) < float(2 ** 52), F.floor(x * scale + 0.5) / scale)
            .otherwise(x))


def round_significant(c: str | Column, digits: int = 10) -> Column:
    """Round half up to ``digits`` significant digits, whatever the size: for
    ratios whose denominator may be tiny."""
    x = col(c)
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - (digits - 1))
    return F.when(x == 0, x).otherwise(F.floor(x / p + 0.5) * p)


def safe_div(num: Column, den: Column) -> Column:
    """x / 0 -> NULL (ANSI mode would raise; pandas gives inf that is later
    dropped, so NULL keeps the same rows)."""
    return F.try_divide(num, den)


def mean_of(cols: list[Column]) -> Column:
    """(c1 + ... + ck) / k, added left to right."""
    return reduce(add, cols) / float(len(cols))


def sample_std_of(cols: list[Column]) -> Column:
    """Two-pass sample standard deviation (ddof=1) of k columns."""
    m = mean_of(cols)
    return F.sqrt(reduce(add, [(x - m) * (x - m) for x in cols]) / float(len(cols) - 1))


def ema_alpha(span: int) -> float:
    return 2.0 / (span + 1)


def ema_step(before: Column, x: Column, span: int) -> Column:
    """One step of the exponential average."""
    a = ema_alpha(span)
    return before * F.lit(1.0 - a) + x * F.lit(a)


def ema_of_array(arr: Column, span: int) -> Column:
    """Exponential average with adjust=False over an array, seeded with the
    first element: e1 = x1, e_t = e_{t-1}*(1-a) + x_t*a. NULL for []."""
    folded = F.aggregate(F.slice(arr, 2, F.size(arr) - 1), F.element_at(arr, 1), lambda acc, x: ema_step(acc, x, span))
    return F.when(F.size(arr) > 0, folded)


def weighted_recent_average(arr: Column, window: int = 8) -> Column:
    """Linearly weighted mean of the last ``window`` elements (weights 1..n,
    newest heaviest); 0.0 for an empty array (H4)."""
    tail = F.slice(arr, F.greatest(F.size(arr) - window + 1, F.lit(1)), window)
    n = F.size(tail)
    num = F.aggregate(
        F.zip_with(tail, F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                   lambda x, i: x * i.cast("double")),
        F.lit(0.0), lambda acc, v: acc + v)
    den = (n * (n + 1) / 2).cast("double")
    return F.when(n > 0, num / den).otherwise(F.lit(0.0))


def safe_lag_of_array(arr: Column, k: int) -> Column:
    """k-th last element, or the first one when the array is shorter (H5)."""
    return F.element_at(arr, -F.least(F.lit(k), F.size(arr)))


def month_angle(week: Column) -> Column:
    return F.lit(TWO_PI) * F.month(week) / 12.0


def isoweek_angle(week: Column) -> Column:
    return F.lit(TWO_PI) * F.weekofyear(week) / 52.0
