"""Reporting tables behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.functions.frames import attach
from hebdo.operators.features import TARGET

CONFIDENCE_LABEL = "95%"


def growth(history: DataFrame, forecast: DataFrame, keys: list[str] | None = None,
           value: str = "predicted") -> DataFrame:
    """Last actual, last forecast and growth in percent per series."""
    keys = list(keys or [])
    cur = history.groupBy(*keys).agg(F.max_by(TARGET, "week").alias("current"))
    fut = forecast.groupBy(*keys).agg(F.max_by(value, "week").alias("future"))
    j = attach(cur, fut, keys, ["future"])
    return j.withColumn("growth_pct",
                        F.try_divide(F.col("future") - F.col("current"), F.col("current")) * 100)


def chart_series(history: DataFrame, forecast: DataFrame, keys: list[str] | None = None,
                 value: str = "predicted") -> DataFrame:
    """History rows, the last history row repeated as the first forecast
    point (null bounds), then the forecast rows with bounds."""
    keys = list(keys or [])
    hist = history.select(*keys, "week", F.col(TARGET).alias("value"),
                          F.lit("history").alias("series"))
    last = (history.groupBy(*keys)
            .agg(F.max("week").alias("week"), F.max_by(TARGET, "week").alias("value"))
            .withColumn("series", F.lit("forecast")))
    fc = forecast.select(*keys, "week", F.col(value).alias("value"), "lower_bound",
                         "upper_bound", F.lit("forecast").alias("series"))
    return (hist.unionByName(last, allowMissingColumns=True)
            .unionByName(fc, allowMissingColumns=True))


def money_label(c) -> F.Column:
    """'₹' + whole currency units with thousands separators (half-even)."""
    return F.concat(F.lit("₹"), F.format_number(F.bround(c, 0), 0))


def display_table(forecast: DataFrame, keys: list[str] | None = None,
                  value: str = "predicted") -> DataFrame:
    """D3: week as 'dd Mon yyyy' and the forecast as a currency label."""
    keys = list(keys or [])
    return forecast.select(*keys, "week",
                           F.date_format("week", "dd MMM yyyy").alias("week_label"),
                           money_label(F.col(value)).alias("revenue_label"))


def kpi_row(history: DataFrame, forecast: DataFrame, keys: list[str] | None = None,
            value: str = "predicted") -> DataFrame:
    """The four dashboard cards as labels."""
    keys = list(keys or [])
    g = growth(history, forecast, keys, value)
    return g.select(*keys, money_label(F.col("current")).alias("current_label"),
                    money_label(F.col("future")).alias("forecast_label"),
                    F.when(F.col("growth_pct").isNotNull(),
                           F.concat(F.format_string("%.2f", F.col("growth_pct")), F.lit("%")))
                    .alias("growth_label"),
                    F.lit(CONFIDENCE_LABEL).alias("confidence_label"))
