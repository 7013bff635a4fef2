"""Small DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach(df: DataFrame, per_series: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Add ``cols`` of a one-row-per-series table to ``df``.

    With series keys this is a left equi-join on them (AQE broadcasts the small
    side at run time when it is small), so a series without a row there (too
    short for a quantile or a fit) stays, with NULL in ``cols``. With
    ``keys=[]`` the per-series table has one row and the values come in as
    scalar subqueries, not a join.
    """
    if keys:
        return df.join(per_series.select(*keys, *cols), keys, "left")
    return df.withColumns({c: per_series.select(c).scalar() for c in cols})
