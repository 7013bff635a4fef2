"""Splits and forward-only folds.

Row positions come from ``row_number`` over the per-series week window, so
folds are computed for every series at once with one shuffle by series key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.columns import series_window


def with_position(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Add ``idx`` (0-based week position) and ``n`` (series length)."""
    keys = list(keys or [])
    w = series_window(keys)
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return df.select("*", (F.row_number().over(w) - 1).cast("long").alias("idx"),
                     F.count(F.lit(1)).over(whole).alias("n"))


def holdout_split(df: DataFrame, keys: list[str] | None = None, h: int = 12) -> DataFrame:
    """``role`` = 'test' for the last ``h`` weeks of each series, else 'train'."""
    keys = list(keys or [])
    from_end = F.row_number().over(
        (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(F.desc("week")))
    return df.withColumn("role", F.when(from_end <= h, "test").otherwise("train"))


def expanding_folds(train: DataFrame, keys: list[str] | None = None,
                    n_splits: int = 5) -> DataFrame:
    """Forward-only expanding folds, test size n // (n_splits + 1) per
    series; fold f tests rows [s_f, s_f + size) and trains on [0, s_f) with
    s_f = n - (n_splits - f) * size. Returns (keys, week, fold, role)."""
    keys = list(keys or [])
    pos = with_position(train.select(*keys, "week"), keys)
    size = (F.col("n") / (n_splits + 1)).cast("long")
    start = F.col("n") - (F.lit(n_splits) - F.col("fold")) * size
    role = (F.when(F.col("idx") < start, "train")
            .when(F.col("idx") < start + size, "test"))
    return (pos.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"))
            .select(*keys, "week", F.col("fold").cast("long").alias("fold"), role.alias("role"))
            .where(F.col("role").isNotNull()))


def walk_forward_origins(df: DataFrame, keys: list[str] | None = None,
                         initial: int = 104) -> DataFrame:
    """Every week at position >= ``initial`` is a one-step origin whose
    training set is all earlier weeks (``train_size`` = position)."""
    keys = list(keys or [])
    return (with_position(df.select(*keys, "week"), keys)
            .where(F.col("idx") >= initial)
            .select(*keys, "week", F.col("idx").alias("train_size")))


def calibration_tail(train: DataFrame, keys: list[str] | None = None, size: int = 20) -> DataFrame:
    """P5: ``role`` = 'calibration' for the last ``size`` training weeks,
    else 'fit'."""
    keys = list(keys or [])
    from_end = F.row_number().over(
        (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(F.desc("week")))
    return train.withColumn("role", F.when(from_end <= size, "calibration").otherwise("fit"))
