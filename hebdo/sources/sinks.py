"""Sinks (W1-W10). Weekly-grain tables are small; they are written sorted by
series and week through a range-partitioned sort, which also scales."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.operators.boosting import BoostedTrees


def _sorted(df: DataFrame, keys: list[str], order: str = "week") -> DataFrame:
    return df.orderBy(*keys, order)


def write_weekly(df: DataFrame, path: str, keys: list[str] | None = None, fmt: str = "parquet") -> None:
    """W1 (and W2 for the model-ready table)."""
    w = _sorted(df, list(keys or [])).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


write_features = write_weekly


def _tagged(df: DataFrame, model: str, run_kind: str, run_id: str) -> DataFrame:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return df.withColumns({"model": F.lit(model), "run_kind": F.lit(run_kind),
                           "run_id": F.lit(run_id), "run_ts": F.lit(now)})


def write_predictions(pred: DataFrame, path: str, model: str, run_kind: str, run_id: str) -> None:
    """W3 + W4: one table for every model and run, partitioned by model."""
    (_tagged(pred, model, run_kind, run_id)
     .write.mode("append").partitionBy("model").parquet(path))


def write_summary(summary: DataFrame, path: str, run_kind: str) -> None:
    """Health summary rows (JSON), tagged with the run kind and time so
    that readers pick the latest walk-forward run (R7)."""
    (summary.withColumn("run_kind", F.lit(run_kind))
     .withColumn("run_ts", F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)))
     .write.mode("append").json(path))


def write_residuals(res: DataFrame, path: str, model: str, run_kind: str, run_id: str) -> None:
    """W6."""
    (_tagged(res, model, run_kind, run_id)
     .write.mode("append").parquet(path))


def write_params(spark, params: dict, path: str) -> None:
    """One JSON record with plain Python scalars."""
    clean = {k: (int(v) if k in ("max_depth", "min_child_weight", "n_estimators") else float(v))
             for k, v in params.items()}
    spark.createDataFrame([clean]).coalesce(1).write.mode("overwrite").json(path)


def save_model(spark, model: BoostedTrees, path: str) -> None:
    """The forest as a table of nodes."""
    model.save(spark, path)


def write_forecast(forecast: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """W9."""
    _sorted(forecast, list(keys or [])).write.mode("overwrite").parquet(path)


def export_forecast_csv(forecast: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """CSV with header for download."""
    _sorted(forecast, list(keys or [])).write.mode("overwrite").option("header", True).csv(path)
