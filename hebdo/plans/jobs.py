"""The three end-to-end jobs, wired to sources and sinks.

E1 ``weekly_metrics_job``: ledger -> validated weekly metrics table.
E2 ``training_job``: weekly metrics -> model-ready table -> pooled trees
   (holdout) -> predictions, residuals, health summary, model, parameters;
   ``tuning_job`` before it finds the parameters that it reads.
E3 ``forecast_job``: model-ready table + model + residuals -> forecast
   table (+ CSV export), weeks or months ahead.

Stages hand over through tables in ``out_dir`` (a shared folder on a
cluster), like the reference's scripts hand over through files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.operators import checks as ck
from hebdo.operators import evaluate as ev
from hebdo.operators import features as fe
from hebdo.operators import forecast as fc
from hebdo.operators import trees as tr
from hebdo.operators import weekly as wk
from hebdo.session import configure
from hebdo.sources import files, sinks


def weekly_metrics_job(invoices: DataFrame, payments: DataFrame, customers: DataFrame,
                       out_dir: str, keys: list[str] | None = None) -> DataFrame:
    """Validate the ledger, build and write the weekly metrics (W1), then
    validate what was written."""
    keys = list(keys or [])
    configure(invoices.sparkSession)
    for df, key in ((invoices, "invoice_id"), (payments, "payment_id"), (customers, "customer_id")):
        ck.require(ck.check_table(df, [key]).where(f"rule in ('non_empty', 'unique:{key}')"))
    weekly = wk.build_weekly_metrics(invoices, payments, customers, keys)
    sinks.write_weekly(weekly, f"{out_dir}/weekly", keys)
    written = files.read_weekly(invoices.sparkSession, f"{out_dir}/weekly", keys=keys)
    ck.require(ck.check_weekly(written, keys))
    return written


def _tuned(spark: SparkSession, out_dir: str) -> dict:
    return files.read_params(spark, f"{out_dir}/tuned", tr.TUNED_PARAMS)


def tuning_job(spark: SparkSession, out_dir: str, keys: list[str] | None = None, n_iter: int = 100,
               h: int = 12, n_splits: int = 5) -> dict:
    """Random search over the model-ready table (T2): writes the leaderboard
    and the best draw's parameters (W7), which training and the walk-forward
    then read (R6). Returns them."""
    keys = list(keys or [])
    configure(spark)
    ready = fe.model_ready(files.read_weekly(spark, f"{out_dir}/weekly", keys=keys), keys)
    sinks.write_features(ready, f"{out_dir}/model_ready", keys)
    ready = files.read_features(spark, f"{out_dir}/model_ready", keys)
    tr.tune(ready, keys, n_iter, h, n_splits).write.mode("overwrite").parquet(f"{out_dir}/leaderboard")
    best = tr.best_params(spark.read.parquet(f"{out_dir}/leaderboard"))
    sinks.write_params(spark, best, f"{out_dir}/tuned")
    return best


def training_job(spark: SparkSession, out_dir: str, keys: list[str] | None = None,
                 params: dict | None = None, h: int = 12) -> DataFrame:
    """Features (W2), pooled-tree holdout fit, predictions with
    intervals (W3), residuals (W6), health summary (W5), model (W8) and
    parameters (W7). Returns the health summary."""
    keys = list(keys or [])
    configure(spark)
    run_id = uuid.uuid4().hex
    weekly = files.read_weekly(spark, f"{out_dir}/weekly", keys=keys)
    ready = fe.model_ready(weekly, keys)
    ck.require(ck.check_features(ready, keys))
    sinks.write_features(ready, f"{out_dir}/model_ready", keys)
    ready = files.read_features(spark, f"{out_dir}/model_ready", keys)
    params = {**_tuned(spark, out_dir), **(params or {})}
    model, pred = tr.holdout(ready, keys, params, h)
    test = pred.where("role = 'test'").drop("role")
    q = ev.conformal_quantile(ev.with_errors(test), keys)
    intervals = ev.interval_constant(test, q, keys)
    sinks.write_predictions(intervals, f"{out_dir}/predictions", "trees", "holdout", run_id)
    sinks.write_residuals(ev.with_errors(test).select(*keys, "week", "abs_error"),
                          f"{out_dir}/residuals", "trees", "holdout", run_id)
    health = ev.health_summary(test, q, keys)
    sinks.write_summary(health, f"{out_dir}/health", "holdout")
    sinks.save_model(spark, model, f"{out_dir}/model")
    sinks.write_params(spark, params, f"{out_dir}/params")
    return files.read_health(spark, f"{out_dir}/health", keys)


def walk_forward_job(spark: SparkSession, out_dir: str, keys: list[str] | None = None,
                     params: dict | None = None, initial: int = 104, refit_every: int = 1) -> DataFrame:
    """Walk-forward back-test of the pooled trees (J5): predictions (W4),
    residuals (W6) and the health summary (W5) that the forecast prefers."""
    keys = list(keys or [])
    configure(spark)
    run_id = uuid.uuid4().hex
    ready = files.read_features(spark, f"{out_dir}/model_ready", keys)
    pred = tr.walk_forward(ready, keys, {**_tuned(spark, out_dir), **(params or {})}, initial, refit_every)
    sinks.write_predictions(pred, f"{out_dir}/walk_forward", "trees", "walk_forward", run_id)
    pred = spark.read.parquet(f"{out_dir}/walk_forward").where(F.col("run_id") == run_id)
    errors = ev.with_errors(pred)
    sinks.write_residuals(errors.select(*keys, "week", "abs_error"),
                          f"{out_dir}/residuals", "trees", "walk_forward", run_id)
    q = ev.conformal_quantile(errors, keys)
    sinks.write_summary(ev.health_summary(pred, q, keys), f"{out_dir}/health", "walk_forward")
    return files.read_health(spark, f"{out_dir}/health", keys)


def forecast_job(spark: SparkSession, out_dir: str, keys: list[str] | None = None,
                 forecast_type: str = "weeks", weeks: int = 26,
                 months_ahead: int | None = None, month: int | None = None,
                 year: int | None = None) -> DataFrame:
    """Load model, history and residuals (R5, R8, R9), forecast with
    intervals (H10), write the forecast (W9) and its CSV export (W10). The
    residuals are those of the newest walk-forward run, else of the newest
    training run."""
    keys = list(keys or [])
    configure(spark)
    ready = files.read_features(spark, f"{out_dir}/model_ready", keys)
    model = files.load_model(spark, f"{out_dir}/model")
    residuals = files.latest_run(files.read_residuals(spark, f"{out_dir}/residuals", keys)
                                 .where(F.col("model") == "trees"))
    out = fc.run_forecast(ready, model, residuals, keys, forecast_type, weeks, months_ahead, month, year)
    sinks.write_forecast(out, f"{out_dir}/forecast", keys)
    sinks.export_forecast_csv(out, f"{out_dir}/forecast_csv", keys)
    return spark.read.parquet(f"{out_dir}/forecast")
