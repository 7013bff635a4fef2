"""The three end-to-end jobs on sf0.001, handing over through a scratch folder."""

import tempfile

from conftest import SF_SMALL
from hebdo.plans import jobs
from hebdo.sources import tpch

KEYS = ["segment"]


def _payments(spark):
    """The driver's line numbers repeat within an order; the job rejects such
    a ledger, so every payment gets an id of its own here."""
    from pyspark.sql import functions as F
    return tpch.payments(spark, SF_SMALL, KEYS).withColumn(
        "payment_id", F.monotonically_increasing_id().cast("string"))


def test_repeated_payment_ids_are_rejected(spark):
    import pytest
    with pytest.raises(ValueError, match="unique:payment_id"):
        jobs.weekly_metrics_job(tpch.invoices(spark, SF_SMALL, KEYS), tpch.payments(spark, SF_SMALL, KEYS),
                                tpch.customers(spark, SF_SMALL, KEYS), tempfile.mkdtemp(prefix="hebdo-jobs-"), KEYS)


def test_jobs_end_to_end(spark):
    out = tempfile.mkdtemp(prefix="hebdo-jobs-")
    weekly = jobs.weekly_metrics_job(tpch.invoices(spark, SF_SMALL, KEYS),
                                     _payments(spark),
                                     tpch.customers(spark, SF_SMALL, KEYS), out, KEYS)
    n_series = weekly.select("segment").distinct().count()
    health = jobs.training_job(spark, out, KEYS, {"n_estimators": 5, "learning_rate": 0.3})
    assert health.count() == n_series
    row = health.first()
    assert row.upper_bound >= row.forecast >= row.lower_bound and row.run_kind == "holdout"
    fc = jobs.forecast_job(spark, out, KEYS, weeks=3)
    assert fc.count() == 3 * n_series
    assert {"lower_bound", "upper_bound", "confidence", "best_case", "worst_case"} <= set(fc.columns)
    assert spark.read.option("header", True).csv(f"{out}/forecast_csv").count() == 3 * n_series


def test_forecast_uses_the_newest_walk_forward_run(spark):
    from hebdo.operators import evaluate as ev
    from hebdo.sources import files
    out = tempfile.mkdtemp(prefix="hebdo-jobs-")
    jobs.weekly_metrics_job(tpch.invoices(spark, SF_SMALL, KEYS), _payments(spark),
                            tpch.customers(spark, SF_SMALL, KEYS), out, KEYS)
    small = {"n_estimators": 2, "learning_rate": 0.3}
    jobs.training_job(spark, out, KEYS, small)
    jobs.training_job(spark, out, KEYS, small)
    every = files.read_residuals(spark, f"{out}/residuals", KEYS)
    assert every.select("run_id").distinct().count() == 2
    assert files.latest_run(every).count() * 2 == every.count()
    health = jobs.walk_forward_job(spark, out, KEYS, small, initial=30, refit_every=200)
    assert {r.run_kind for r in health.collect()} == {"walk_forward"}
    got = jobs.forecast_job(spark, out, KEYS, weeks=1).collect()
    walked = files.read_residuals(spark, f"{out}/residuals", KEYS).where("run_kind = 'walk_forward'")
    want = {r.segment: r.quantile for r in ev.conformal_quantile(walked, KEYS).collect()}
    for r in got:
        assert abs((r.upper_bound - r.lower_bound) / 2 - want[r.segment]) < 1e-6 * want[r.segment] or r.lower_bound == 0


def test_training_reads_what_tuning_wrote(spark):
    from hebdo.operators import trees as tr
    from hebdo.sources import files
    out = tempfile.mkdtemp(prefix="hebdo-jobs-")
    jobs.weekly_metrics_job(tpch.invoices(spark, SF_SMALL, KEYS), _payments(spark),
                            tpch.customers(spark, SF_SMALL, KEYS), out, KEYS)
    best = jobs.tuning_job(spark, out, KEYS, n_iter=2, n_splits=2)
    assert best in tr.sample_params(2, tr.SEED) and files.read_params(spark, f"{out}/tuned") == best
    jobs.training_job(spark, out, KEYS, {"n_estimators": 4})
    assert files.read_params(spark, f"{out}/params") == {**best, "n_estimators": 4}
    assert files.load_model(spark, f"{out}/model").forest.feature.shape[0] == 4


def test_forecast_to_a_given_month(spark):
    out = tempfile.mkdtemp(prefix="hebdo-jobs-")
    jobs.weekly_metrics_job(tpch.invoices(spark, SF_SMALL, KEYS), _payments(spark),
                            tpch.customers(spark, SF_SMALL, KEYS), out, KEYS)
    jobs.training_job(spark, out, KEYS, {"n_estimators": 2, "learning_rate": 0.3})
    last = spark.read.parquet(f"{out}/model_ready").selectExpr("max(week) w").first().w
    month, year = (last.month % 12) + 1, last.year + (last.month == 12)
    got = jobs.forecast_job(spark, out, KEYS, "months", month=month, year=year)
    end = got.selectExpr("max(week) w").first().w
    assert (end.year, end.month) == (year, month)


def test_broken_health_file_raises_and_a_missing_one_is_empty(spark):
    import os

    import pytest

    from hebdo.sources import files
    out = tempfile.mkdtemp(prefix="hebdo-jobs-")
    assert files.read_health(spark, f"{out}/none", KEYS).count() == 0
    os.makedirs(f"{out}/health")
    with open(f"{out}/health/x.json", "w") as f:
        f.write("{broken")
    with pytest.raises(Exception):
        files.read_health(spark, f"{out}/health", KEYS).count()
