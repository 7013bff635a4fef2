"""Round trips through the file sources and sinks (scratch folder)."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from hebdo.operators import features as fe
from hebdo.operators import trees as tr
from hebdo.operators import weekly as wk
from hebdo.sources import files, sinks, tpch

KEYS = ["segment"]


def test_weekly_and_features_round_trip(spark):
    out = tempfile.mkdtemp(prefix="hebdo-io-")
    weekly = wk.build_weekly_metrics(tpch.invoices(spark, SF_SMALL, KEYS),
                                     tpch.payments(spark, SF_SMALL, KEYS),
                                     tpch.customers(spark, SF_SMALL, KEYS), KEYS)
    sinks.write_weekly(weekly, f"{out}/weekly", KEYS)
    back = files.read_weekly(spark, f"{out}/weekly", keys=KEYS)
    assert back.count() == weekly.count()
    sinks.write_weekly(weekly, f"{out}/weekly_csv", KEYS, fmt="csv")
    assert files.read_weekly(spark, f"{out}/weekly_csv", fmt="csv", keys=KEYS).count() == weekly.count()
    ready = fe.model_ready(weekly, KEYS)
    sinks.write_features(ready, f"{out}/ready", KEYS)
    assert files.read_features(spark, f"{out}/ready", KEYS).count() == ready.count()


def test_params_and_health_round_trip(spark):
    out = tempfile.mkdtemp(prefix="hebdo-io-")
    sinks.write_params(spark, tr.TUNED_PARAMS, f"{out}/params")
    p = files.read_params(spark, f"{out}/params")
    assert p["n_estimators"] == 505 and abs(p["learning_rate"] - 0.024478072123840997) < 1e-15
    assert files.read_health(spark, f"{out}/missing", KEYS).count() == 0
    row = spark.createDataFrame(
        [("A", 1.0, 0.5, 1.5, 80.0, 60.0, True)],
        "segment string, forecast double, lower_bound double, upper_bound double, "
        "forecast_confidence double, model_stability double, drift_detected boolean")
    sinks.write_summary(row.withColumn("forecast", F.lit(2.0)), f"{out}/health", "walk_forward")
    sinks.write_summary(row, f"{out}/health", "training")
    h = files.read_health(spark, f"{out}/health", KEYS).first()
    assert h.forecast == 2.0 and h.run_kind == "walk_forward"


def test_ledger_csv_readers(spark):
    out = tempfile.mkdtemp(prefix="hebdo-io-")
    inv = spark.createDataFrame(
        [("I1", "C1", dt.datetime(2024, 1, 2), dt.datetime(2024, 2, 1), 100.0, 0.0, "Open")],
        "invoice_id string, customer_id string, date timestamp, due_date timestamp, total double, "
        "amount_paid double, status string")
    inv.write.option("header", True).csv(f"{out}/inv")
    back = files.read_invoices(spark, f"{out}/inv")
    assert back.first().total == 100.0
