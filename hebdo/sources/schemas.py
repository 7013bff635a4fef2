"""Canonical ledger and weekly schemas (never inferred)."""

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("created_time", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("payment_terms", T.IntegerType()),
])

INVOICES = T.StructType([
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("due_date", T.TimestampType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("amount_paid", T.DoubleType()),
    T.StructField("status", T.StringType()),
])

PAYMENTS = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("amount", T.DoubleType()),
])

WEEKLY = T.StructType([
    T.StructField("week", T.DateType()),
    T.StructField("weekly_revenue", T.DoubleType()),
    T.StructField("invoice_count", T.LongType()),
    T.StructField("average_invoice", T.DoubleType()),
    T.StructField("weekly_payments", T.DoubleType()),
    T.StructField("payment_count", T.LongType()),
    T.StructField("average_payment", T.DoubleType()),
    T.StructField("new_customers", T.LongType()),
    T.StructField("active_customers", T.LongType()),
])

# Tuned-parameter record (one JSON object).
PARAMS = T.StructType([
    T.StructField("colsample_bytree", T.DoubleType()),
    T.StructField("gamma", T.DoubleType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("max_depth", T.IntegerType()),
    T.StructField("min_child_weight", T.IntegerType()),
    T.StructField("n_estimators", T.IntegerType()),
    T.StructField("reg_alpha", T.DoubleType()),
    T.StructField("reg_lambda", T.DoubleType()),
    T.StructField("subsample", T.DoubleType()),
])

SUMMARY = T.StructType([
    T.StructField("forecast", T.DoubleType()),
    T.StructField("lower_bound", T.DoubleType()),
    T.StructField("upper_bound", T.DoubleType()),
    T.StructField("forecast_confidence", T.DoubleType()),
    T.StructField("model_stability", T.DoubleType()),
    T.StructField("drift_detected", T.BooleanType()),
])
