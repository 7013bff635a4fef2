"""Adapter from the TPC-H-like driver tables to the canonical ledger.

invoices  <- orders             (o_orderkey, o_custkey, o_orderdate, o_totalprice)
payments  <- lineitem x orders  (l_shipdate, l_extendedprice * (1 - l_discount))
customers <- customer x orders  (created = first order date, active iff c_acctbal >= 0)

Series keys come from the customer dimension: ``segment`` (c_mktsegment),
``nation`` (n_name) or ``region`` (r_name). Joins are added only for the keys
asked for, so a single-series run never joins lineitem to orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions.columns import from_cents, cents

SERIES_KEYS = ("segment", "nation", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _check_keys(keys: list[str]) -> None:
    bad = [k for k in keys if k not in SERIES_KEYS]
    if bad:
        raise ValueError(f"unknown series keys {bad}; choose from {SERIES_KEYS}")


def customer_dim(spark: SparkSession, sf_dir: str, keys: list[str],
                 extra: tuple = ()) -> DataFrame:
    """customer_id plus the requested series-key columns (and ``extra``
    columns of the customer table). nation (25 rows) and region (5 rows) are
    fixed-size TPC-H dimensions, so they are broadcast."""
    _check_keys(keys)
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        "c_nationkey", *extra,
    )
    if "nation" in keys or "region" in keys:
        nation = table(spark, sf_dir, "nation")
        c = c.join(F.broadcast(nation), c.c_nationkey == nation.n_nationkey, "left")
        c = c.withColumnRenamed("n_name", "nation")
        if "region" in keys:
            region = table(spark, sf_dir, "region")
            c = c.join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey, "left")
            c = c.withColumnRenamed("r_name", "region")
    return c.select("customer_id", *keys, *extra)


def invoices(spark: SparkSession, sf_dir: str, keys: list[str] | None = None) -> DataFrame:
    """Canonical invoices (+ series keys): invoice_id, customer_id, date,
    due_date (= date + 30 d, L2), total."""
    keys = list(keys or [])
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("due_date"),
        F.col("o_totalprice").alias("total"),
    )
    if keys:
        o = o.join(customer_dim(spark, sf_dir, keys), "customer_id")
    return o


def payments(spark: SparkSession, sf_dir: str, keys: list[str] | None = None) -> DataFrame:
    """Canonical payments (+ series keys). One payment per line item; amount
    is the discounted line price rounded to cents. ``payment_id`` is
    "orderkey-linenumber" (not unique in the driver data; V2 reports it)."""
    keys = list(keys or [])
    li = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("payment_id"),
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_shipdate").alias("date"),
        from_cents(cents(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("amount"),
    )
    if not keys:
        return li
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("invoice_id"), F.col("o_custkey").alias("customer_id"))
    o = o.join(customer_dim(spark, sf_dir, keys), "customer_id")
    return li.join(o, "invoice_id")


def customers(spark: SparkSession, sf_dir: str, keys: list[str] | None = None) -> DataFrame:
    """Canonical customers (+ series keys): created_time = first order date
    (NULL for customers without orders), status = 'active' iff c_acctbal >= 0."""
    keys = list(keys or [])
    first = (table(spark, sf_dir, "orders")
             .groupBy(F.col("o_custkey").alias("customer_id"))
             .agg(F.min("o_orderdate").alias("created_time")))
    c = customer_dim(spark, sf_dir, keys, extra=("c_name", "c_acctbal")).select(
        "customer_id",
        F.col("c_name").alias("customer_name"),
        F.when(F.col("c_acctbal") >= 0, F.lit("active")).otherwise(F.lit("inactive")).alias("status"),
        *keys,
    )
    return c.join(first, "customer_id", "left")
