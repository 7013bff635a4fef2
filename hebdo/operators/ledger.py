"""Ledger operators (L1-L3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.functions.columns import cents


def due_date(date_col: str = "date", days: int = 30):
    """L2: invoice due date."""
    return F.col(date_col) + F.make_dt_interval(F.lit(days))


def invoice_settlement(invoices: DataFrame, payments: DataFrame, as_of=None) -> DataFrame:
    """L1: reconcile invoices with their payments.

    amount_paid = sum of all payments (cents, exact), overpaid = what exceeds
    the total; status: Paid when fully
    covered, Partially Paid when something but not all was paid, Overdue when
    nothing was paid and the due date is before ``as_of`` (default: the last
    payment date in the data, as a scalar subquery), else Open. Payments are pre-aggregated per
    invoice before the join (partial aggregation collapses hot invoices).
    """
    paid = (payments.groupBy("invoice_id")
            .agg(F.sum(cents("amount")).alias("_paid_cents")))
    as_of_col = payments.agg(F.max("date")).scalar() if as_of is None else F.lit(as_of)
    inv = invoices.select("invoice_id", "customer_id", "date", "due_date", "total",
                          *[c for c in invoices.columns if c not in
                            ("invoice_id", "customer_id", "date", "due_date", "total",
                             "amount_paid", "status")])
    j = inv.join(paid, "invoice_id", "left")
    paid_c = F.coalesce("_paid_cents", F.lit(0))
    total_c = cents("total")
    status = (F.when(paid_c >= total_c, "Paid")
              .when(paid_c > 0, "Partially Paid")
              .when(F.col("due_date") < as_of_col, "Overdue")
              .otherwise("Open"))
    return (j.withColumn("amount_paid", paid_c.cast("double") / 100)
            .withColumn("overpaid", F.greatest(paid_c - total_c, F.lit(0)).cast("double") / 100)
            .withColumn("paid_in_full", paid_c >= total_c)
            .withColumn("status", status)
            .drop("_paid_cents"))


def ledger_summary(invoices: DataFrame, payments: DataFrame, customers: DataFrame) -> DataFrame:
    """L3: ledger KPIs as (metric, value) rows: customers, active, inactive,
    invoices, payments, mean invoice, mean payment. Three single-pass
    aggregates stacked with a union (no join)."""
    def stack(df, pairs):
        row = df.agg(*[c.cast("double").alias(n) for n, c in pairs])
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n, _ in pairs])))
    mean_of = lambda c: F.sum(cents(c)).cast("double") / 100 / F.count(c)
    return (stack(customers, [
                ("customers", F.count(F.lit(1))),
                ("active_customers", F.count_if(F.col("status") == "active")),
                ("inactive_customers", F.count_if(F.col("status") == "inactive"))])
            .unionByName(stack(invoices, [("invoices", F.count(F.lit(1))),
                                          ("mean_invoice", mean_of("total"))]))
            .unionByName(stack(payments, [("payments", F.count(F.lit(1))),
                                          ("mean_payment", mean_of("amount"))])))
