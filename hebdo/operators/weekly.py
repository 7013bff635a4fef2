"""Ledger -> gap-free weekly metrics (A1-A10).

Heavy work is three grouped aggregations over raw ledger rows; Spark runs
them as partial (map-side) + final hash aggregates, so a hot series key
collapses to one row per map task before the shuffle. Everything after
that touches only (series x week) rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.columns import cents, series_window, week_start

METRIC_COLUMNS = [
    "weekly_revenue", "invoice_count", "average_invoice",
    "weekly_payments", "payment_count", "average_payment",
    "new_customers", "active_customers",
]


def _explode_weeks(lo, hi):
    return F.explode(F.sequence(lo, hi, F.expr("INTERVAL 7 DAYS")))


def calendar_of(weekly_agg: DataFrame, keys: list[str] | None = None, bounds=None) -> DataFrame:
    """A2 from an already-aggregated (keys, week) table: every Monday from
    its first to its last week, for every series in it. The global bounds
    enter as scalar subqueries over that small table (no driver round trip,
    no join)."""
    keys = list(keys or [])
    if not keys:
        b = weekly_agg.agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
        lo, hi = (F.lit(bounds[0]), F.lit(bounds[1])) if bounds is not None else (F.col("lo"), F.col("hi"))
        return b.select(_explode_weeks(lo, hi).alias("week"))
    if bounds is not None:
        lo, hi = F.lit(bounds[0]), F.lit(bounds[1])
    else:
        lo = weekly_agg.agg(F.min("week")).scalar()
        hi = weekly_agg.agg(F.max("week")).scalar()
    return weekly_agg.select(*keys).distinct().select(*keys, _explode_weeks(lo, hi).alias("week"))


def week_calendar(invoices: DataFrame, keys: list[str] | None = None,
                  date_col: str = "date", bounds=None) -> DataFrame:
    """Every Monday from the first to the last invoice week (A2), for every
    series seen in ``invoices``. All series share the global bounds."""
    keys = list(keys or [])
    weeks = (invoices.where(F.col(date_col).isNotNull())
             .select(*keys, week_start(date_col).alias("week")).distinct())
    return calendar_of(weeks, keys, bounds)


def _money_agg(df: DataFrame, keys, date_col, amount_col, id_col, names):
    total, count, mean = names
    return (df.where(F.col(date_col).isNotNull())
            .groupBy(*keys, week_start(date_col).alias("week"))
            .agg(F.sum(cents(amount_col)).alias("_cents"),
                 F.count(id_col).alias(count),
                 F.count(amount_col).alias("_n"))
            .select(*keys, "week",
                    (F.col("_cents").cast("double") / 100).alias(total),
                    F.col(count),
                    ((F.col("_cents").cast("double") / 100) / F.col("_n")).alias(mean)))


def weekly_revenue(invoices: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A3: weekly_revenue, invoice_count, average_invoice per (series, week)."""
    return _money_agg(invoices, list(keys or []), "date", "total", "invoice_id",
                      ("weekly_revenue", "invoice_count", "average_invoice"))


def weekly_payments(payments: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A4: weekly_payments, payment_count, average_payment per (series, week)."""
    return _money_agg(payments, list(keys or []), "date", "amount", "payment_id",
                      ("weekly_payments", "payment_count", "average_payment"))


def customer_weeks(customers: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One pass over the customer table: counts by (series, creation week,
    effective week, active?). The effective week is the first Monday at or
    after created_time. Feeds both A5 and A7."""
    keys = list(keys or [])
    ws = week_start("created_time")
    effective = F.when(F.col("created_time") == ws.cast("timestamp"), ws).otherwise(F.date_add(ws, 7))
    return (customers.where(F.col("created_time").isNotNull())
            .groupBy(*keys, ws.alias("week"), effective.alias("effective_week"),
                     (F.col("status") == "active").alias("is_active"))
            .agg(F.count("customer_id").alias("n")))


def new_customers(customers: DataFrame, keys: list[str] | None = None,
                  weeks: DataFrame | None = None) -> DataFrame:
    """A5: customers by the week of their creation."""
    keys = list(keys or [])
    cw = weeks if weeks is not None else customer_weeks(customers, keys)
    return cw.groupBy(*keys, "week").agg(F.sum("n").alias("new_customers"))


def is_active_at(created: str = "created_time", week: str = "week",
                 status: str = "status"):
    """The predicate inside A7."""
    return (F.col(created) <= F.col(week)) & (F.col(status) == "active")


def active_customers(customers: DataFrame, calendar: DataFrame,
                     keys: list[str] | None = None, weeks: DataFrame | None = None) -> DataFrame:
    """Number of currently-active customers created at or before each
    calendar Monday.

    Instead of a (week x customer) range join, each active customer is
    counted once at its effective Monday (the first Monday >= created_time),
    the per-week counts are unioned with the calendar rows, and a running sum
    per series is read off at the calendar rows. Customers created before the
    first calendar week accumulate ahead of it; those after the last one never
    reach a calendar row. One shuffle by series key, no join.
    """
    keys = list(keys or [])
    cw = weeks if weeks is not None else customer_weeks(customers, keys)
    counts = (cw.where("is_active")
              .groupBy(*keys, F.col("effective_week").alias("week"))
              .agg(F.sum("n").alias("_n"))
              .withColumn("_cal", F.lit(False)))
    cal = calendar.select(*keys, "week", F.lit(0).cast("long").alias("_n"),
                          F.lit(True).alias("_cal"))
    order = Window.partitionBy(*keys) if keys else Window.partitionBy()
    w = order.orderBy("week", "_cal").rowsBetween(Window.unboundedPreceding, 0)
    return (cal.unionByName(counts)
            .withColumn("active_customers", F.sum("_n").over(w))
            .where("_cal")
            .select(*keys, "week", F.col("active_customers").cast("long")))


def active_customers_range_join(customers: DataFrame, calendar: DataFrame,
                                keys: list[str] | None = None) -> DataFrame:
    """A7 test twin: the literal (week x customer) range join + count.
    Quadratic; for small fixtures only."""
    keys = list(keys or [])
    cond = [calendar[k] == customers[k] for k in keys]
    cond.append(customers["created_time"] <= calendar["week"])
    cond.append(customers["status"] == "active")
    return (calendar.join(customers, cond, "left")
            .groupBy(*[calendar[k] for k in keys], calendar["week"])
            .agg(F.count(customers["customer_id"]).alias("active_customers")))


def customer_counts(customers: DataFrame, calendar: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A5 and A7 at once: (keys, calendar week, new_customers, active_customers).

    The customers are read and aggregated once; each aggregated row is tagged twice, as
    new in its week and as active from its effective week on, and joins the
    calendar rows in one union and one running sum per series."""
    keys = list(keys or [])
    none = F.lit(0).cast("long")
    tags = F.array(
        F.struct("week", F.col("n").alias("new"), none.alias("active")),
        F.struct(F.col("effective_week").alias("week"), none.alias("new"),
                 F.when(F.col("is_active"), F.col("n")).otherwise(none).alias("active")))
    counts = (customer_weeks(customers, keys).select(*keys, F.explode(tags).alias("t"))
              .select(*keys, "t.*", F.lit(False).alias("_cal")))
    cal = calendar.select(*keys, "week", none.alias("new"), none.alias("active"), F.lit(True).alias("_cal"))
    weeks = cal.unionByName(counts).groupBy(*keys, "week").agg(
        F.sum("new").alias("new_customers"), F.sum("active").alias("_n"), F.max("_cal").alias("_cal"))
    so_far = series_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    return (weeks.withColumn("active_customers", F.sum("_n").over(so_far)).where("_cal")
            .select(*keys, "week", "new_customers", "active_customers"))


def weekly_dataset(calendar: DataFrame, tables: list[DataFrame], keys: list[str] | None = None) -> DataFrame:
    """A8 + A9: calendar left-joined with the weekly tables on (keys, week);
    every gap is 0."""
    keys = list(keys or [])
    on = keys + ["week"]
    out = reduce(lambda left, right: left.join(right, on, "left"), tables, calendar)
    return out.na.fill(0, subset=METRIC_COLUMNS).select(*on, *METRIC_COLUMNS)


def build_weekly_metrics(invoices: DataFrame, payments: DataFrame, customers: DataFrame,
                         keys: list[str] | None = None, bounds=None,
                         drop_partial_last: bool = False) -> DataFrame:
    """E1 end to end: ledger -> gap-free weekly metrics per series. The last
    week is kept even when the ledger ends mid-week, unless
    ``drop_partial_last`` (then it is kept only if the last invoice falls on
    its Sunday)."""
    keys = list(keys or [])
    # The (series x week) revenue aggregate is tiny next to the ledger; it is
    # persisted so the calendar's series list and bounds read it instead of
    # re-joining the invoices (Catalyst would otherwise prune it back to a
    # separate scan + join for the distinct keys).
    revenue = weekly_revenue(invoices, keys).persist()
    cal = calendar_of(revenue, keys, bounds)
    if drop_partial_last:
        last_day = invoices.agg(F.max(F.col("date").cast("date"))).scalar()
        cal = cal.where(F.date_add("week", 6) <= last_day)
    return weekly_dataset(cal, [revenue, weekly_payments(payments, keys), customer_counts(customers, cal, keys)], keys)


def weekly_summary(weekly: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A10: weeks, total and mean revenue, mean customers/invoices/payments."""
    keys = list(keys or [])
    return weekly.groupBy(*keys).agg(
        F.count("week").alias("weeks"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
        (F.sum(cents("weekly_revenue")).cast("double") / 100).alias("total_revenue"),
        F.avg("weekly_revenue").alias("mean_weekly_revenue"),
        F.avg("active_customers").alias("mean_active_customers"),
        F.avg("invoice_count").alias("mean_invoice_count"),
        F.avg("payment_count").alias("mean_payment_count"),
    )
