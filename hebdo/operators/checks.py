"""Validation predicates (V1-V7) as one aggregate pass per table.

Each check returns a DataFrame ``(check, violations)``; ``require`` raises
if any violation count is non-zero. The only shuffle is the uniqueness
count, which is a partial+final aggregate on the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _stack(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One aggregate row with every check, unpivoted with ``stack`` into
    (rule, violations) rows."""
    row = df.agg(*[c.cast("long").alias(f"c{i}") for i, c in enumerate(checks.values())])
    args = ", ".join(f"'{name}', c{i}" for i, name in enumerate(checks))
    return row.selectExpr(f"stack({len(checks)}, {args}) AS (rule, violations)")


def duplicate_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """V2/V3: number of extra rows sharing the same id (one-row DataFrame)."""
    return (df.groupBy(*cols).count().where("count > 1")
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("violations")))


def _numeric(df: DataFrame, cols) -> list[str]:
    kinds = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.DecimalType)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, kinds) and (cols is None or f.name in cols)]


def row_checks(df: DataFrame, non_negative=(), not_null=(), finite=None,
               extra: dict[str, Column] | None = None) -> dict[str, Column]:
    checks: dict[str, Column] = {"non_empty": (F.count(F.lit(1)) == 0)}
    for c in non_negative:
        checks[f"non_negative:{c}"] = F.count_if(F.col(c) < 0)
    for c in not_null:
        cond = F.col(c).isNull()
        if c in _numeric(df, None):
            cond = cond | F.isnan(F.col(c))
        checks[f"not_null:{c}"] = F.count_if(cond)
    for c in ([] if finite is None else _numeric(df, finite)):
        x = F.col(c).cast("double")
        checks[f"finite:{c}"] = F.count_if(F.isnan(x) | (F.abs(x) == float("inf")))
    checks.update(extra or {})
    return checks


def check_table(df: DataFrame, unique: list[str] | None = None, **kw) -> DataFrame:
    """All row-level checks of one table, plus uniqueness, in one scan: the rows of
    an id are counted and checked first, then the ids are added up."""
    checks = row_checks(df, **kw)
    if not unique:
        return _stack(df, checks)
    rules = [r for r in checks if r != "non_empty"]
    by_id = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("_n"), *[checks[r].alias(f"_c{i}") for i, r in enumerate(rules)])
    total = {r: F.coalesce(F.sum(f"_c{i}"), F.lit(0)) for i, r in enumerate(rules)}
    return _stack(by_id, {"non_empty": F.count(F.lit(1)) == 0, **total,
                          "unique:" + ",".join(unique): F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))})


def check_ledger(invoices: DataFrame, payments: DataFrame, customers: DataFrame,
                 payment_key: list[str] | None = None) -> DataFrame:
    """V1, V2, V7 over the three ledger tables. ``invoices`` carries
    ``amount_paid`` (L1) for the paid-at-most-total half of V7."""
    inv = check_table(invoices, ["invoice_id"], extra={
        "positive_total": F.count_if(F.col("total") <= 0),
        **({"paid_le_total": F.count_if(F.col("amount_paid") > F.col("total"))}
           if "amount_paid" in invoices.columns else {}),
    })
    pay = check_table(payments, payment_key or ["payment_id"])
    cus = check_table(customers, ["customer_id"])
    tag = lambda d, t: d.select(F.lit(t).alias("table"), "rule", "violations")
    return tag(inv, "invoices").unionByName(tag(pay, "payments")).unionByName(tag(cus, "customers"))


def check_weekly(weekly: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """V1, V3, V4 on the weekly metrics."""
    keys = list(keys or [])
    return check_table(weekly, keys + ["week"], non_negative=(
        "weekly_revenue", "weekly_payments", "invoice_count", "payment_count",
        "new_customers", "active_customers"))


def check_features(ready: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """V1, V3, V5, V6 on the model-ready table."""
    keys = list(keys or [])
    cols = [c for c in ready.columns if c not in keys]
    return check_table(ready, keys + ["week"], not_null=cols,
                       finite=[c for c in cols if c != "week"])


def require(checks: DataFrame) -> None:
    """Raise if any rule has violations (collects only the check rows)."""
    # one row per rule: collect the small result and filter it here
    bad = [r for r in checks.collect() if r["violations"] > 0]
    if bad:
        raise ValueError("validation failed: " + ", ".join(
            f"{r['rule']}={r['violations']}" for r in bad))
