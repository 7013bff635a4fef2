"""DuckDB SQL twins of the registered queries (the correctness oracle).

Views ``region nation customer supplier part orders lineitem ...`` are
registered by the caller. Expressions mirror the Spark ones operation for
operation (integer cents for money sums, explicit lag sums) so results agree
bit for bit wherever the arithmetic allows; aggregates whose summation order
differs are rounded half-up on both sides.
"""

from __future__ import annotations

import math

from hebdo.operators.unit_root import NORMAL_LOW, NORMAL_TOP, TAU_LARGE, TAU_MAX, TAU_MIN, TAU_SMALL, TAU_STAR

ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> str:
    ORACLE[name] = sql.strip()
    return sql


def dbl(x: float) -> str:
    """Exact double literal (parsed from text, not via DECIMAL)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str, digits: int) -> str:
    s = float(10 ** digits)
    return (f"(CASE WHEN abs(({expr}) * {dbl(s)}) < {dbl(2.0 ** 52)} "
            f"THEN floor(({expr}) * {dbl(s)} + 0.5) / {dbl(s)} ELSE ({expr}) END)")


def significant(expr: str, digits: int = 10) -> str:
    p = f"pow({dbl(10.0)}, floor(log10(abs({expr}))) - {digits - 1})"
    return f"(CASE WHEN ({expr}) = 0 THEN ({expr}) ELSE floor(({expr}) / {p} + 0.5) * {p} END)"


def cents(expr: str) -> str:
    return f"CAST(floor(({expr}) * 100.0 + 0.5) AS BIGINT)"


def week(expr: str) -> str:
    return f"CAST(date_trunc('week', {expr}) AS DATE)"


# Canonical ledger over the driver tables, series key = segment.
LEDGER = f"""
inv AS (
  SELECT o.o_orderkey AS invoice_id, o.o_custkey AS customer_id, o.o_orderdate AS date,
         o.o_orderdate + INTERVAL 30 DAY AS due_date, o.o_totalprice AS total,
         c.c_mktsegment AS segment
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
pay AS (
  SELECT concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) AS payment_id,
         l.l_orderkey AS invoice_id, o.o_custkey AS customer_id, l.l_shipdate AS date,
         CAST({cents('l.l_extendedprice * (1 - l.l_discount)')} AS DOUBLE) / 100 AS amount,
         c.c_mktsegment AS segment
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey),
cust AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS customer_name,
         CASE WHEN c.c_acctbal >= 0 THEN 'active' ELSE 'inactive' END AS status,
         f.created_time, c.c_mktsegment AS segment
  FROM customer c LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS created_time
                             FROM orders GROUP BY o_custkey) f ON f.o_custkey = c.c_custkey),
bounds AS (SELECT min({week('date')}) AS lo, max({week('date')}) AS hi FROM inv),
cal AS (
  SELECT s.segment, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 7 DAY)) AS DATE) AS week
  FROM (SELECT DISTINCT segment FROM inv) s CROSS JOIN bounds b),
rev AS (
  SELECT segment, {week('date')} AS week,
         CAST(sum({cents('total')}) AS DOUBLE) / 100 AS weekly_revenue,
         count(invoice_id) AS invoice_count,
         (CAST(sum({cents('total')}) AS DOUBLE) / 100) / count(total) AS average_invoice
  FROM inv WHERE date IS NOT NULL GROUP BY 1, 2),
pays AS (
  SELECT segment, {week('date')} AS week,
         CAST(sum({cents('amount')}) AS DOUBLE) / 100 AS weekly_payments,
         count(payment_id) AS payment_count,
         (CAST(sum({cents('amount')}) AS DOUBLE) / 100) / count(amount) AS average_payment
  FROM pay WHERE date IS NOT NULL GROUP BY 1, 2),
newc AS (
  SELECT segment, {week('created_time')} AS week, count(customer_id) AS new_customers
  FROM cust WHERE created_time IS NOT NULL GROUP BY 1, 2),
act AS (
  SELECT cal.segment, cal.week, count(c.customer_id) AS active_customers
  FROM cal LEFT JOIN cust c
    ON c.segment = cal.segment AND c.created_time <= cal.week AND c.status = 'active'
  GROUP BY 1, 2),
weekly AS (
  SELECT cal.segment, cal.week,
         coalesce(r.weekly_revenue, 0) AS weekly_revenue,
         coalesce(r.invoice_count, 0) AS invoice_count,
         coalesce(r.average_invoice, 0) AS average_invoice,
         coalesce(p.weekly_payments, 0) AS weekly_payments,
         coalesce(p.payment_count, 0) AS payment_count,
         coalesce(p.average_payment, 0) AS average_payment,
         coalesce(n.new_customers, 0) AS new_customers,
         coalesce(a.active_customers, 0) AS active_customers
  FROM cal
  LEFT JOIN rev r ON r.segment = cal.segment AND r.week = cal.week
  LEFT JOIN pays p ON p.segment = cal.segment AND p.week = cal.week
  LEFT JOIN newc n ON n.segment = cal.segment AND n.week = cal.week
  LEFT JOIN act a ON a.segment = cal.segment AND a.week = cal.week)
"""


def with_ledger(body: str, extra_ctes: str = "", total: bool = False,
                series: str | None = None) -> str:
    """WITH ledger CTEs [+ extra] body. ``total=True`` makes every row one
    series (a constant series key the final SELECT leaves out), the twin of
    running the Spark operators with ``keys=[]``; ``series='nation'`` keys
    the series by the customer's nation name (the CTEs keep calling the key
    column ``segment``; the final SELECT renames it)."""
    ctes = LEDGER.strip()
    if total:
        ctes = ctes.replace("c.c_mktsegment AS segment", "'total' AS segment")
    elif series == "nation":
        ctes = ctes.replace("c.c_mktsegment AS segment",
                            "(SELECT n_name FROM nation WHERE n_nationkey = c.c_nationkey) AS segment")
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body}"


register("weekly_revenue", with_ledger("SELECT * FROM rev"))
register("weekly_payments", with_ledger("SELECT * FROM pays"))
register("new_customers", with_ledger("SELECT * FROM newc"))
register("week_calendar", with_ledger("SELECT * FROM cal"))
register("active_customers", with_ledger("SELECT * FROM act"))
register("weekly_metrics", with_ledger("SELECT * FROM weekly"))
register("weekly_summary", with_ledger(f"""
SELECT segment, count(week) AS weeks, min(week) AS first_week, max(week) AS last_week,
       CAST(sum({cents('weekly_revenue')}) AS DOUBLE) / 100 AS total_revenue,
       {rnd('avg(weekly_revenue)', 4)} AS mean_weekly_revenue,
       {rnd('avg(active_customers)', 6)} AS mean_active_customers,
       {rnd('avg(invoice_count)', 6)} AS mean_invoice_count,
       {rnd('avg(payment_count)', 6)} AS mean_payment_count
FROM weekly GROUP BY segment"""))


# ---------------------------------------------------------------- features
import math as _math  # noqa: E402

_W = "OVER (PARTITION BY segment ORDER BY week)"
_HIST = ("list(weekly_revenue) OVER (PARTITION BY segment ORDER BY week "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")


def lag(c: str, k: int) -> str:
    return f"lag({c}, {k}) {_W}"


def lag_sum(c: str, k: int) -> str:
    return "(" + " + ".join(lag(c, i) for i in range(1, k + 1)) + ")"


def lag_mean(c: str, k: int) -> str:
    return f"({lag_sum(c, k)} / {dbl(k)})"


def lag_std(c: str, k: int) -> str:
    m = lag_mean(c, k)
    terms = [f"({lag(c, i)} - {m}) * ({lag(c, i)} - {m})" for i in range(1, k + 1)]
    return f"sqrt(({' + '.join(terms)}) / {dbl(k - 1)})"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def ema(hist: str, span: int) -> str:
    a = 2.0 / (span + 1)
    return (f"CASE WHEN len({hist}) > 0 THEN list_reduce(list_slice({hist}, 2, len({hist})), "
            f"lambda acc, x: acc * {dbl(1.0 - a)} + x * {dbl(a)}, {hist}[1]) END")


def feature_sql() -> dict[str, str]:
    y = "weekly_revenue"
    f: dict[str, str] = {}
    for k in (1, 2, 4, 8, 12, 26):
        f[f"lag_{k}"] = lag(y, k)
    for k in (4, 8, 12):
        f[f"rolling_mean_{k}"] = lag_mean(y, k)
        f[f"rolling_std_{k}"] = lag_std(y, k)
    f["ema_4"] = ema("_hist", 4)
    f["ema_12"] = ema("_hist", 12)
    f["revenue_vs_4w_avg"] = div(f["lag_1"], f["rolling_mean_4"])
    f["revenue_vs_8w_avg"] = div(f["lag_1"], f["rolling_mean_8"])
    f["revenue_growth_4w"] = f"({div(f['lag_1'], f['lag_4'])} - 1)"
    f["revenue_acceleration"] = f"({f['lag_1']} - {f['lag_2']})"
    f["revenue_deviation"] = f"({f['lag_1']} - {f['rolling_mean_12']})"
    f["rolling_cv_4"] = div(f["rolling_std_4"], f["rolling_mean_4"])
    f["active_customers_lag_1"] = lag("active_customers", 1)
    f["customer_trend_4"] = lag_mean("active_customers", 4)
    f["revenue_per_customer_lag_1"] = div(lag(y, 1), lag("active_customers", 1))
    f["new_customers_lag_1"] = lag("new_customers", 1)
    f["invoice_count_lag_1"] = lag("invoice_count", 1)
    f["average_invoice_lag_1"] = lag("average_invoice", 1)
    f["invoice_trend_4"] = lag_mean("invoice_count", 4)
    f["invoice_growth"] = f"({div(lag('invoice_count', 1), lag('invoice_count', 4))} - 1)"
    f["payment_lag_1"] = lag("weekly_payments", 1)
    f["average_payment_lag_1"] = lag("average_payment", 1)
    f["payment_trend_4"] = lag_mean("weekly_payments", 4)
    f["collection_rate_lag_1"] = div(lag("weekly_payments", 1), lag(y, 1))
    f["outstanding_lag_1"] = f"({lag(y, 1)} - {lag('weekly_payments', 1)})"
    f["payment_count_lag_1"] = lag("payment_count", 1)
    two_pi = dbl(2 * _math.pi)
    m = f"({two_pi} * month(week) / {dbl(12.0)})"
    wk = f"({two_pi} * weekofyear(week) / {dbl(52.0)})"
    f["month_sin"], f["month_cos"] = f"sin({m})", f"cos({m})"
    f["week_sin"], f["week_cos"] = f"sin({wk})", f"cos({wk})"
    return {k: f"CAST({v} AS DOUBLE)" for k, v in f.items()}


TRIG = ("month_sin", "month_cos", "week_sin", "week_cos")
TRIG_DIGITS = 9


def feature_ctes() -> str:
    from hebdo.operators.features import FEATURES
    fs = feature_sql()
    cols = ",\n  ".join(f"{fs[n]} AS {n}" for n in FEATURES)
    return f"""
wh AS (SELECT *, {_HIST} AS _hist FROM weekly),
feat AS (SELECT segment, week, weekly_revenue, active_customers, invoice_count, average_invoice,
  weekly_payments, average_payment, payment_count, new_customers,
  {cols}
  FROM wh),
ready AS (SELECT segment, week, weekly_revenue, {', '.join(FEATURES)} FROM feat
  WHERE {' AND '.join(f'{n} IS NOT NULL' for n in ['weekly_revenue'] + FEATURES)})
"""


def out_cols(names) -> str:
    return ", ".join(rnd(n, TRIG_DIGITS) + f" AS {n}" if n in TRIG else n for n in names)


def _register_features():
    from hebdo.operators import features as fe
    groups = {
        "features_revenue": [c for c in fe.REVENUE_FEATURES if c not in fe.EMA_SPANS],
        "features_ema": list(fe.EMA_SPANS),
        "features_customer": fe.CUSTOMER_FEATURES,
        "features_invoice": fe.INVOICE_FEATURES,
        "features_payment": fe.PAYMENT_FEATURES,
        "features_calendar": fe.CALENDAR_FEATURES,
    }
    for name, cols in groups.items():
        register(name, with_ledger(f"SELECT segment, week, {out_cols(cols)} FROM feat",
                                   feature_ctes()))
    register("model_ready", with_ledger(
        f"SELECT segment, week, weekly_revenue, {out_cols(fe.FEATURES)} FROM ready", feature_ctes()))
    register("feature_summary", with_ledger(f"""
SELECT segment, count(*) AS rows, CAST(40 AS BIGINT) AS columns, CAST(38 AS BIGINT) AS features,
       {rnd('avg(weekly_revenue)', 4)} AS mean_revenue,
       {rnd('stddev_samp(weekly_revenue)', 4)} AS std_revenue,
       min(week) AS first_week, max(week) AS last_week
FROM ready GROUP BY segment""", feature_ctes()))
    return groups


FEATURE_GROUPS = _register_features()


# ---------------------------------------------------------------- checks, ledger
def _checks(table: str, unique: list[str], non_negative=(), not_null=(), finite=(),
            numeric=(), extra: dict[str, str] | None = None) -> str:
    parts = [f"SELECT 'non_empty' AS rule, CAST(count(*) = 0 AS BIGINT) AS violations FROM {table}"]
    for c in non_negative:
        parts.append(f"SELECT 'non_negative:{c}', CAST(count_if({c} < 0) AS BIGINT) FROM {table}")
    for c in not_null:
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if c in numeric else "")
        parts.append(f"SELECT 'not_null:{c}', CAST(count_if({cond}) AS BIGINT) FROM {table}")
    for c in finite:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT 'finite:{c}', CAST(count_if(isnan({x}) OR abs({x}) = "
                     f"CAST('inf' AS DOUBLE)) AS BIGINT) FROM {table}")
    for name, cond in (extra or {}).items():
        parts.append(f"SELECT '{name}', CAST(count_if({cond}) AS BIGINT) FROM {table}")
    u = ", ".join(unique)
    parts.append(f"SELECT 'unique:{','.join(unique)}', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
                 f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {u} HAVING count(*) > 1)")
    return "\nUNION ALL ".join(parts)


def _register_checks():
    from hebdo.operators.features import FEATURES
    inv = _checks("settled", ["invoice_id"], extra={"positive_total": "total <= 0",
                                                    "paid_le_total": "amount_paid > total"})
    settled = f"""settled AS (
  SELECT i.*, CAST(coalesce(p.pc, 0) AS DOUBLE) / 100 AS amount_paid FROM inv i
  LEFT JOIN (SELECT invoice_id, sum({cents('amount')}) AS pc FROM pay GROUP BY 1) p ON p.invoice_id = i.invoice_id)"""
    pay = _checks("pay", ["payment_id"])
    cus = _checks("cust", ["customer_id"])
    register("checks_ledger", with_ledger(
        f"SELECT 'invoices' AS \"table\", * FROM ({inv})\n"
        f"UNION ALL SELECT 'payments', * FROM ({pay})\n"
        f"UNION ALL SELECT 'customers', * FROM ({cus})", settled))
    register("checks_weekly", with_ledger(_checks("weekly", ["segment", "week"], non_negative=(
        "weekly_revenue", "weekly_payments", "invoice_count", "payment_count",
        "new_customers", "active_customers"))))
    cols = ["week", "weekly_revenue"] + FEATURES
    num = cols[1:]
    register("checks_features", with_ledger(
        _checks("ready", ["segment", "week"], not_null=cols, finite=num, numeric=num),
        feature_ctes()))


_register_checks()

register("invoice_settlement", with_ledger(f"""
SELECT i.invoice_id, i.customer_id, i.date, i.due_date, i.total,
       CAST(coalesce(p.pc, 0) AS DOUBLE) / 100 AS amount_paid,
       CAST(greatest(coalesce(p.pc, 0) - {cents('i.total')}, 0) AS DOUBLE) / 100 AS overpaid,
       coalesce(p.pc, 0) >= {cents('i.total')} AS paid_in_full,
       CASE WHEN coalesce(p.pc, 0) >= {cents('i.total')} THEN 'Paid'
            WHEN coalesce(p.pc, 0) > 0 THEN 'Partially Paid'
            WHEN i.due_date < (SELECT max(date) FROM pay) THEN 'Overdue'
            ELSE 'Open' END AS status
FROM inv i LEFT JOIN (SELECT invoice_id, sum({cents('amount')}) AS pc FROM pay GROUP BY 1) p
  ON p.invoice_id = i.invoice_id"""))

register("ledger_summary", with_ledger(f"""
SELECT 'customers' AS metric, {rnd('CAST(count(*) AS DOUBLE)', 6)} AS value FROM cust
UNION ALL SELECT 'active_customers', {rnd("CAST(count_if(status = 'active') AS DOUBLE)", 6)} FROM cust
UNION ALL SELECT 'inactive_customers', {rnd("CAST(count_if(status = 'inactive') AS DOUBLE)", 6)} FROM cust
UNION ALL SELECT 'invoices', {rnd('CAST(count(*) AS DOUBLE)', 6)} FROM inv
UNION ALL SELECT 'mean_invoice', {rnd(f"CAST(sum({cents('total')}) AS DOUBLE) / 100 / count(total)", 6)} FROM inv
UNION ALL SELECT 'payments', {rnd('CAST(count(*) AS DOUBLE)', 6)} FROM pay
UNION ALL SELECT 'mean_payment', {rnd(f"CAST(sum({cents('amount')}) AS DOUBLE) / 100 / count(amount)", 6)} FROM pay"""))


# ---------------------------------------------------------------- folds, models, evaluation
_P = "PARTITION BY segment"
_CONF = dbl(0.95)
_EPS = dbl(2.220446049250313e-16)

MODEL_CTES = f"""
split AS (SELECT *, CASE WHEN row_number() OVER ({_P} ORDER BY week DESC) <= 12
                     THEN 'test' ELSE 'train' END AS role FROM ready),
coef AS (SELECT segment, regr_slope(weekly_revenue, lag_1) AS slope,
                regr_intercept(weekly_revenue, lag_1) AS intercept
         FROM split WHERE role = 'train' GROUP BY segment),
ar1 AS (SELECT s.segment, s.week, s.role, s.weekly_revenue AS actual,
               c.intercept + c.slope * s.lag_1 AS predicted
        FROM split s JOIN coef c ON c.segment = s.segment),
test AS (SELECT segment, week, actual, predicted FROM ar1 WHERE role = 'test'),
wfbase AS (SELECT segment, week, weekly_revenue, lag_1,
        row_number() OVER ({_P} ORDER BY week) - 1 AS idx,
        regr_slope(weekly_revenue, lag_1) OVER ({_P} ORDER BY week
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS slope,
        regr_intercept(weekly_revenue, lag_1) OVER ({_P} ORDER BY week
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS intercept
        FROM ready),
wf AS (SELECT segment, week, weekly_revenue AS actual, intercept + slope * lag_1 AS predicted
       FROM wfbase WHERE idx >= 104)
"""


def quantile_of(table: str) -> str:
    return f"""(SELECT segment, n, abs_error AS quantile FROM (
    SELECT segment, abs(actual - predicted) AS abs_error,
           row_number() OVER ({_P} ORDER BY abs(actual - predicted)) - 1 AS pos,
           count(*) OVER ({_P}) AS n FROM {table})
  WHERE pos = ceil({_CONF} * (n - 1)))"""


def metric_cols() -> str:
    e = "(actual - predicted)"
    return (f"count(*) AS n, {rnd(f'avg(abs({e}))', 2)} AS mae, "
            f"{rnd(f'sqrt(avg({e} * {e}))', 2)} AS rmse, "
            f"{significant(f'avg(abs({e}) / greatest(abs(actual), {_EPS})) * 100')} AS mape")


def _model(body: str) -> str:
    return with_ledger(body, feature_ctes() + "," + MODEL_CTES)


def clip(x: str) -> str:
    return f"least(greatest({x}, 0.0), 100.0)"


def stability_sql(table: str) -> str:
    ae = "abs(actual - predicted)"
    stab = rnd(clip(f"100 / (1 + stddev_pop({ae}) / greatest(avg({ae}), 1.0))"), 2)
    return f"SELECT segment, {stab} AS model_stability, {stab} < 75 AS drift_detected FROM {table} GROUP BY segment"


def confidence_sql(q: str, mean: str) -> str:
    return rnd(clip(f"(1 - {q} / greatest({mean}, 1.0)) * 100"), 2)


register("holdout_split", _model("SELECT segment, week, role FROM split"))
register("expanding_folds", _model(f"""
SELECT segment, week, fold, role FROM (
  SELECT segment, week, fold,
         CASE WHEN idx < n - (5 - fold) * (n // 6) THEN 'train'
              WHEN idx < n - (5 - fold) * (n // 6) + n // 6 THEN 'test' END AS role
  FROM (SELECT segment, week, row_number() OVER ({_P} ORDER BY week) - 1 AS idx,
               count(*) OVER ({_P}) AS n FROM split WHERE role = 'train') t,
       range(5) f(fold))
WHERE role IS NOT NULL"""))
register("walk_forward_origins", _model(
    f"SELECT segment, week, idx AS train_size FROM wfbase WHERE idx >= 104"))
register("calibration_tail", _model(f"""
SELECT segment, week, CASE WHEN row_number() OVER ({_P} ORDER BY week DESC) <= 20
                      THEN 'calibration' ELSE 'fit' END AS role
FROM split WHERE role = 'train'"""))
register("ar1_holdout", _model(f"SELECT segment, week, role, actual, {rnd('predicted', 2)} AS predicted FROM ar1"))
register("ar1_walk_forward", _model(f"SELECT segment, week, actual, {rnd('predicted', 2)} AS predicted FROM wf"))
register("metrics", _model(f"SELECT segment, {metric_cols()} FROM test GROUP BY segment"))
register("train_test_metrics", _model(f"SELECT segment, role, {metric_cols()} FROM ar1 GROUP BY segment, role"))
register("residuals", _model(f"SELECT segment, week, {rnd('abs(actual - predicted)', 2)} AS abs_error FROM test"))
register("signed_error", _model(f"SELECT segment, week, {rnd('actual - predicted', 2)} AS error FROM test"))
register("conformal_quantile", _model(f"SELECT segment, n, {rnd('quantile', 2)} AS quantile FROM {quantile_of('test')}"))
register("interval_constant", _model(f"""
SELECT t.segment, t.week, {rnd('t.predicted', 2)} AS predicted,
       {rnd('t.predicted - q.quantile', 2)} AS lower_bound, {rnd('t.predicted + q.quantile', 2)} AS upper_bound
FROM test t JOIN {quantile_of('test')} q ON q.segment = t.segment"""))
register("interval_horizon", _model(f"""
SELECT segment, week, step, {rnd('predicted - quantile * sqrt(CAST(step AS DOUBLE))', 2)} AS lower_bound,
       {rnd('predicted + quantile * sqrt(CAST(step AS DOUBLE))', 2)} AS upper_bound
FROM (SELECT t.*, q.quantile, row_number() OVER (PARTITION BY t.segment ORDER BY t.week) AS step
      FROM test t JOIN {quantile_of('test')} q ON q.segment = t.segment)"""))
register("interval_coverage", _model(f"""
SELECT t.segment, CAST(count_if(t.actual >= t.predicted - q.quantile AND t.actual <= t.predicted + q.quantile) AS BIGINT) AS covered,
       count(*) AS n
FROM test t JOIN {quantile_of('test')} q ON q.segment = t.segment GROUP BY t.segment"""))
register("forecast_confidence", _model(f"""
SELECT m.segment, {confidence_sql('q.quantile', 'm.mp')} AS forecast_confidence
FROM (SELECT segment, avg(predicted) AS mp FROM test GROUP BY segment) m
JOIN {quantile_of('test')} q ON q.segment = m.segment"""))
register("model_stability", _model(stability_sql("test")))
register("drift_flag", _model(f"SELECT segment, drift_detected FROM ({stability_sql('wf')})"))
register("health_summary", _model(f"""
SELECT l.segment, l.week, {rnd('l.forecast', 2)} AS forecast,
       {rnd('l.forecast - q.quantile', 2)} AS lower_bound, {rnd('l.forecast + q.quantile', 2)} AS upper_bound,
       {confidence_sql('q.quantile', 'l.mp')} AS forecast_confidence, s.model_stability, s.drift_detected
FROM (SELECT segment, max_by(predicted, week) AS forecast, max(week) AS week, avg(predicted) AS mp
      FROM wf GROUP BY segment) l
JOIN {quantile_of('wf')} q ON q.segment = l.segment
JOIN ({stability_sql('wf')}) s ON s.segment = l.segment"""))
register("rolling_rmse_band", _model(f"""
SELECT segment, week, {rnd('r', 2)} AS rolling_rmse, {rnd('predicted - r', 2)} AS lower_bound,
       {rnd('predicted + r', 2)} AS upper_bound
FROM (SELECT *, first_value(r0 IGNORE NULLS) OVER ({_P} ORDER BY week
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r
      FROM (SELECT *, CASE WHEN count(e2) OVER pw >= 4 THEN sqrt(avg(e2) OVER pw) END AS r0
            FROM (SELECT *, (actual - predicted) * (actual - predicted) AS e2 FROM wf)
            WINDOW pw AS ({_P} ORDER BY week ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)))"""))
register("walk_forward_summary", _model(
    f"SELECT segment, min(week) AS first_week, max(week) AS last_week, {metric_cols()} FROM wf GROUP BY segment"))

_GRID = "[" + ", ".join(dbl(round(0.05 * i, 2)) for i in range(1, 20)) + "]"
SES_CTES = f"""
sesv AS (SELECT segment, max(week) AS last_week, list(weekly_revenue ORDER BY week) AS v
         FROM split WHERE role = 'train' GROUP BY segment),
sesg AS (SELECT segment, last_week, len(v) AS n, alpha,
           list_reduce(list_slice(v, 2, len(v)),
             lambda acc, x: {{'level': acc.level * (1 - alpha) + x * alpha,
                              'sse': acc.sse + (x - acc.level) * (x - acc.level)}},
             {{'level': v[1], 'sse': CAST(0.0 AS DOUBLE)}}) AS f
         FROM sesv, unnest({_GRID}) g(alpha)),
ses AS (SELECT segment, first(n) AS n, first(last_week) AS last_week,
               min_by(alpha, f.sse) AS alpha, min_by(f.level, f.sse) AS level, min(f.sse) AS sse
        FROM sesg GROUP BY segment)
"""
register("ses_forecast", with_ledger("SELECT segment, n, last_week, alpha, level, sse FROM ses",
                                     feature_ctes() + "," + MODEL_CTES + "," + SES_CTES))
register("ses_holdout", with_ledger("""
SELECT s.segment, s.week, s.weekly_revenue AS actual, e.level AS predicted
FROM split s JOIN ses e ON e.segment = s.segment WHERE s.role = 'test'""",
                                    feature_ctes() + "," + MODEL_CTES + "," + SES_CTES))
# ---------------------------------------------------------------- forecasting, reporting
def _business():
    from hebdo.operators.forecast import BUSINESS
    return BUSINESS


_ZERO = "CAST(0.0 AS DOUBLE)"


def l_tail(h: str, k: int) -> str:
    return f"list_slice({h}, greatest(len({h}) - {k} + 1, 1), len({h}))"


def l_sum(t: str) -> str:
    return f"list_reduce({t}, lambda acc, x: acc + x, {_ZERO})"


def l_mean(h: str, k: int) -> str:
    t = l_tail(h, k)
    return f"(CASE WHEN len({t}) > 0 THEN {l_sum(t)} / len({t}) END)"


def l_std(h: str, k: int) -> str:
    t = l_tail(h, k)
    m = f"({l_sum(t)} / len({t}))"
    ss = f"list_reduce({t}, lambda acc, x: acc + (x - {m}) * (x - {m}), {_ZERO})"
    return f"(CASE WHEN len({t}) > 1 THEN sqrt({ss} / (len({t}) - 1)) END)"


def l_safe_lag(h: str, k: int) -> str:
    return f"{h}[len({h}) - least({k}, len({h})) + 1]"


def l_wavg(h: str, window: int = 8) -> str:
    t = l_tail(h, window)
    num = (f"list_reduce(list_transform(range(1, len({t}) + 1), lambda i: {t}[i] * CAST(i AS DOUBLE)), "
           f"lambda acc, v: acc + v, {_ZERO})")
    return f"(CASE WHEN len({t}) > 0 THEN {num} / (len({t}) * (len({t}) + 1) / 2) ELSE {_ZERO} END)"


def state_cte() -> str:
    hs = ", ".join(f"list({c} ORDER BY week) AS h_{c}" for c in ["weekly_revenue"] + _business())
    return f"st AS (SELECT segment, max(week) AS week, {hs} FROM ready GROUP BY segment)"


def step_feature_sql() -> dict[str, str]:
    h = "h_weekly_revenue"
    f: dict[str, str] = {}
    for k in (1, 2, 4, 8, 12, 26):
        f[f"lag_{k}"] = l_safe_lag(h, k)
    for k in (4, 8, 12):
        f[f"rolling_mean_{k}"] = l_mean(h, k)
        f[f"rolling_std_{k}"] = l_std(h, k)
    f["ema_4"], f["ema_12"] = ema(h, 4), ema(h, 12)
    f["revenue_vs_4w_avg"] = div(f["lag_1"], f["rolling_mean_4"])
    f["revenue_vs_8w_avg"] = div(f["lag_1"], f["rolling_mean_8"])
    f["revenue_growth_4w"] = f"({div(f['lag_1'], f['lag_4'])} - 1)"
    f["revenue_acceleration"] = f"({f['lag_1']} - {f['lag_2']})"
    f["revenue_deviation"] = f"({f['lag_1']} - {f['rolling_mean_12']})"
    f["rolling_cv_4"] = div(f["rolling_std_4"], f["rolling_mean_4"])
    for c in _business():
        f[c] = l_wavg(f"h_{c}")
    nw = "CAST(week + INTERVAL 7 DAY AS DATE)"
    two_pi = dbl(2 * _math.pi)
    m = f"({two_pi} * month({nw}) / {dbl(12.0)})"
    wk = f"({two_pi} * weekofyear({nw}) / {dbl(52.0)})"
    f["month_sin"], f["month_cos"] = f"sin({m})", f"cos({m})"
    f["week_sin"], f["week_cos"] = f"sin({wk})", f"cos({wk})"
    return {k: f"CAST({v} AS DOUBLE)" for k, v in f.items()}


def _fc(body: str, extra: str = "") -> str:
    ctes = feature_ctes() + "," + MODEL_CTES + "," + SES_CTES + "," + state_cte()
    if extra:
        ctes += "," + extra
    return with_ledger(body, ctes)


register("next_week", _fc("SELECT segment, week AS last_week, CAST(week + INTERVAL 7 DAY AS DATE) AS next_week FROM st"))
_TD = "CAST(week + INTERVAL 2 MONTH AS DATE)"
register("target_month", _fc(f"""
SELECT segment, week AS last_week, {_TD} AS target_date, CAST(month({_TD}) AS INTEGER) AS target_month,
       CAST(year({_TD}) AS INTEGER) AS target_year FROM st"""))
register("forecast_horizon", _fc(f"""
SELECT segment, week AS last_week, 26 AS horizon_weeks,
       greatest(1, CAST(floor(date_diff('day', week, last_day(make_date(year({_TD}), month({_TD}), 1))) / 7)
                        AS INTEGER)) AS horizon_to_month FROM st"""))
register("weighted_recent_avg", _fc(
    "SELECT segment, " + ", ".join(f"{l_wavg('h_' + c)} AS {c}" for c in _business()) + " FROM st"))
register("safe_lag", _fc(
    "SELECT segment, " + ", ".join(f"{l_safe_lag('h_weekly_revenue', k)} AS lag_{k}"
                                   for k in (1, 2, 4, 8, 12, 26)) + " FROM st"))


def _register_next_week_features():
    from hebdo.operators.features import FEATURES
    fs = step_feature_sql()
    inner = ", ".join(f"{fs[n]} AS {n}" for n in FEATURES)
    register("next_week_features", _fc(
        f"SELECT segment, week, {out_cols(FEATURES)} FROM "
        f"(SELECT segment, CAST(week + INTERVAL 7 DAY AS DATE) AS week, {inner} FROM st)"))


_register_next_week_features()

SES_FORECAST_CTES = f"""
sesva AS (SELECT segment, max(week) AS last_week, list(weekly_revenue ORDER BY week) AS v
          FROM ready GROUP BY segment),
sesga AS (SELECT segment, last_week, alpha,
           list_reduce(list_slice(v, 2, len(v)),
             lambda acc, x: {{'level': acc.level * (1 - alpha) + x * alpha,
                              'sse': acc.sse + (x - acc.level) * (x - acc.level)}},
             {{'level': v[1], 'sse': CAST(0.0 AS DOUBLE)}}) AS f
         FROM sesva, unnest({_GRID}) g(alpha)),
sesa AS (SELECT segment, first(last_week) AS last_week, min_by(f.level, f.sse) AS level
         FROM sesga GROUP BY segment),
seshold AS (SELECT s.segment, s.week, s.weekly_revenue AS actual, e.level AS predicted
            FROM split s JOIN ses e ON e.segment = s.segment WHERE s.role = 'test'),
fcast AS (
  SELECT a.segment, CAST(a.last_week + CAST(g.step * 7 AS INTEGER) AS DATE) AS week, g.step,
         a.level AS predicted,
         a.level - q.quantile * sqrt(CAST(g.step AS DOUBLE)) AS lower_bound,
         a.level + q.quantile * sqrt(CAST(g.step AS DOUBLE)) AS upper_bound,
         CAST(95.0 AS DOUBLE) AS confidence
  FROM sesa a JOIN {quantile_of('seshold')} q ON q.segment = a.segment,
       (SELECT unnest(range(1, 27)) AS step) g)
"""
_F2 = ", ".join(rnd(c, 2) + f" AS {c}" for c in ("predicted", "lower_bound", "upper_bound"))
register("forecast_ses", _fc(f"""
SELECT segment, week, step, {_F2}, confidence, {rnd('upper_bound', 2)} AS best_case,
       {rnd('lower_bound', 2)} AS worst_case FROM fcast""", SES_FORECAST_CTES))
register("forecast_summary", _fc(f"""
SELECT segment, count(*) AS weeks, min(week) AS start_week, max(week) AS end_week,
       {rnd('max_by(predicted, week)', 2)} AS final_value, {rnd('max_by(lower_bound, week)', 2)} AS final_lower,
       {rnd('max_by(upper_bound, week)', 2)} AS final_upper
FROM fcast GROUP BY segment""", SES_FORECAST_CTES))
_GROWTH = """(SELECT c.segment, c.current, f.future, (f.future - c.current) / nullif(c.current, 0) * 100 AS growth_pct
  FROM (SELECT segment, max_by(weekly_revenue, week) AS current FROM ready GROUP BY segment) c
  JOIN (SELECT segment, max_by(predicted, week) AS future FROM fcast GROUP BY segment) f
    ON f.segment = c.segment)"""
register("growth", _fc(f"""
SELECT segment, {rnd('current', 6)} AS current, {rnd('future', 6)} AS future,
       {rnd('growth_pct', 6)} AS growth_pct FROM {_GROWTH}""", SES_FORECAST_CTES))
register("chart_series", _fc(f"""
SELECT segment, week, {rnd('weekly_revenue', 2)} AS value, 'history' AS series,
       CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound FROM ready
UNION ALL
SELECT segment, max(week), {rnd('max_by(weekly_revenue, week)', 2)}, 'forecast', NULL, NULL
FROM ready GROUP BY segment
UNION ALL
SELECT segment, week, {rnd('predicted', 2)}, 'forecast', {rnd('lower_bound', 2)}, {rnd('upper_bound', 2)}
FROM fcast""", SES_FORECAST_CTES))


def money_label(x: str) -> str:
    return f"('₹' || format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT)))"


register("display_table", _fc(f"""
SELECT segment, week, strftime(week, '%d %b %Y') AS week_label, {money_label('predicted')} AS revenue_label
FROM fcast""", SES_FORECAST_CTES))
register("kpi_row", _fc(f"""
SELECT segment, {money_label('current')} AS current_label, {money_label('future')} AS forecast_label,
       printf('%.2f', growth_pct) || '%' AS growth_label, '95%' AS confidence_label
FROM {_GROWTH}""", SES_FORECAST_CTES))


# ---------------------------------------------------------------- single global series (keys=[])
def _register_total():
    from hebdo.operators.features import FEATURES
    from hebdo.operators.weekly import METRIC_COLUMNS
    register("weekly_metrics_total", with_ledger(
        f"SELECT week, {', '.join(METRIC_COLUMNS)} FROM weekly", total=True))
    register("model_ready_total", with_ledger(
        f"SELECT week, weekly_revenue, {out_cols(FEATURES)} FROM ready", feature_ctes(), total=True))
    register("ar1_walk_forward_total", with_ledger(
        f"SELECT week, actual, {rnd('predicted', 2)} AS predicted FROM wf",
        feature_ctes() + "," + MODEL_CTES, total=True))


_register_total()

register("interval_prior", _model(f"""
SELECT t.segment, t.week, {rnd('t.predicted', 2)} AS predicted,
       {rnd('t.predicted - q.quantile', 2)} AS lower_bound, {rnd('t.predicted + q.quantile', 2)} AS upper_bound
FROM test t LEFT JOIN {quantile_of('''(SELECT w.* FROM wf w JOIN (SELECT segment, min(week) AS first_week FROM test
                                  GROUP BY segment) f ON f.segment = w.segment WHERE w.week < f.first_week)''')} q
  ON q.segment = t.segment"""))


# ---------------------------------------------------------------- 25 series keyed by nation
def _register_nation():
    from hebdo.operators.features import FEATURES
    from hebdo.operators.weekly import METRIC_COLUMNS
    register("weekly_metrics_by_nation", with_ledger(
        f"SELECT segment AS nation, week, {', '.join(METRIC_COLUMNS)} FROM weekly", series="nation"))
    register("model_ready_by_nation", with_ledger(
        f"SELECT segment AS nation, week, weekly_revenue, {out_cols(FEATURES)} FROM ready",
        feature_ctes(), series="nation"))


_register_nation()

register("forecast_ar1", _fc(f"""
SELECT segment, week, step, {_F2}, confidence, {rnd('upper_bound', 2)} AS best_case,
       {rnd('lower_bound', 2)} AS worst_case
FROM (
  SELECT l.segment, CAST(l.last_week + CAST(g.step * 7 AS INTEGER) AS DATE) AS week, g.step,
         v.predicted,
         v.predicted - q.quantile * sqrt(CAST(g.step AS DOUBLE)) AS lower_bound,
         v.predicted + q.quantile * sqrt(CAST(g.step AS DOUBLE)) AS upper_bound,
         CAST(95.0 AS DOUBLE) AS confidence
  FROM (SELECT segment, max(week) AS last_week, max_by(weekly_revenue, week) AS last_value,
               regr_slope(weekly_revenue, lag_1) AS slope, regr_intercept(weekly_revenue, lag_1) AS intercept
        FROM ready GROUP BY segment) l
  JOIN {quantile_of('test')} q ON q.segment = l.segment,
  (SELECT unnest(range(1, 27)) AS step) g,
  LATERAL (SELECT list_reduce(range(1, g.step + 1), lambda acc, i: l.intercept + l.slope * acc,
                              l.last_value) AS predicted) v)"""))


# ---------------------------------------------------------------- AR(p) and Dickey-Fuller with a lag, in closed form
def _calendar_lag(c: str, i: int) -> str:
    return f"CASE WHEN week - lag(week, {i}) OVER w = {7 * i} THEN lag({c}, {i}) OVER w END"


_NOISE = dbl(1e-12)


def _ar_ctes(name: str, source: str) -> str:
    """{name}_best: order, coefficients and last values of each series of ``source``."""
    lags = ", ".join(f"{_calendar_lag(f'z{d}', i)} AS z{d}_l{i}" for d in (0, 1) for i in (1, 2))
    there = " AND ".join(f"{c} IS NOT NULL" for c in ("z1", "z0_l1", "z0_l2", "z1_l1", "z1_l2"))
    sample = " UNION ALL ".join(
        f"SELECT segment, {d} AS d, z{d} AS t, z{d}_l1 AS x1, z{d}_l2 AS x2 FROM {name}_lags WHERE {there}" for d in (0, 1))
    zero = dbl(0)
    det = "(v1 * v2 - c12 * c12)"
    models = f"""
SELECT *, 0 AS p, {zero} AS b1, {zero} AS b2 FROM {name}_moments WHERE n > 1
UNION ALL SELECT *, 1 AS p, c1 / v1 AS b1, {zero} AS b2 FROM {name}_moments WHERE n > 2 AND v1 > 0
UNION ALL SELECT *, 2 AS p, (c1 * v2 - c2 * c12) / {det} AS b1, (c2 * v1 - c1 * c12) / {det} AS b2
FROM {name}_moments WHERE n > 3 AND v1 > 0 AND v2 > 0 AND {det} > {_NOISE} * v1 * v2"""
    return f"""
{name}_diffs AS (SELECT segment, week, weekly_revenue AS z0, weekly_revenue - {_calendar_lag('weekly_revenue', 1)} AS z1
  FROM {source} WINDOW w AS (PARTITION BY segment ORDER BY week)),
{name}_lags AS (SELECT *, {lags} FROM {name}_diffs WINDOW w AS (PARTITION BY segment ORDER BY week)),
{name}_sample AS ({sample}),
{name}_moments AS (SELECT segment, d, count(*) AS n, avg(t) AS mt, avg(x1) AS m1, avg(x2) AS m2, var_pop(t) AS vt,
  var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS c12, covar_pop(x1, t) AS c1, covar_pop(x2, t) AS c2
  FROM {name}_sample GROUP BY segment, d),
{name}_models AS ({models}),
{name}_scored AS (SELECT *, n * ln(greatest(n * greatest(vt - b1 * c1 - b2 * c2, {_NOISE} * vt), {dbl(1e-12)}) / n) + 2 * (p + 1) AS aic,
  mt - b1 * m1 - b2 * m2 AS b0 FROM {name}_models),
{name}_last AS (SELECT segment, week AS last_week, z0, z0_l1, z1, z1_l1 FROM {name}_lags
  QUALIFY row_number() OVER (PARTITION BY segment ORDER BY week DESC) = 1),
{name}_best AS (SELECT s.* EXCLUDE (segment), l.segment, l.last_week, l.z0 AS level, CASE WHEN d = 0 THEN l.z0 ELSE l.z1 END AS r1,
    CASE WHEN d = 0 THEN l.z0_l1 ELSE l.z1_l1 END AS r2
  FROM {name}_last l LEFT JOIN (
    SELECT * FROM {name}_scored QUALIFY row_number() OVER (PARTITION BY segment ORDER BY aic, d, p) = 1) s
  ON l.segment = s.segment)"""


def _ar_path(name: str, steps: int | str) -> str:
    z = "(b0 + CASE WHEN p >= 1 THEN b1 * r1 ELSE 0 END + CASE WHEN p >= 2 THEN b2 * r2 ELSE 0 END)"
    return f"""(WITH RECURSIVE path AS (
  SELECT segment, d, p, last_week, b0, b1, b2, r1, r2, level, CAST(0 AS BIGINT) AS step FROM {name}_best
  UNION ALL
  SELECT segment, d, p, last_week, b0, b1, b2, {z}, r1,
         CASE WHEN d = 0 THEN 0 ELSE level END + {z}, step + 1 FROM path WHERE step < {steps})
 SELECT segment, CAST(last_week + CAST(step * 7 AS INTEGER) AS DATE) AS week, step, level AS predicted
 FROM path WHERE step > 0)"""


# weeks of the whole calendar: the holdout weeks of a gappy series may reach far
_SPAN = "(SELECT (max(week) - min(week)) // 7 FROM split)"
_AR_TRAIN = _ar_ctes("train_ar", "(SELECT * FROM split WHERE role = 'train')")
_AR_TEST = f"""artest AS (SELECT s.segment, s.week, s.weekly_revenue AS actual, f.predicted
  FROM split s LEFT JOIN {_ar_path('train_ar', _SPAN)} f ON f.segment = s.segment AND f.week = s.week WHERE s.role = 'test')"""

register("ar_order_selection", with_ledger(f"""
SELECT segment, d, p, n, {rnd('aic', 6)} AS aic, {rnd('b0', 2)} AS intercept, {rnd('b1', 9)} AS phi_1, {rnd('b2', 9)} AS phi_2
FROM ar_best WHERE p IS NOT NULL""", feature_ctes() + "," + MODEL_CTES + "," + _ar_ctes("ar", "ready")))
register("ar_holdout", with_ledger(
    f"SELECT segment, week, actual, {rnd('predicted', 2)} AS predicted FROM artest",
    feature_ctes() + "," + MODEL_CTES + "," + _AR_TRAIN + "," + _AR_TEST))
register("forecast_ar", with_ledger(f"""
SELECT segment, week, step, {_F2}, confidence, {rnd('upper_bound', 2)} AS best_case,
       {rnd('lower_bound', 2)} AS worst_case
FROM (
  SELECT f.segment, f.week, f.step, f.predicted,
         f.predicted - q.quantile * sqrt(CAST(f.step AS DOUBLE)) AS lower_bound,
         f.predicted + q.quantile * sqrt(CAST(f.step AS DOUBLE)) AS upper_bound,
         CAST(95.0 AS DOUBLE) AS confidence
  FROM {_ar_path('ar', 26)} f LEFT JOIN {quantile_of('artest')} q ON q.segment = f.segment)""",
    feature_ctes() + "," + MODEL_CTES + "," + _ar_ctes("ar", "ready") + "," + _AR_TRAIN + "," + _AR_TEST))
register("adf_test", _model(f"""
SELECT segment, n, {rnd('gamma', 9)} AS gamma, {rnd('t', 6)} AS t_stat,
       {dbl(-2.86)} AS critical_5pct, t < {dbl(-2.86)} AS stationary
FROM (SELECT *, CASE WHEN vt - gamma * c1 - delta * c2 > {_NOISE} * vt
                     THEN gamma / sqrt((vt - gamma * c1 - delta * c2) / (n - 3) * v2 / det) END AS t FROM (
  SELECT *, (c1 * v2 - c2 * c12) / det AS gamma, (c2 * v1 - c1 * c12) / det AS delta FROM (
    SELECT *, CASE WHEN n > 3 AND v1 > 0 AND v2 > 0 AND v1 * v2 - c12 * c12 > {_NOISE} * v1 * v2
                   THEN v1 * v2 - c12 * c12 END AS det FROM (
      SELECT segment, count(*) AS n, var_pop(dy) AS vt, var_pop(ylag) AS v1, var_pop(dlag) AS v2,
             covar_pop(ylag, dlag) AS c12, covar_pop(ylag, dy) AS c1, covar_pop(dlag, dy) AS c2
      FROM (SELECT segment, dy, ylag, {_calendar_lag('dy', 1)} AS dlag FROM (
              SELECT segment, week, weekly_revenue - {_calendar_lag('weekly_revenue', 1)} AS dy,
                     {_calendar_lag('weekly_revenue', 1)} AS ylag
              FROM ready WINDOW w AS (PARTITION BY segment ORDER BY week))
            WINDOW w AS (PARTITION BY segment ORDER BY week))
      WHERE dy IS NOT NULL AND ylag IS NOT NULL AND dlag IS NOT NULL GROUP BY segment))))"""))

def _horner(z: str, highest_first) -> str:
    out = dbl(highest_first[0])
    for c in highest_first[1:]:
        out = f"({out} * {z} + {dbl(c)})"
    return out


def _normal_cdf(z: str) -> str:
    a = f"abs({z})"
    tail = f"exp(-{a} * {a} / 2)"
    deep = f"{a} + 0.65"
    for k in (4.0, 3.0, 2.0, 1.0):
        deep = f"{a} + {dbl(k)} / ({deep})"
    upper = (f"(CASE WHEN {a} < {dbl(7.07106781186547)} THEN {tail} * {_horner(a, NORMAL_TOP)} / {_horner(a, NORMAL_LOW)} "
             f"ELSE {tail} / ({dbl(2.506628274631)} * ({deep})) END)")
    return f"(CASE WHEN {z} > 0 THEN 1 - {upper} ELSE {upper} END)"


def _adf_moments(name: str, lags: str) -> str:
    """CTEs: covariance matrices times n, with the lag counts k of the table ``lags``, then
    swept one regressor at a time (step = regressors swept)."""
    pivot = "m[step + 1][step + 1]"
    return f"""
{name}_x AS (
  SELECT b.segment, b.week, 0 AS i, b.ylag AS x FROM base b
  UNION ALL SELECT b.segment, b.week, g.i, p.dy FROM base b JOIN {lags} USING (segment)
            JOIN range(1, 200) g(i) ON g.i <= k JOIN base p ON p.segment = b.segment AND p.week = b.week - CAST(7 * g.i AS INTEGER)
  UNION ALL SELECT b.segment, b.week, k + 1, b.dy FROM base b JOIN {lags} USING (segment)),
{name}_v AS (
  SELECT x.* FROM {name}_x x JOIN {lags} USING (segment)
  WHERE true QUALIFY count(*) OVER (PARTITION BY segment, week) = k + 2),
{name}_c AS (
  SELECT a.segment, a.i, b.i AS j, covar_pop(a.x, b.x) * count(*) AS c, count(*) AS n
  FROM {name}_v a JOIN {name}_v b USING (segment, week) GROUP BY ALL),
{name}_m AS (
  SELECT segment, n, list(r ORDER BY i) AS m
  FROM (SELECT segment, i, n, list(c ORDER BY j) AS r FROM {name}_c GROUP BY ALL) GROUP BY segment, n),
{name}_s AS (
  SELECT segment, n, k, 0 AS step, m, m AS start FROM {name}_m JOIN {lags} USING (segment)
  UNION ALL
  SELECT segment, n, k, step + 1, CASE WHEN {pivot} > {_NOISE} * start[step + 1][step + 1] THEN
    list_transform(m, lambda r, i: list_transform(r, lambda v, j:
      CASE WHEN i = step + 1 AND j = step + 1 THEN 1 / {pivot} WHEN i = step + 1 THEN v / {pivot}
           WHEN j = step + 1 THEN -v / {pivot} ELSE v - r[step + 1] * m[step + 1][j] / {pivot} END)) ELSE m END, start
  FROM {name}_s WHERE step <= k)"""


_ADF_T = "CASE WHEN n > k + 2 AND rss > {noise} * tss AND inv > 0 THEN gamma / sqrt(rss / (n - k - 2) * inv) END".format(noise=_NOISE)
register("adf_auto", _model(f"""
SELECT * FROM (WITH RECURSIVE base AS (
  SELECT * FROM (
    SELECT segment, week, weekly_revenue - {_calendar_lag('weekly_revenue', 1)} AS dy, {_calendar_lag('weekly_revenue', 1)} AS ylag
    FROM ready WINDOW w AS (PARTITION BY segment ORDER BY week)) WHERE dy IS NOT NULL),
most AS (
  SELECT segment, CAST(greatest(least(ceil(12.0 * pow(count(*) / 100.0, 0.25)), floor(count(*) / 2.0) - 2), 0) AS INTEGER) AS k
  FROM ready GROUP BY segment),
{_adf_moments("first", "most")},
scored AS (
  SELECT segment, n, step - 1 AS lags, n * ln(greatest(m[k + 2][k + 2], {_NOISE} * start[k + 2][k + 2], {dbl(1e-300)}) / n) + 2 * (step + 1) AS aic
  FROM first_s WHERE step >= 1),
chosen AS (
  SELECT segment, CAST(arg_min(lags, (aic, lags)) AS INTEGER) AS k FROM scored WHERE lags = 0 OR n > lags + 2 GROUP BY segment),
{_adf_moments("again", "chosen")},
done AS (
  SELECT segment, n, k, CASE WHEN n > k + 2 THEN m[1][k + 2] END AS gamma, m[k + 2][k + 2] AS rss, m[1][1] AS inv,
         start[k + 2][k + 2] AS tss
  FROM again_s WHERE step = k + 1),
tested AS (SELECT *, {_ADF_T} AS t FROM done),
judged AS (
  SELECT *, CASE WHEN t > {dbl(TAU_MAX)} THEN 1.0 WHEN t < {dbl(TAU_MIN)} THEN 0.0 WHEN t IS NOT NULL THEN {_normal_cdf('z')} END AS p
  FROM (SELECT *, CASE WHEN t <= {dbl(TAU_STAR)} THEN {_horner('t', TAU_SMALL[::-1])} ELSE {_horner('t', TAU_LARGE[::-1])} END AS z FROM tested))
SELECT segment, CAST(k AS BIGINT) AS lags, n, {rnd('gamma', 9)} AS gamma, {rnd('t', 6)} AS t_stat,
       {rnd('p', 6)} AS p_value, p < 0.05 AS stationary FROM judged)"""))

def _sweeps(name: str, source: str, steps: str) -> str:
    """CTE: the matrices m of ``source`` (segment, m) swept on their first ``steps`` variables, one a step."""
    pivot = "m[step + 1][step + 1]"
    return f"""
{name} AS (
  SELECT segment, 0 AS step, m FROM {source}
  UNION ALL
  SELECT segment, step + 1, list_transform(m, lambda r, i: list_transform(r, lambda v, j:
      CASE WHEN i = step + 1 AND j = step + 1 THEN 1 / {pivot} WHEN i = step + 1 THEN v / {pivot}
           WHEN j = step + 1 THEN -v / {pivot} ELSE v - r[step + 1] * m[step + 1][j] / {pivot} END))
  FROM {name} WHERE step < {steps})"""


_YEAR = 365.25 / 7
_TERMS = ", ".join(f"sin({dbl(k * (2 * math.pi) / _YEAR)} * t), cos({dbl(k * (2 * math.pi) / _YEAR)} * t)" for k in (1, 2, 3))
def _fourier_fit(rows: str) -> str:
    """CTEs: design(segment, week, y, x, first) of ``rows`` and swept(segment, step, m), fitted on its rows of role train."""
    return f"""design AS (
  SELECT segment, week, role, weekly_revenue AS y, first, [{dbl(1.0)}, t / 52.0, {_TERMS}] AS x
  FROM (SELECT *, (week - first) / {dbl(7.0)} AS t
        FROM (SELECT *, min(week) OVER (PARTITION BY segment) AS first FROM {rows}))),
cells AS (
  SELECT segment, i, j, sum(z[i] * z[j]) + CASE WHEN i = j AND i BETWEEN 2 AND 8 THEN 1 ELSE 0 END AS c
  FROM (SELECT segment, list_append(x, y) AS z FROM design WHERE role = 'train'), range(1, 10) a(i), range(1, 10) b(j)
  GROUP BY segment, i, j),
gram AS (
  SELECT segment, list(r ORDER BY i) AS m FROM (SELECT segment, i, list(c ORDER BY j) AS r FROM cells GROUP BY segment, i) GROUP BY segment),
{_sweeps("swept", "gram", "8")}"""


_FOURIER_VALUE = "list_sum(list_transform(range(1, 9), lambda k: m[k][9] * x[k]))"
register("fourier_trend", _model(f"""
SELECT * FROM (WITH RECURSIVE {_fourier_fit("split")}
SELECT d.segment, week AS ds, y, {rnd(_FOURIER_VALUE, 2)} AS yhat, role
FROM design d JOIN swept s ON s.segment = d.segment AND s.step = 8)"""))
register("forecast_model_table", _model(f"""
SELECT segment, 'ses' AS model, week, step, predicted FROM ({ORACLE["forecast_ses"]})
UNION ALL SELECT segment, 'ar', week, step, predicted FROM ({ORACLE["forecast_ar"]})
UNION ALL SELECT * FROM (WITH RECURSIVE {_fourier_fit("(SELECT *, 'train' AS role FROM ready)")},
ahead AS (
  SELECT segment, last, step, (last - first) / {dbl(7.0)} + step AS t
  FROM (SELECT segment, max(week) AS last, min(first) AS first FROM design GROUP BY segment), range(1, 27) r(step))
SELECT a.segment, 'fourier', CAST(last + CAST(7 * a.step AS INTEGER) AS DATE), a.step, {rnd(_FOURIER_VALUE, 2)}
FROM (SELECT *, [{dbl(1.0)}, t / 52.0, {_TERMS}] AS x FROM ahead) a JOIN swept s ON s.segment = a.segment AND s.step = 8)"""))
register("tree_walk_forward_frame", _model(
    "SELECT segment, week, actual, TRUE AS has_prediction FROM wf"))
register("tree_attribution_sums", _model(
    "SELECT segment, week, CAST(38 AS BIGINT) AS features, TRUE AS adds_up FROM split WHERE role = 'test'"))
register("forecast_trees_frame", _model("""
SELECT segment, CAST(last + CAST(7 * step AS INTEGER) AS DATE) AS week, step, TRUE AS enclosed, TRUE AS widens
FROM (SELECT segment, max(week) AS last FROM ready GROUP BY segment), range(1, 27) r(step)"""))
register("df_test", _model(f"""
SELECT segment, n, {rnd('gamma', 9)} AS gamma, {rnd('t', 6)} AS t_stat,
       {dbl(-2.86)} AS critical_5pct, t < {dbl(-2.86)} AS stationary
FROM (SELECT *, CASE WHEN n > 2 AND syy - sxy * sxy / sxx > {_NOISE} * syy
                     THEN gamma / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) END AS t FROM (
  SELECT segment, CAST(regr_count(dy, ylag) AS BIGINT) AS n, regr_slope(dy, ylag) AS gamma, regr_sxx(dy, ylag) AS sxx,
         regr_syy(dy, ylag) AS syy, regr_sxy(dy, ylag) AS sxy
  FROM (SELECT segment, weekly_revenue - {_calendar_lag('weekly_revenue', 1)} AS dy,
               {_calendar_lag('weekly_revenue', 1)} AS ylag
        FROM ready WINDOW w AS (PARTITION BY segment ORDER BY week))
  GROUP BY segment))"""))
