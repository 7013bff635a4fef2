"""Plan-shape guards: what must stay true for the plans to scale."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()
MODEL_FITS = ["ar_order_selection", "fourier_trend", "model_leaderboard"]


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def assert_no_pairwise_join(df) -> None:
    plan = plan_of(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", MODEL_FITS)
def test_model_fit_plans_have_no_pairwise_join(spark, name):
    assert_no_pairwise_join(QUERIES[name](spark, SF_SMALL))


def test_ledger_aggregates_are_partial_before_the_shuffle(spark):
    plan = plan_of(QUERIES["weekly_payments"](spark, SF_SMALL))
    assert "partial_sum" in plan and "partial_count" in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["weekly_metrics"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    cols = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert "l_quantity" not in cols and "l_returnflag" not in cols and "o_orderpriority" not in cols
    assert {"l_extendedprice", "l_discount", "l_shipdate", "o_totalprice"} <= cols
