"""Physical-plan properties the scale design relies on (checked on the planned queries)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

# Built from driver-side results (fits, solved models): no single plan to inspect.
MODEL_KEYS = {"als_grid", "ridge_grid", "lasso_grid", "als_factors", "als_rec_ids"}
PLAN_KEYS = sorted(set(entry.queries()) - MODEL_KEYS)


def _plan(spark, key: str) -> str:
    return entry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLAN_KEYS)
def test_no_cartesian_or_nested_loop_join(spark, key):
    plan = _plan(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["artist_top_term", "artist_top2_terms"])
def test_rank_filters_limit_before_the_shuffle(spark, key):
    plan = _plan(spark, key)
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("key", ["popular_items", "downsample_top_n"])
def test_top_n_is_take_ordered(spark, key):
    assert "TakeOrderedAndProject" in _plan(spark, key)


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(spark, "artist_top2_terms")
    assert "ReadSchema: struct<p_name:string,p_brand:string,p_type:string>" in plan  # three of nine columns
    base = _plan(spark, "baseline_eval")
    assert "l_quantity" not in base and "o_orderdate" not in base  # unused columns never read
