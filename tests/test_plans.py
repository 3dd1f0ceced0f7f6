"""Plan-level guards over every registered query: no cross products or
nested-loop joins, no Python evaluation, no local checkpoints, and column
pruning down to the parquet scan."""
import re

import pytest

from tests.conftest import SF_SMALL
from tickspan.plans.catalog import QUERIES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = _plan(df)
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    # lineitem is read for prices only: the flag and part columns never are
    for schema in re.findall(r"ReadSchema: struct<([^>\n]*)", plan):
        if "l_extendedprice" in schema or "l_shipdate" in schema:
            assert "l_returnflag" not in schema and "l_linestatus" not in schema, f"{name}: {schema}"


def test_no_local_checkpoints_in_library():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "tickspan"
    for p in root.rglob("*.py"):
        assert "localCheckpoint" not in p.read_text(), p


@pytest.mark.parametrize("name", ["period_anchors", "period_definitions"])
def test_anchors_need_no_dedup(spark, name):
    assert "Window" not in _plan(QUERIES[name](spark, SF_SMALL))


def test_a_fold_runs_once(spark):
    """The returned snapshot reads the checkpointed fold, never the log again."""
    plan = QUERIES["watchlist_apply_changes"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "events" not in plan and "FileScan" not in plan


def test_a_benchmark_comparison_reads_the_history_once(spark):
    """What is returned reads the checkpointed returns only; dedup and windows ran once before."""
    plan = _plan(QUERIES["benchmark_cumulative_return"](spark, SF_SMALL))
    assert "FileScan" not in plan and "Window" not in plan


def test_active_mart_drops_other_tickers_before_dedup(spark):
    lines = QUERIES["mart_active_performance"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dedup = max(i for i, x in enumerate(lines) if "WindowGroupLimit" in x or "row_number" in x)
    assert any("LeftSemi" in x for x in lines[dedup:])


@pytest.mark.parametrize("name", ["ticker_history_90d", "ticker_history_all"])
def test_ordering_a_history_does_not_run_its_windows_again(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "rangepartitioning" in plan and "Window" not in plan
