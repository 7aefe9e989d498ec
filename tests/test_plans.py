"""Physical plans: pruned and pushed scans, no pair joins, no Python in the plans, limited windows."""

import re

import pytest

from tidemark.plans import REGISTRY
from tidemark.plans.registry import run
from tidemark.sources.fixtures import Tables

SMALL = "/root/testdata/sf0.001"
EAGER = re.compile(r"^(r\d|p[234]_|m1_daily_gmv_refreshed|d13|q02[456]|g7|s09b|q007|q018|q082|v3)")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in REGISTRY if not EAGER.match(n)])
def test_no_pair_joins_and_no_python(spark, name):
    text = plan_of(run(name, spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in text


def test_scan_reads_only_needed_columns_and_pushes_the_filter(spark):
    from tidemark.operators.cost import full_scans

    t = Tables(spark, SMALL)
    text = plan_of(t.orders.where("o_orderstatus = 'F'").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(full_scans(t.query_cost)))
    assert "l_tax" not in scan.group(1) and "l_quantity" not in scan.group(1)


def test_row_limits_reach_the_map_side(spark):
    assert plan_of(run("q001_dedup_latest", spark, SMALL)).count("WindowGroupLimit") == 2
    assert "WindowGroupLimit" in plan_of(run("q049_last_n_array", spark, SMALL))


def test_top_reports_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(run("q090_full_scans", spark, SMALL))


def test_nothing_forces_a_broadcast():
    from pathlib import Path

    for path in Path(__file__).resolve().parents[1].glob("tidemark/**/*.py"):
        if path.parent.name == "llm":
            continue  # broadcasts limits of at most 200 languages
        text = path.read_text()
        assert "broadcast(" not in text and "crossJoin" not in text and "localCheckpoint" not in text, path
