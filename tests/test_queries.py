"""Every registered query against its oracle, and the shape of its plan."""

from __future__ import annotations

import re

import pytest

import parity
from build import executed_nodes
from conftest import MEDIUM, SMALL
from __spark_entry__ import entry
from voidage.catalog import ORACLES, QUERIES



@pytest.fixture(scope="module")
def small():
    con = parity.connect(SMALL)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert len(QUERIES) >= 80
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan
    assert parity.compare(df, small, ORACLES[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def _scans(nodes, column: str) -> int:
    return sum(node.getClass().getSimpleName() == "FileSourceScanExec" and f"{column}#" in node.toString() for node in nodes)


def test_scan_reads_only_what_the_query_needs(spark):
    plan = QUERIES["nested_sum_over"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    (read,) = re.findall(r"ReadSchema: struct<(l_[^>]*)>", plan)
    assert "l_linenumber" not in read and "l_suppkey" in read


@pytest.mark.parametrize("name", ["qualify_top1", "top2", "two_extremes"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rollup_is_grouped_once(spark):
    """The daily lines are read once, and the running totals reuse the shuffle of the grouped rows."""
    nodes = executed_nodes(QUERIES["vrr_view_pair"](spark, MEDIUM))
    assert _scans(nodes, "l_suppkey") == 1
    reused = [node.toString() for node in nodes if node.getClass().getSimpleName() == "ReusedExchangeExec"]
    assert any("__key" in text and " m#" in text for text in reused)


@pytest.mark.parametrize("view", ["vrr_view", "vrr_report", "pvt_lookup"])
def test_no_subquery_in_a_view(spark, view):
    """Interval joins need no dates of the tables, so plans stay small."""
    from build import factor_table, pressure_table, pvt_table, volume_table
    from voidage.plans.pvt import pvt_lookup, requests_by_factor
    from voidage.plans.vrr import vrr_report, vrr_view

    tables = (
        volume_table(spark, [{"ID_PATTERN": "P1", "COMPLETION_ID": "C1", "PROD_DATE": "2020-01-02"}]),
        factor_table(spark, [("P1", "C1", "2020-01-01", 0.5)]),
        pressure_table(spark, [("P1", "2019-01-01", 110.0)]),
    )
    pvt = pvt_table(spark, [("C1", "2019-01-01", 100.0, 2.0)])
    df = {
        "vrr_view": lambda: vrr_view(*tables, pvt),
        "vrr_report": lambda: vrr_report(*tables),
        "pvt_lookup": lambda: pvt_lookup(requests_by_factor(*tables[1:]), pvt),
    }[view]()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "subquery" not in plan and len(plan) < 200_000


@pytest.mark.parametrize("limit", [None, 0, 10**8])
def test_daily_rows_stay_in_place_when_asked(spark, limit):
    """A schedule measured below the limit goes to the daily rows; nothing is forced otherwise."""
    from voidage.plans.vrr import vrr_view
    from voidage.sources.derived import Field

    field = Field(spark, SMALL)
    view = vrr_view(field.volumes, field.factors, field.pressures, field.pvt, broadcast_bytes=limit)
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit == 10**8)


@pytest.mark.parametrize("name", ["vrr_view_pair", "pvt_full_all", "view_over_view", "vrr_view_latest_own_pressure", "vrr_report"])
def test_no_job_while_planning(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"plan-{name}", name)
    try:
        QUERIES[name](spark, SMALL)
        assert list(tracker.getJobIdsForGroup(f"plan-{name}")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["pvt_full_all", "pvt_full_active", "count_threshold"])
def test_narrow_ranges_give_the_same(spark, small, monkeypatch, name):
    from voidage.operators import curves

    monkeypatch.setattr(curves, "RANGE", 60.0)
    assert parity.compare(QUERIES[name](spark, SMALL), small, ORACLES[name]) == []


def test_checks_can_fail(small):
    """The filter of the subquery removes rows, and the tolerance changes answers."""
    count = lambda sql: small.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0]
    from voidage.catalog.oracle import with_tables

    assert 0 < count(ORACLES["in_subquery"]) < count(with_tables("SELECT * FROM daily_volume", "daily_volume"))
    branch = lambda name: dict(small.execute(f"SELECT BRANCH, count(*) FROM ({ORACLES[name]}) GROUP BY 1").fetchall())
    near, plain = branch("pvt_exact_tolerance"), branch("pvt_full_active")
    assert 0 < near["exact"] < plain["exact"]


def _reads(df, column: str) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(rf"Relation \[[^\]]*{column}", plan))


def test_one_bracket_and_two_reads(spark):
    """Branches and second bounds read the bracket once; the own-pressure view reads the daily lines twice."""
    once = _reads(QUERIES["pvt_full_all"](spark, SMALL), "p_partkey")
    assert _reads(QUERIES["union_branches"](spark, SMALL), "p_partkey") == once
    assert _reads(QUERIES["second_bound"](spark, SMALL), "p_partkey") == once
    assert 1 <= _scans(executed_nodes(QUERIES["vrr_view_latest_own_pressure"](spark, SMALL)), "l_suppkey") <= 2


def test_points_are_numbered_and_shuffled_once(spark):
    """The three readers of the points share their shuffles in the executed plan."""
    nodes = executed_nodes(QUERIES["pvt_full_all"](spark, SMALL))
    assert sum(node.getClass().getSimpleName() == "ReusedExchangeExec" for node in nodes) >= 1
    assert _scans(nodes, "p_size") <= 2
