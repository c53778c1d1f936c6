"""Stored curves: built, refreshed, read."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from build import pvt_table, request_table
from test_curves import brute, field
from voidage.operators import curve_index
from voidage.operators.curve_index import CurveIndex, refresh_index, store_index
from voidage.operators.curves import SIDES, measured
from voidage.plans import sqlapi
from voidage.plans.pvt import pvt_lookup


@pytest.fixture
def name(spark):
    name = f"index_{uuid.uuid4().hex}"
    yield name
    for part in ("tests", "points"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{part}")


def answers(index, requests, scope):
    out = {}
    for r in index.bracket(requests, scope).collect():
        sides = tuple(None if r[s] is None else (r[s].PRESSURE, r[s].TEST_DATE.isoformat()) for s in SIDES)
        out[r.ID_COMPLETION, r.VRR_DATE.isoformat(), r.PRESSURE] = (sides, r.BELOW, r.ABOVE)
    return out


@pytest.mark.parametrize("tests,width", [(5, 500.0), (40, 3.0)])
def test_refreshed_index_is_like_brute_force(spark, name, monkeypatch, tests, width):
    """Increments of later tests, then late tests, points of old tests, new completions and repeated rows."""
    monkeypatch.setattr(curve_index, "CELL_WIDTH", width)
    points, asked = field(tests, completions=4, tests=tests, requests=150, levels=200)
    points.sort(key=lambda p: p[1])
    late = [p for k, p in enumerate(points) if k % 9 == 0]
    rest = [p for k, p in enumerate(points) if k % 9]
    parts = [rest[:80], rest[80:130], rest[130:], late + [("NEW", "2001-01-01", 5.0, 1.0)] + late[:2]]
    known = []
    for k, part in enumerate(parts):
        table = pvt_table(spark, part)
        index = refresh_index(table, name) if k else store_index(table, name, buckets=4)
        known += part
    requests = request_table(spark, asked + [("NEW", "2003-01-01", 4.0)])
    for scope in ("all_to_date", "active"):
        assert answers(index, requests, scope) == brute(known, asked + [("NEW", "2003-01-01", 4.0)], scope)
    count = lambda p: p.groupBy("ID_COMPLETION", "TEST_DATE", "PRESSURE").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, count(index.measured()).collect())) == sorted(map(tuple, count(measured(pvt_table(spark, known))).collect()))


def test_later_tests_add_blocks_only(spark, name):
    """A refresh by later tests leaves every old row in use and reads no other completion's points."""
    points = [("C1", f"20{k:02}-01-01", 100.0 + k, 1.0) for k in range(10, 17)] + [("C2", "2010-01-01", 5.0, 1.0)]
    store_index(pvt_table(spark, points), name, buckets=4)
    index = refresh_index(pvt_table(spark, [("C1", "2017-01-01", 117.0, 1.0)]), name)
    assert {(r.ID_COMPLETION, r.SINCE, r.UNTIL) for r in index.tests.collect()} == {("C1", 0, 1), ("C2", 0, 0)}
    new = {(r.ID_COMPLETION, r.SIZE, r.BLOCK) for r in index.points.filter("GENERATION = 1").collect()}
    # The eighth test ends the only block of eight; smaller blocks that it ends have odd numbers, but its own.
    assert new == {("C1", 0, 7), ("C1", 3, 0)}
    index = refresh_index(pvt_table(spark, [("C1", "2012-06-01", 1.0, 1.0)]), name)
    assert {r.SINCE for r in index.tests.filter("ID_COMPLETION = 'C1'").collect()} == {2}


def test_what_a_failed_refresh_left_is_not_seen(spark, name):
    store_index(pvt_table(spark, [("C1", "2010-01-01", 100.0, 1.0)]), name, buckets=2)
    late = pvt_table(spark, [("C1", "2009-01-01", 90.0, 1.0)])
    _, points = curve_index._refreshed(CurveIndex.load(spark, name), late, 1)
    curve_index._append(points, f"{name}_points", 1)  # and no tests
    ask = request_table(spark, [("C1", "2020-01-01", 95.0)])
    seen = lambda index: [(r.LOWER, r.UPPER.PRESSURE, r.ABOVE) for r in index.bracket(ask).collect()]
    assert seen(CurveIndex.load(spark, name)) == [(None, 100.0, 1)]
    (row,) = refresh_index(late, name).bracket(ask).collect()
    assert (row.LOWER.PRESSURE, row.UPPER.PRESSURE, row.BELOW, row.ABOVE) == (90.0, 100.0, 1, 1)


def test_a_lookup_moves_its_requests_alone(spark, name):
    """No raw points are read, and the stored stretches are joined where their buckets are."""
    points, asked = field(3, completions=4, tests=9, requests=50, levels=100)
    index = store_index(pvt_table(spark, points), name, buckets=4)
    requests = request_table(spark, asked)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pvt_lookup(requests, index)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line and "_points" in line]
    assert "Bucketed: true" in scan
    assert "ExistingRDD" in plan and plan.count("FileScan") == 2
    before_scan = plan.splitlines()[plan.splitlines().index(scan) - 4 : plan.splitlines().index(scan)]
    assert not any("Exchange" in line for line in before_scan)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(pvt_lookup(requests, index)) == rows(pvt_lookup(requests, pvt_table(spark, points)))


def test_empty_index_and_requests_without_keys(spark, name):
    index = store_index(pvt_table(spark, []), name, buckets=2)
    ask = request_table(spark, [("C1", "2020-01-01", 95.0), (None, "2020-01-01", 1.0), ("C1", "2020-01-01", None), ("C1", "2020-01-01", None)])
    assert [r.BRANCH for r in pvt_lookup(ask, index).collect()] == ["none"] * 4
    index = refresh_index(pvt_table(spark, [("C1", "2010-01-01", None, 1.0), ("C1", "2011-01-01", 95.0, 2.0)]), name)
    assert sorted(r.BRANCH for r in pvt_lookup(ask, index).collect()) == ["exact", "none", "none", "none"]


@pytest.mark.parametrize("policy", ["full", "low_only", "low_only_null", "nearest"])
@pytest.mark.parametrize("scope", ["all_to_date", "active"])
def test_table_function_answers_any_arguments(spark, policy, scope):
    points, asked = field(11, completions=3, tests=12, requests=120, levels=60)
    pvt, requests = pvt_table(spark, points), request_table(spark, asked + [(None, "2004-01-01", 1.0), ("C1", "2004-01-01", None)])
    sqlapi.register_lookup_function(spark, pvt, "any_at", scope, policy, rounding="half_up")
    called = spark.sql(
        "SELECT r.*, a.* FROM {requests} r, LATERAL any_at(r.PRESSURE, r.ID_COMPLETION, r.VRR_DATE) a", requests=requests
    )
    plan = called._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(called) == rows(pvt_lookup(requests, pvt, scope, policy, rounding="half_up"))


def test_table_function_over_a_stored_index(spark, name):
    index = store_index(pvt_table(spark, [("C1", "2010-01-01", 100.0, 1.0), ("C1", "2010-01-01", 200.0, 3.0)]), name, buckets=2)
    sqlapi.register_lookup_function(spark, index, "stored_at")
    row = spark.sql("SELECT * FROM stored_at(150D, 'C1', DATE '2011-05-05')").first()
    assert (row.BRANCH, row.VISCOSITY_OIL) == ("interp", 2.0)
    assert spark.sql("SELECT BRANCH FROM stored_at(150D, 'C1', DATE '2009-05-05')").first().BRANCH == "none"
