"""Validity intervals, interval joins and running totals."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from build import day, executed_nodes, factor_table, pressure_table, volume_table
from voidage.operators.extremes import first_rows, two_extremes
from voidage.operators.intervals import CYCLE, interval_join, next_distinct_date, overlap_join, validity_intervals
from voidage.operators.running import running_totals
from voidage.plans.vrr import pressure_in_force, with_factor


def test_boundary_dates(spark):
    pressures = pressure_table(spark, [("P1", "2020-01-01", 1.0), ("P1", "2020-02-01", 2.0)])
    dates = ["2019-12-31", "2020-01-01", "2020-01-31", "2020-02-01", "2035-07-01"]
    volumes = volume_table(spark, [{"ID_PATTERN": "P1", "COMPLETION_ID": "C", "PROD_DATE": d} for d in dates])
    found = {r.PROD_DATE.isoformat(): r.PRESSURE for r in pressure_in_force(volumes, pressures).collect()}
    assert found == {"2020-01-01": 1.0, "2020-01-31": 1.0, "2020-02-01": 2.0, "2035-07-01": 2.0}


def _random_tables(spark, seed):
    rng = random.Random(seed)
    date = lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(900))
    starts = {(rng.choice("AB"), date()) for _ in range(40)}
    right = spark.createDataFrame(
        [(k, d, i) for i, (k, d) in enumerate(sorted(starts))], "k string, start date, i int"
    )
    left = spark.createDataFrame([(rng.choice("ABC"), date(), n) for n in range(200)], "k string, at date, n int")
    return left, right, sorted(starts)


@pytest.mark.parametrize("limit", [None, 0, 10**6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_is_as_of(spark, limit, how):
    left, right, starts = _random_tables(spark, 3)
    joined = interval_join(
        left, validity_intervals(right, ["k"], "start"), ["k"], "at", "start", "END_DATE", how, broadcast_bytes=limit
    )
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit == 10**6)
    found = {r.n: r.start for r in joined.collect()}
    expected = {}
    for r in left.collect():
        before = [d for k, d in starts if k == r.k and d <= r.at]
        if before or how == "left":
            expected[r.n] = max(before) if before else None
    assert found == expected


def _rows_sent(df) -> list[int]:
    """Rows of each relation that the plan sends to every task."""
    sent = [n for n in executed_nodes(df) if n.getClass().getSimpleName() == "BroadcastExchangeExec"]
    return [n.metrics().apply("numOutputRows").value() for n in sent]


def test_repeated_intervals_are_not_taken_for_small(spark):
    """Intervals below the limit of a broadcast, but not when they are filed under all their months."""
    rows = [(f"K{i}", dt.date(2000, 1, 1), dt.date(9999, 12, 31), i) for i in range(3000)]
    right = spark.createDataFrame(rows, "k string, start date, end date, i int")
    left = spark.createDataFrame([(f"K{i % 4000}", dt.date(2001, 1 + i % 12, 5), i) for i in range(9000)], "k string, at date, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
    try:
        joined = interval_join(left, right, ["k"], "at", "start", "end")
        assert max(_rows_sent(joined), default=0) < len(rows)
        found = sorted((r.n, r.i) for r in joined.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == [(n, n % 4000) for n in range(9000) if n % 4000 < 3000]


def test_dates_are_not_sent_to_every_task(spark):
    """There are as many distinct dates as rows."""
    factors = factor_table(spark, [(f"P{i % 5}", f"C{i}", f"200{i % 9}-01-01", 0.5) for i in range(500)])
    ended = next_distinct_date(factors, ["ID_PATTERN", "ID_COMPLETION"], "EFFECT_DATE")
    assert _rows_sent(ended) == []
    assert {(r.END_DATE, r["count"]) for r in ended.groupBy("END_DATE").count().collect()} == {(dt.date(9999, 12, 31), 500)}


def test_interval_join_with_nothing_on_the_right(spark):
    left, right, _ = _random_tables(spark, 4)
    empty = validity_intervals(right.filter("false"), ["k"], "start")
    assert interval_join(left, empty, ["k"], "at", "start", "END_DATE").count() == 0
    assert interval_join(left, empty, ["k"], "at", "start", "END_DATE", "left").count() == 200


@pytest.mark.parametrize("how", ["inner", "left"])
def test_long_and_overlapping_intervals(spark, how):
    """Intervals of a day up to many cycles, open ends, empty and reversed ones, whole cycles apart."""
    rng = random.Random(8)
    date = lambda: dt.date(1950, 1, 1) + dt.timedelta(days=rng.randrange(30_000))
    rows = []
    for i in range(150):
        start = date()
        length = rng.choice([-40, 0, 1, 20, 400, 365 * 5, 365 * 30])
        rows.append((rng.choice("AB"), start, rng.choice([start + dt.timedelta(days=length), dt.date(9999, 12, 31)]), i))
    rows += [("A", None, dt.date(2000, 1, 1), -1), ("A", dt.date(2000, 1, 1), None, -2), (None, *rows[0][1:3], -3)]
    asked = [(rng.choice("ABC"), date(), n) for n in range(300)] + [("A", None, -1), (None, date(), -2)]
    right = spark.createDataFrame(rows, "k string, start date, end date, i int")
    left = spark.createDataFrame(asked, "k string, at date, n int")
    found = sorted((r.n, r.i) for r in interval_join(left, right, ["k"], "at", "start", "end", how).collect() if r.i is not None)
    inside = lambda r, k, at: None not in (r[0], r[1], r[2], k, at) and r[0] == k and r[1] <= at < r[2]
    expected = sorted((n, r[3]) for k, at, n in asked for r in rows if inside(r, k, at))
    assert found == expected
    kept = {r.n for r in interval_join(left, right, ["k"], "at", "start", "end", how).collect()}
    assert kept == ({n for *_, n in asked} if how == "left" else {n for n, _ in expected})


def _repeated(spark, joined) -> int:
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan()
    metrics = []
    pending = [plan]
    while pending:
        node = pending.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            pending.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage") or "QueryStage" in node.getClass().getSimpleName():
            pending.append(node.plan())
            continue
        if node.nodeName() == "Generate":
            metrics.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]
    return sum(metrics)


def test_an_interval_is_repeated_for_one_cycle_at_most(spark):
    """However long it is, and whatever dates the other side has."""
    factors = spark.createDataFrame([("P", day("1950-01-01"), day("9999-12-31"), i) for i in range(10)], "k string, s date, e date, f int")
    pressures = spark.createDataFrame([("P", day("2019-01-01"), day("2019-02-01"), 1)], "k string, s date, e date, p int")
    others = factors.withColumnsRenamed({"s": "s2", "e": "e2"})
    joined = interval_join(pressures, others, ["k"], "s", "s2", "e2", "left")
    assert joined.count() == 10 and _repeated(spark, joined) == 10 * CYCLE
    month = pressures.withColumnsRenamed({"s": "s2", "e": "e2"})
    assert _repeated(spark, interval_join(factors, month, ["k"], "s", "s2", "e2", "left")) == 1
    assert overlap_join(factors, pressures.filter("false"), ["k"], "s", "e").count() == 0


def test_next_distinct_date_skips_ties(spark):
    table = spark.createDataFrame(
        [("A", day("2020-01-01"), 1), ("A", day("2020-01-01"), 2), ("A", day("2020-02-01"), 3)],
        "k string, d date, i int",
    )
    ends = {r.i: r.END_DATE.isoformat() for r in next_distinct_date(table, ["k"], "d").collect()}
    assert ends == {1: "2020-02-01", 2: "2020-02-01", 3: "9999-12-31"}


def test_intervals_of_a_key_tile_the_time_from_its_first_date(spark):
    _, right, _ = _random_tables(spark, 5)
    rows = sorted((r.k, r.start, r.END_DATE) for r in validity_intervals(right, ["k"], "start").collect())
    for (k, _, end), (k2, start, _) in zip(rows, rows[1:]):
        assert end == start if k == k2 else end == dt.date(9999, 12, 31)


def test_overlap_join_cuts_to_the_common_part(spark):
    a = spark.createDataFrame([("K", day("2020-01-01"), day("2020-06-01"), 1)], "k string, s date, e date, a int")
    b = spark.createDataFrame(
        [("K", day("2019-01-01"), day("2020-02-01"), 1), ("K", day("2020-02-01"), day("2020-06-01"), 2),
         ("K", day("2020-06-01"), day("2021-01-01"), 3)],
        "k string, s date, e date, b int",
    )
    found = sorted((r.b, r.s.isoformat(), r.e.isoformat()) for r in overlap_join(a, b, ["k"], "s", "e").collect())
    assert found == [(1, "2020-01-01", "2020-02-01"), (2, "2020-02-01", "2020-06-01")]


FACTORS = [
    ("P1", "C1", "2020-01-01", 0.5),
    ("P1", "C1", "2020-03-01", 0.6),
    ("P1", "C2", "2020-02-01", 0.7),
    ("P2", "C1", "2020-02-01", 0.4),
]


@pytest.mark.parametrize(
    "rule,expected",
    [
        ("pair", {("P1", 0.5), ("P2", 0.4)}),
        ("pattern", {("P2", 0.4)}),
        ("completion", {("P2", 0.4)}),
        ("latest", set()),
    ],
)
def test_factor_rules_in_february(spark, rule, expected):
    volumes = volume_table(spark, [{"ID_PATTERN": "P1", "COMPLETION_ID": "C1", "PROD_DATE": "2020-02-10"}])
    rows = with_factor(volumes, factor_table(spark, FACTORS), rule, "inner").collect()
    assert {(r.FACTOR_PATTERN, r.FACTOR) for r in rows} == expected


def test_latest_factor_applies_from_its_date(spark):
    dates = ["2020-02-29", "2020-03-01", "2020-04-01"]
    volumes = volume_table(spark, [{"ID_PATTERN": "P1", "COMPLETION_ID": "C1", "PROD_DATE": d} for d in dates])
    rows = with_factor(volumes, factor_table(spark, FACTORS), "latest").collect()
    assert [f for _, f in sorted((r.PROD_DATE, r.FACTOR) for r in rows)] == [None, 0.6, 0.6]


def test_running_totals_share_ties_and_keep_null_keys(spark):
    rows = [("A", day("2020-01-01"), 1.0), ("A", day("2020-01-02"), 2.0), ("A", day("2020-01-02"), 3.0),
            ("A", day("2020-01-03"), None), (None, day("2020-01-01"), 5.0), ("A", None, 7.0)]
    table = spark.createDataFrame(rows, "k string, d date, v double")
    found = sorted(
        (str(r.k), str(r.d), r.v, r.t)
        for r in running_totals(table, ["k"], "d", {"t": F.col("v")}).collect()
        if r.v is not None
    )
    # Rows without a date sort first.
    assert found == [("A", "2020-01-01", 1.0, 8.0), ("A", "2020-01-02", 2.0, 13.0), ("A", "2020-01-02", 3.0, 13.0),
                     ("A", "None", 7.0, 7.0), ("None", "2020-01-01", 5.0, 5.0)]


def test_extremes(spark):
    table = spark.createDataFrame([("A", 1.0), ("A", 1.0), ("A", 3.0), ("A", 2.0), ("B", 5.0), ("B", None)], "k string, v double")
    rows = {r.k: (r.LOWEST, r.SECOND_LOWEST, r.HIGHEST, r.SECOND_HIGHEST) for r in two_extremes(table, "k", "v").collect()}
    assert rows == {"A": (1.0, 2.0, 3.0, 2.0), "B": (5.0, None, 5.0, None)}
    assert {(r.k, r.v) for r in first_rows(table.filter("v IS NOT NULL"), ["k"], [F.col("v").desc()]).collect()} == {("A", 3.0), ("B", 5.0)}
