"""The bracket search against brute force."""

from __future__ import annotations

import calendar
import datetime as dt
import random

import pytest

from build import pvt_table, request_table
from voidage.operators.curves import bracket

SIDES = ("AT", "LOWER", "LOWER2", "UPPER", "UPPER2")


def field(seed: int, completions: int, tests: int, requests: int, levels: int):
    """Random curves and requests; the first completion has a third of everything."""
    rng = random.Random(seed)
    names = [f"C{i}" for i in range(completions)]

    def completion():
        return names[0] if rng.random() < 1 / 3 else rng.choice(names)

    def date(first_year, years):
        return (dt.date(first_year, 1, 1) + dt.timedelta(days=rng.randrange(365 * years))).isoformat()

    dates = {c: [date(2000, 5) for _ in range(rng.randint(1, tests))] for c in names}
    points = {}
    for _ in range(levels):
        c = completion()
        points[(c, rng.choice(dates[c]), float(rng.randrange(20)))] = rng.random()
    asked = {(completion(), date(1999, 8), rng.randrange(-4, 48) / 2) for _ in range(requests)}
    return [(*k, v) for k, v in points.items()], sorted(asked)


def brute(points, asked, scope):
    out = {}
    for c, d, x in asked:
        date = dt.date.fromisoformat(d)
        end = date.replace(day=calendar.monthrange(date.year, date.month)[1]).isoformat()
        known = [(p, t) for pc, t, p, _ in points if pc == c and t <= end]
        if scope == "active" and known:
            last = max(t for _, t in known)
            known = [k for k in known if k[1] == last]
        latest = {}
        for p, t in known:
            latest[p] = max(t, latest.get(p, ""))
        below = sorted((p for p in latest if p < x), reverse=True) + [None, None]
        above = sorted(p for p in latest if p > x) + [None, None]
        chosen = (x if x in latest else None, below[0], below[1], above[0], above[1])
        out[(c, d, x)] = (
            tuple(None if p is None else (p, latest[p]) for p in chosen),
            sum(p < x for p, _ in known),
            sum(p > x for p, _ in known),
        )
    return out


@pytest.mark.parametrize("scope", ["all_to_date", "active"])
@pytest.mark.parametrize(
    "seed,tests,width", [(1, 1, 250), (2, 5, 3), (3, 9, 1), (4, 33, 0.5), (5, 70, 250), (6, 70, 2)]
)
def test_same_as_brute_force(spark, scope, seed, tests, width):
    points, asked = field(seed, completions=4, tests=tests, requests=250, levels=220)
    found = bracket(request_table(spark, asked), pvt_table(spark, points), scope, width=width)
    result = {}
    for r in found.collect():
        key = (r.ID_COMPLETION, r.VRR_DATE.isoformat(), r.PRESSURE)
        assert key not in result
        sides = tuple(
            None if r[s] is None else (r[s].PRESSURE, r[s].TEST_DATE.isoformat()) for s in SIDES
        )
        result[key] = (sides, r.BELOW, r.ABOVE)
    assert result == brute(points, asked, scope)


def test_values_come_from_the_chosen_test(spark):
    points, asked = field(7, completions=3, tests=12, requests=200, levels=200)
    value = {(c, t, p): v for c, t, p, v in points}
    for r in bracket(request_table(spark, asked), pvt_table(spark, points), width=2).collect():
        for side in SIDES:
            if r[side] is not None:
                key = (r.ID_COMPLETION, r[side].TEST_DATE.isoformat(), r[side].PRESSURE)
                assert r[side].VISCOSITY_OIL == value[key]


def test_duplicate_points_give_one_row(spark):
    points = [("C1", "2020-01-01", 100.0, 1.0), ("C1", "2020-01-01", 100.0, 3.0)]
    rows = bracket(request_table(spark, [("C1", "2020-03-01", 100.0)]), pvt_table(spark, points)).collect()
    assert [r.AT.VISCOSITY_OIL for r in rows] == [3.0]


def test_points_without_date_or_pressure_are_ignored(spark):
    pvt = pvt_table(spark, [("C1", "2020-01-01", None, 1.0), ("C1", "2020-01-01", 100.0, 2.0)])
    pvt = pvt.unionByName(pvt.selectExpr("ID_COMPLETION", "CAST(NULL AS DATE) AS TEST_DATE", *pvt.columns[2:]))
    (row,) = bracket(request_table(spark, [("C1", "2020-03-01", 150.0)]), pvt).collect()
    assert (row.LOWER.PRESSURE, row.LOWER2, row.UPPER, row.BELOW) == (100.0, None, None, 1)


@pytest.mark.parametrize("scope", ["all_to_date", "active"])
def test_equal_requests_come_back_as_often(spark, scope):
    points = [("C1", "2020-01-01", 100.0, 1.0)]
    asked = [("C1", "2020-03-01", 150.0)] * 2 + [("C2", "2020-03-01", None)] * 3 + [(None, "2020-03-01", 1.0)]
    requests = request_table(spark, asked)
    found = bracket(requests, pvt_table(spark, points), scope)
    assert sorted(r.ID_COMPLETION or "" for r in found.collect()) == ["", "C1", "C1", "C2", "C2", "C2"]
    more = requests.selectExpr("*", "monotonically_increasing_id() AS n")
    rows = bracket(more, pvt_table(spark, points), scope).collect()
    assert len({r.n for r in rows}) == len(rows) == 6
    assert sum(r.LOWER is not None for r in rows) == 2


def test_one_completion_is_sorted_in_parts(spark):
    """A completion with all the points: no task sees more than a range of one of its blocks."""
    from voidage.operators import curves

    points = [("C1", "2020-01-01", float(p), 1.0) for p in range(4000)]
    levels = curves._points(pvt_table(spark, points), "active", 250)
    assert levels.select("__range").distinct().count() == 16
    assert levels.groupBy(*curves._PIECE).count().agg({"count": "max"}).first()[0] == 250


def test_more_tests_than_any_fixed_number_of_blocks(spark):
    """The blocks of a prefix follow from its length alone."""
    from pyspark.sql import functions as F

    from voidage.operators import curves

    sizes, _ = curves.blocks_of_prefix("all_to_date")
    n = spark.range(1).select(F.lit(5 * 2**18).cast("int").alias("TEST_NO")).select(sizes.alias("s")).first().s
    assert sum(2**k for k in n) == 5 * 2**18 + 1
