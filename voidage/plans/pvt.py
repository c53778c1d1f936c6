"""Fluid properties at a pressure and date, for all requests in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from voidage.functions.numeric import ROUNDING
from voidage.operators.curve_index import CurveIndex
from voidage.operators.curves import measured, numbered_tests, packed_bracket, search, with_known_tests
from voidage.operators.nearby import newest_within
from voidage.sources.schemas import PROPERTIES, REQUEST_KEY

#: What a lookup does where there is no exact point:
#: ``full``           interpolate, else extend the curve at either end, else one flat value
#: ``low_only``       interpolate or extend below; above the range there is no row
#: ``low_only_null``  the same without exact points, and a row of NULLs otherwise
#: ``nearest``        interpolate, else the nearest point's own values
POLICIES = ("full", "low_only", "low_only_null", "nearest")


def requests_by_factor(factors: DataFrame, pressures: DataFrame) -> DataFrame:
    """Distinct (completion, date, pressure), completions taken from the factors."""
    members = factors.select("ID_PATTERN", "ID_COMPLETION").distinct()
    return _requests(members, pressures)


def requests_by_volume(volumes: DataFrame, pressures: DataFrame) -> DataFrame:
    """Distinct (completion, date, pressure), completions taken from the volumes."""
    members = volumes.select("ID_PATTERN", F.col("COMPLETION_ID").alias("ID_COMPLETION")).distinct()
    return _requests(members, pressures)


def _requests(members: DataFrame, pressures: DataFrame) -> DataFrame:
    # The member pairs are reduced first: the join then only makes rows that
    # the result can hold, short of two patterns that share a pressure and day.
    return (
        members.join(pressures, "ID_PATTERN")
        .select("ID_COMPLETION", F.col("DATE").alias("VRR_DATE"), "PRESSURE")
        .distinct()
    )


def pvt_stub(requests: DataFrame) -> DataFrame:
    """The request pressure with every property unknown."""
    return requests.select("*", *(F.lit(None).cast("double").alias(name) for name in PROPERTIES))


_AT, _LOW, _LOW2, _UP, _UP2 = (f"{side} IS NOT NULL" for side in ("AT", "LOWER", "LOWER2", "UPPER", "UPPER2"))

#: Per policy its branches with the condition of each, the first that holds; otherwise it is ``none``.
#: As SQL text, which DataFrame plans and the SQL table function share.
RULES = {
    "full": (
        ("exact", _AT),
        ("interp", f"{_LOW} AND {_UP}"),
        ("extrap_low", f"NOT ({_LOW}) AND {_UP2}"),
        ("extrap_high", f"NOT ({_UP}) AND {_LOW2}"),
        ("single", f"{_LOW} OR {_UP}"),
    ),
    "low_only": (
        ("exact", _AT),
        ("interp", f"{_LOW} AND {_UP}"),
        ("extrap_low", f"NOT ({_LOW}) AND {_UP2}"),
        ("no_row", f"{_LOW} OR {_UP}"),
    ),
    "low_only_null": (
        ("interp", f"{_LOW} AND {_UP}"),
        ("extrap_low", f"NOT ({_AT}) AND NOT ({_LOW}) AND {_UP2}"),
    ),
    "nearest": (
        ("exact", _AT),
        ("interp", f"{_LOW} AND {_UP}"),
        ("nearest_low", _LOW),
        ("nearest_high", _UP),
    ),
}

#: The point a branch starts from, and the second one of its line, if it has a line.
FIRST_POINT = (
    "CASE WHEN BRANCH = 'exact' THEN AT WHEN BRANCH = 'extrap_low' THEN UPPER"
    " WHEN BRANCH <> 'none' THEN coalesce(LOWER, UPPER) END"
)
SECOND_POINT = (
    "CASE WHEN BRANCH = 'interp' THEN UPPER WHEN BRANCH = 'extrap_low' THEN UPPER2"
    " WHEN BRANCH = 'extrap_high' THEN LOWER2 END"
)


def branch_of(policy: str) -> str:
    """The name of the rule that a bracketed request falls under, as SQL text."""
    if policy not in RULES:
        raise ValueError(f"unknown policy: {policy}")
    cases = " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in RULES[policy])
    return f"CASE {cases} ELSE 'none' END"


def with_branch(found: DataFrame, policy: str) -> DataFrame:
    """Name the rule each bracketed request falls under and pick its points.

    Adds BRANCH and the points ``__a`` and ``__b``, packed as they were found: the
    value is that of the line through both, or that of ``__a`` alone where ``__b`` is NULL.
    """
    named = found.selectExpr("*", f"{branch_of(policy)} AS BRANCH")
    if policy == "low_only":
        named = named.filter("BRANCH <> 'no_row'")
    return named.selectExpr("*", f"{FIRST_POINT} AS __a", f"{SECOND_POINT} AS __b")


def _tolerate(found: DataFrame, pvt: DataFrame | CurveIndex, scope: str, tolerance: float) -> DataFrame:
    """Take a point nearer than ``tolerance`` for exact: the newest, of one test the nearest."""

    def rank(point: Column) -> Column:
        gap = F.abs(point["PRESSURE"] - F.col("PRESSURE"))
        key = F.struct(point["TEST_DATE"].alias("tested"), (-gap).alias("near"))
        return F.when(gap < tolerance, F.struct(key.alias("rank"), point.alias("point")))

    if scope == "active":
        # Points of one test only: the nearest is among those next to the request.
        best = F.array_max(F.array(*(rank(F.col(name)) for name in ("AT", "LOWER", "UPPER"))))
        return found.withColumn("AT", best["point"])
    asked = found.select(*REQUEST_KEY).filter(F.col("PRESSURE").isNotNull()).distinct()
    if isinstance(pvt, CurveIndex):
        in_all = F.count(F.lit(1)).over(W.partitionBy("ID_COMPLETION")).cast("int")
        points, tests = pvt.measured(), pvt.tests.withColumn("TESTS", in_all)
        known, of_test = pvt.with_known_tests(asked), lambda requests: pvt.search(requests, "active")
    else:
        points, tests = measured(pvt), numbered_tests(pvt)
        known, of_test = with_known_tests(asked, pvt), lambda requests: search(requests, pvt, "active")
    newest = newest_within(known, points, tests, tolerance)
    if isinstance(pvt, CurveIndex):
        newest = newest.join(pvt.tests.select("ID_COMPLETION", F.col("TEST_NO").alias("NEWEST"), "SINCE", "UNTIL"), ["ID_COMPLETION", "NEWEST"])
    of_newest = of_test(newest.withColumnRenamed("NEWEST", "TEST_NO"))
    nearest = F.array_max(F.array(*(rank(F.col(name)) for name in ("AT", "LOWER", "UPPER"))))
    newest = of_newest.select(*REQUEST_KEY, nearest["point"].alias("__at"))
    same = [F.col(f"__q.{name}") == F.col(f"__n.{name}") for name in REQUEST_KEY]
    return (
        found.alias("__q")
        .join(newest.alias("__n"), same, "left")
        .select(*(F.col("__n.__at").alias(c) if c == "AT" else F.col(f"__q.{c}") for c in found.columns))
    )


def property_value(name: str, guarded: bool = False) -> Column:
    """One property at the request pressure, before rounding.

    The line of ``extrapolate``, with its two differences of pressure taken
    from the columns ``__dx`` and ``__run``: ten properties share them, and the
    generated code stays small enough to be compiled.  As SQL text it is one call
    to Spark instead of twenty, ten times for each lookup.
    """
    y1, y2 = (f"get({point}.VALUES, {PROPERTIES.index(name)})" for point in ("__a", "__b"))
    line = f"{y1} + __dx * ({y2} - {y1}) / __run"
    if guarded:
        inside = "__dx >= least(__run, 0D) AND __dx <= greatest(__run, 0D)"
        line = f"CASE WHEN BRANCH <> 'interp' OR ({inside}) THEN {line} END"
    return F.expr(f"CASE WHEN __run IS NULL THEN {y1} ELSE {line} END")


def with_line(chosen: DataFrame) -> DataFrame:
    """Add the pressure differences of the line: request and second point, from the first."""
    return chosen.selectExpr(
        "*", "PRESSURE - __a.PRESSURE AS __dx", "__b.PRESSURE - __a.PRESSURE AS __run"
    )


def pvt_lookup(
    requests: DataFrame,
    pvt: DataFrame | CurveIndex,
    scope: str = "all_to_date",
    policy: str = "full",
    tolerance: float = 0.0,
    guarded: bool = False,
    rounding: str = "sql",
) -> DataFrame:
    """The ten fluid properties of each request, rounded to five places.

    ``requests`` are rows with ID_COMPLETION, VRR_DATE and PRESSURE; rows that
    repeat come back as often.  They come back with their pressure unrounded, so
    that the result can be joined on it, plus the properties, BRANCH (the rule
    applied) and POINT_PRESSURE (the pressure of the point the rule started from).

    ``pvt`` is the table of points, or a ``CurveIndex`` that was built from one.
    """
    round_off = ROUNDING[rounding]
    found = pvt.bracket(requests, scope) if isinstance(pvt, CurveIndex) else packed_bracket(requests, pvt, scope)
    if tolerance:
        found = _tolerate(found, pvt, scope, tolerance)
    chosen = with_branch(found, policy)
    return with_line(chosen).select(
        *requests.columns,
        "BRANCH",
        F.col("__a.PRESSURE").alias("POINT_PRESSURE"),
        *(round_off(property_value(name, guarded)).alias(name) for name in PROPERTIES),
    )
