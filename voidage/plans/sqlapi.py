"""The lookup and the report as SQL views and SQL functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from voidage.operators.curve_index import CurveIndex, cell_of
from voidage.operators.curves import blocks_of_prefix_sql, lowest
from voidage.operators.intervals import CYCLE, filed_by_month
from voidage.plans.pvt import FIRST_POINT, SECOND_POINT, branch_of, pvt_lookup, requests_by_factor
from voidage.plans.vrr import vrr_view
from voidage.sources.schemas import PROPERTIES

_LINE = "y1 + (x - x1) * (y2 - y1) / (x2 - x1)"
_POINTS = "x1 DOUBLE, x2 DOUBLE, y1 DOUBLE, y2 DOUBLE, x DOUBLE"


def register_line_functions(spark: SparkSession) -> None:
    """``interpolate``, ``extrapolate`` and ``interpolate_guarded`` for SQL text."""
    for name in ("interpolate", "extrapolate"):
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}({_POINTS}) RETURNS DOUBLE
                RETURN CASE WHEN x1 = x2 THEN y1 ELSE {_LINE} END"""
        )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION interpolate_guarded({_POINTS}) RETURNS DOUBLE
            RETURN CASE WHEN x1 = x2 THEN y1
                        WHEN x1 IS NULL OR x2 IS NULL THEN NULL
                        WHEN x BETWEEN least(x1, x2) AND greatest(x1, x2) THEN {_LINE} END"""
    )


#: Rounding to five places as SQL text, by those names of ``pvt_lookup`` that have one.
_ROUNDED = {"sql": "round({}, 5)", "half_up": "floor(({}) * 100000 + 0.5D) / 100000"}


def register_lookup_function(
    spark: SparkSession,
    pvt: DataFrame | CurveIndex,
    name: str = "pvt_at",
    scope: str = "all_to_date",
    policy: str = "full",
    rounding: str = "sql",
) -> None:
    """A SQL table function ``name(pressure, completion, date)`` that answers any arguments.

    It gives what ``pvt_lookup`` gives for them: BRANCH, POINT_PRESSURE and the
    properties in one row; without a row where the policy has none.  Nothing is
    said beforehand about what will be asked.

    Its arguments enter the body as a relation of one row, which is then joined by
    equality to the tests and the blocks of the index.  A LATERAL call is planned
    as that body over the distinct arguments of all its rows, joined back to them:
    every argument is looked up once, and no request is tested against all the
    points of a completion.

    ``rounding`` is ``sql`` or ``half_up``.  ``pvt`` is a stored ``CurveIndex``, or the table of points, of which each call
    works an index out.
    """
    index = pvt if isinstance(pvt, CurveIndex) else CurveIndex.of(pvt)
    # Only the view of tests is filed by month, as a function cannot join by interval.
    filed_by_month(index.tests, "TEST_DATE", "END_DATE", "MONTH").createOrReplaceTempView(f"{name}_tests")
    index.points.createOrReplaceTempView(f"{name}_points")
    sizes, block = blocks_of_prefix_sql(scope)
    value = "get(A.VALUES, {k})"
    line = f"{value} + (at_pressure - A.PRESSURE) * (get(B.VALUES, {{k}}) - {value}) / (B.PRESSURE - A.PRESSURE)"
    values = ", ".join(
        _ROUNDED[rounding].format(f"CASE WHEN B IS NULL THEN {value} ELSE {line} END".format(k=k))
        for k in range(len(PROPERTIES))
    )
    columns = ", ".join(f"{p} DOUBLE" for p in PROPERTIES)
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(at_pressure DOUBLE, at_completion STRING, at_date DATE)
        RETURNS TABLE (BRANCH STRING, POINT_PRESSURE DOUBLE, {columns})
        RETURN
        SELECT BRANCH, A.PRESSURE, {values}
        FROM (SELECT BRANCH, {FIRST_POINT} AS A, {SECOND_POINT} AS B
        FROM (SELECT *, {branch_of(policy)} AS BRANCH
        FROM (SELECT AT, LOWER, UPPER, LOWER2, {lowest("ABOVE")} AS UPPER2
        FROM (SELECT *, array_max(filter(LOWS, p -> p.PRESSURE < LOWER.PRESSURE)) AS LOWER2,
                     filter(UPS, p -> p.PRESSURE > UPPER.PRESSURE) AS ABOVE
        FROM (SELECT max(CASE WHEN HIT THEN POINT END) AS AT,
                     max(CASE WHEN HIT THEN DOWN ELSE POINT END) AS LOWER,
                     min_by(UP, struct(UP.PRESSURE, -unix_date(UP.TEST_DATE))) FILTER (WHERE UP IS NOT NULL) AS UPPER,
                     flatten(collect_list(CASE WHEN HIT THEN array(DOWN, DOWN2) ELSE array(POINT, DOWN) END)) AS LOWS,
                     flatten(collect_list(array(UP, UP2))) AS UPS
        FROM (SELECT i.*, i.FROM_PRESSURE = q.X AS HIT
        FROM (SELECT *, {block.format(size="SIZE")} AS BLOCK, {cell_of("X")} AS CELL
        FROM (SELECT a.*, t.TEST_NO, t.SINCE, t.UNTIL, explode({sizes}) AS SIZE
        FROM (SELECT at_pressure AS X, at_completion AS COMPLETION, last_day(at_date) AS MONTH_END,
                     (year(at_date) * 12 + month(at_date)) % {CYCLE} AS MONTH) a
        JOIN {name}_tests t ON t.ID_COMPLETION = a.COMPLETION AND t.MONTH = a.MONTH
             AND t.TEST_DATE <= a.MONTH_END AND a.MONTH_END < t.END_DATE)) q
        JOIN {name}_points i ON i.ID_COMPLETION = q.COMPLETION AND i.SIZE = q.SIZE AND i.BLOCK = q.BLOCK
             AND i.CELL = q.CELL AND i.FROM_PRESSURE <= q.X AND q.X < i.TO_PRESSURE
             AND i.GENERATION BETWEEN q.SINCE AND q.UNTIL))))
        ) WHERE BRANCH <> 'no_row')"""
    )


#: The views that ``register_views`` can define, in the order of their needs.
TABLES = (
    "production_volumes_daily_oilfield",
    "pattern_contribution_factor",
    "pattern_pressure",
    "completion_pvt_characteristics",
)
VIEWS = ("completion_pvt_interpolated", "pattern_vrr_view")


def register_views(
    spark: SparkSession,
    volumes: DataFrame,
    factors: DataFrame,
    pressures: DataFrame,
    pvt: DataFrame,
    views: Sequence[str] = VIEWS,
    prefix: str = "",
    tables: bool = False,
    **options,
) -> list[str]:
    """Temporary views of the lookup and the report; returns the names it defined.

    Only the ``views`` asked for are planned, and ``tables`` says whether the base
    tables get views, too.  ``prefix`` goes in front of all names, so that views of
    the same name stay as they are.
    """
    made = {}
    if tables:
        made.update(zip(TABLES, (volumes, factors, pressures, pvt)))
    if VIEWS[0] in views:
        made[VIEWS[0]] = pvt_lookup(requests_by_factor(factors, pressures), pvt)
    if VIEWS[1] in views:
        made[VIEWS[1]] = vrr_view(volumes, factors, pressures, pvt, **options)
    for name, df in made.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in made]
