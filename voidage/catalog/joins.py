"""Queries that exercise the joins and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from voidage.catalog import oracle
from voidage.catalog.oracle import with_tables
from voidage.catalog.registry import register
from voidage.functions.dates import month_end
from voidage.operators.curves import bracket, numbered_tests, with_known_tests
from voidage.operators.extremes import two_extremes as extremes
from voidage.operators.intervals import interval_join
from voidage.plans import sqlapi
from voidage.plans.pvt import requests_by_factor, requests_by_volume as by_volume
from voidage.plans.vrr import (
    forward_matched,
    pressure_in_force as in_force,
    pressure_intervals,
    schedule,
    with_factor,
)
from voidage.sources.derived import Field

DAY = ("ID_PATTERN", "COMPLETION_ID", "PROD_DATE", "AMOUNT_TYPE")


def _asked(field: Field) -> DataFrame:
    return requests_by_factor(field.factors, field.pressures)


@register(
    with_tables(
        """SELECT r.ID_COMPLETION, r.VRR_DATE, count(DISTINCT v.TEST_DATE) AS KNOWN_TESTS,
                  count(v.TEST_DATE) AS KNOWN_POINTS
           FROM (SELECT DISTINCT ID_COMPLETION, VRR_DATE FROM requests) r
           LEFT JOIN pvt v ON v.ID_COMPLETION = r.ID_COMPLETION AND v.TEST_DATE <= last_day(r.VRR_DATE)
           GROUP BY ALL""",
        "requests",
        "pvt",
    )
)
def known_by_month_end(field: Field) -> DataFrame:
    """Tests and points known by the end of each request's month.

    Points are counted per test and summed up to each test, so a request meets
    one test row instead of every point.
    """
    to_test = W.partitionBy("ID_COMPLETION").orderBy("TEST_DATE")
    counted = field.pvt.groupBy("ID_COMPLETION", "TEST_DATE").agg(F.count(F.lit(1)).alias("points"))
    tests = numbered_tests(field.pvt).join(counted, ["ID_COMPLETION", "TEST_DATE"]).select(
        "ID_COMPLETION",
        "TEST_DATE",
        "END_DATE",
        (F.col("TEST_NO") + 1).cast("bigint").alias("KNOWN_TESTS"),
        F.sum("points").over(to_test).alias("KNOWN_POINTS"),
    )
    months = _asked(field).select("ID_COMPLETION", "VRR_DATE").distinct()
    ends = months.withColumn("MONTH_END", month_end(F.col("VRR_DATE")))
    known = interval_join(ends, tests, ["ID_COMPLETION"], "MONTH_END", "TEST_DATE", "END_DATE", "left")
    none = F.lit(0).cast("bigint")
    return known.select(
        "ID_COMPLETION",
        "VRR_DATE",
        F.coalesce("KNOWN_TESTS", none).alias("KNOWN_TESTS"),
        F.coalesce("KNOWN_POINTS", none).alias("KNOWN_POINTS"),
    )


@register(
    with_tables(
        """SELECT v.COMPLETION_ID, v.ID_PATTERN, v.PROD_DATE, v.AMOUNT_TYPE, p.DATE, p.END_DATE, p.PRESSURE
           FROM daily_volume v LEFT JOIN pressure_ended p
             ON p.ID_PATTERN = v.ID_PATTERN AND v.PROD_DATE >= p.DATE AND v.PROD_DATE < p.END_DATE""",
        "daily_volume",
        "pressure_ended",
    )
)
def interval_containment(field: Field) -> DataFrame:
    return interval_join(
        field.volumes.select("COMPLETION_ID", "ID_PATTERN", "PROD_DATE", "AMOUNT_TYPE"),
        pressure_intervals(field.pressures),
        ["ID_PATTERN"],
        "PROD_DATE",
        "DATE",
        "END_DATE",
        "left",
    )


@register(
    with_tables(
        """SELECT v.ID_PATTERN, v.COMPLETION_ID, v.PROD_DATE, v.AMOUNT_TYPE, p.DATE AS PRESSURE_DATE, p.PRESSURE
           FROM daily_volume v JOIN pattern_pressure p ON p.ID_PATTERN = v.ID_PATTERN AND p.DATE <= v.PROD_DATE
           QUALIFY row_number() OVER (PARTITION BY v.COMPLETION_ID, v.PROD_DATE, v.AMOUNT_TYPE
                                      ORDER BY p.DATE DESC) = 1""",
        "daily_volume",
        "pattern_pressure",
    )
)
def pressure_in_force(field: Field) -> DataFrame:
    return in_force(field.volumes.select(*DAY), field.pressures)


# What ends factor row f, per rule: the next effect date of these keys.
_ENDED_BY = {
    "pair": "g.ID_PATTERN = f.ID_PATTERN AND g.ID_COMPLETION = f.ID_COMPLETION",
    "pattern": "g.ID_PATTERN = f.ID_PATTERN",
    "completion": "g.ID_COMPLETION = f.ID_COMPLETION",
}


def _factor_periods(rule: str) -> str:
    """Every factor row with the day it ends, ranked on the factors alone."""
    if rule == "latest":
        return """
        SELECT f.*, DATE '9999-12-31' AS END_DATE FROM contribution_factor f
        QUALIFY rank() OVER (PARTITION BY ID_PATTERN, ID_COMPLETION ORDER BY EFFECT_DATE DESC) = 1"""
    return f"""
        SELECT f.*, coalesce((SELECT min(g.EFFECT_DATE) FROM contribution_factor g
                              WHERE {_ENDED_BY[rule]} AND g.EFFECT_DATE > f.EFFECT_DATE), DATE '9999-12-31') AS END_DATE
        FROM contribution_factor f"""


def _in_force(rule: str) -> str:
    own = "AND f.ID_PATTERN = v.ID_PATTERN" if rule == "latest" else ""
    return f"f.ID_COMPLETION = v.COMPLETION_ID {own} AND v.PROD_DATE >= f.EFFECT_DATE AND v.PROD_DATE < f.END_DATE"


def factor_match(rule: str) -> str:
    """Daily rows with every factor row that is in force."""
    return f"""
        SELECT v.ID_PATTERN, v.COMPLETION_ID, v.PROD_DATE, v.AMOUNT_TYPE,
               f.ID_PATTERN AS FACTOR_PATTERN, f.EFFECT_DATE, f.FACTOR
        FROM daily_volume v JOIN ({_factor_periods(rule)}) f ON {_in_force(rule)}"""


def _factor_sql(rule: str, how: str = "LEFT") -> str:
    return with_tables(
        f"""SELECT v.ID_PATTERN, v.COMPLETION_ID, v.PROD_DATE, v.AMOUNT_TYPE,
                   f.ID_PATTERN AS FACTOR_PATTERN, f.EFFECT_DATE, f.FACTOR
            FROM daily_volume v {how} JOIN periods f ON {_in_force(rule)}""",
        "daily_volume",
        "contribution_factor",
        ctes={"periods": _factor_periods(rule)},
    )


def _factors_in_force(field: Field, rule: str, how: str = "left") -> DataFrame:
    return with_factor(field.volumes.select(*DAY), field.factors, rule, how)


@register(_factor_sql("pair"))
def factor_asof_pair(field: Field) -> DataFrame:
    return _factors_in_force(field, "pair")


@register(_factor_sql("pattern"))
def factor_asof_pattern(field: Field) -> DataFrame:
    return _factors_in_force(field, "pattern")


@register(_factor_sql("latest"))
def factor_latest(field: Field) -> DataFrame:
    return _factors_in_force(field, "latest")


@register(_factor_sql("completion", how="INNER"))
def factor_asof_completion(field: Field) -> DataFrame:
    return _factors_in_force(field, "completion", "inner")


@register(
    with_tables(
        f"""SELECT r.*, low.PRESSURE AS LOWER_PRESSURE, low.TEST_DATE AS LOWER_DATE,
                   low.OIL_FORMATION_VOLUME_FACTOR AS LOWER_OIL,
                   up.PRESSURE AS UPPER_PRESSURE, up.TEST_DATE AS UPPER_DATE,
                   up.OIL_FORMATION_VOLUME_FACTOR AS UPPER_OIL
            FROM requests r LEFT JOIN low ON {oracle.same_request('low')}
            LEFT JOIN up ON {oracle.same_request('up')}""",
        "requests",
        "pvt_ended",
        ctes=oracle.neighbours("all_to_date"),
    )
)
def bracket_join(field: Field) -> DataFrame:
    found = bracket(_asked(field), field.pvt)
    return found.select(
        "ID_COMPLETION",
        "VRR_DATE",
        "PRESSURE",
        F.col("LOWER.PRESSURE").alias("LOWER_PRESSURE"),
        F.col("LOWER.TEST_DATE").alias("LOWER_DATE"),
        F.col("LOWER.OIL_FORMATION_VOLUME_FACTOR").alias("LOWER_OIL"),
        F.col("UPPER.PRESSURE").alias("UPPER_PRESSURE"),
        F.col("UPPER.TEST_DATE").alias("UPPER_DATE"),
        F.col("UPPER.OIL_FORMATION_VOLUME_FACTOR").alias("UPPER_OIL"),
    )


_SECOND = "SELECT r.*, '{side}' AS SIDE, s.PRESSURE AS POINT_PRESSURE, s.TEST_DATE, s.VISCOSITY_OIL FROM requests r JOIN {table} s ON {on}"


@register(
    with_tables(
        _SECOND.format(side="low", table="low2", on=oracle.same_request("s"))
        + " UNION ALL "
        + _SECOND.format(side="up", table="up2", on=oracle.same_request("s")),
        "requests",
        "pvt_ended",
        ctes=oracle.neighbours("all_to_date"),
    )
)
def second_bound(field: Field) -> DataFrame:
    """The second pressure below and above, as one relation."""
    found = bracket(_asked(field), field.pvt)

    sides = F.array(
        *(
            F.struct(F.lit(name).alias("SIDE"), F.col(point).alias("p"))
            for name, point in (("low", "LOWER2"), ("up", "UPPER2"))
        )
    )
    both = found.select("ID_COMPLETION", "VRR_DATE", "PRESSURE", F.explode(sides).alias("s"))
    return both.filter(F.col("s.p").isNotNull()).select(
        "ID_COMPLETION",
        "VRR_DATE",
        "PRESSURE",
        "s.SIDE",
        F.col("s.p.PRESSURE").alias("POINT_PRESSURE"),
        F.col("s.p.TEST_DATE").alias("TEST_DATE"),
        F.col("s.p.VISCOSITY_OIL").alias("VISCOSITY_OIL"),
    )


@register(
    with_tables(
        """SELECT ID_COMPLETION, LOWEST, HIGHEST,
                  (SELECT min(w.PRESSURE) FROM pvt w
                   WHERE w.ID_COMPLETION = e.ID_COMPLETION AND w.PRESSURE > e.LOWEST) AS SECOND_LOWEST,
                  (SELECT max(w.PRESSURE) FROM pvt w
                   WHERE w.ID_COMPLETION = e.ID_COMPLETION AND w.PRESSURE < e.HIGHEST) AS SECOND_HIGHEST
           FROM (SELECT ID_COMPLETION, min(PRESSURE) AS LOWEST, max(PRESSURE) AS HIGHEST
                 FROM pvt GROUP BY ID_COMPLETION) e""",
        "pvt",
    )
)
def two_extremes(field: Field) -> DataFrame:
    return extremes(field.pvt, "ID_COMPLETION", "PRESSURE")


@register(
    with_tables(
        """SELECT * FROM contribution_factor f
           WHERE EXISTS (SELECT 1 FROM pvt v WHERE v.ID_COMPLETION = f.ID_COMPLETION)""",
        "contribution_factor",
        "pvt",
    )
)
def exists_semi(field: Field) -> DataFrame:
    return field.factors.join(field.pvt, "ID_COMPLETION", "left_semi")


@register(
    with_tables(
        """SELECT * FROM contribution_factor f
           WHERE NOT EXISTS (SELECT 1 FROM pvt v WHERE v.ID_COMPLETION = f.ID_COMPLETION)""",
        "contribution_factor",
        "pvt",
    )
)
def not_exists_anti(field: Field) -> DataFrame:
    return field.factors.join(field.pvt, "ID_COMPLETION", "left_anti")


@register(
    with_tables(
        """SELECT * FROM daily_volume
           WHERE ID_PATTERN IN (SELECT ID_PATTERN FROM pattern_pressure
                                WHERE DATE < DATE '1995-07-01' AND PRESSURE >= 3000)""",
        "daily_volume",
        "pattern_pressure",
    )
)
def in_subquery(field: Field) -> DataFrame:
    """Daily rows of the patterns that began with a high pressure, about half of them."""
    high = field.pressures.filter("DATE < DATE '1995-07-01' AND PRESSURE >= 3000").select("ID_PATTERN")
    return field.volumes.join(high, "ID_PATTERN", "left_semi")


@register(with_tables("SELECT * FROM requests", "requests"), name="requests_by_factor")
def factor_requests(field: Field) -> DataFrame:
    return _asked(field)


_BY_VOLUME = """SELECT DISTINCT v.COMPLETION_ID AS ID_COMPLETION, p.DATE AS VRR_DATE, p.PRESSURE
                FROM pattern_pressure p JOIN daily_volume v ON v.ID_PATTERN = p.ID_PATTERN"""


@register(with_tables(_BY_VOLUME, "pattern_pressure", "daily_volume"))
def requests_by_volume(field: Field) -> DataFrame:
    return by_volume(field.volumes, field.pressures)


@register(
    with_tables(
        """SELECT v.*, (SELECT max(EFFECT_DATE) FROM contribution_factor g
                        WHERE g.ID_PATTERN = v.FACTOR_PATTERN) AS LAST_EFFECT_DATE
           FROM shares v
           WHERE EXISTS (SELECT 1 FROM contribution_factor g
                         WHERE g.ID_PATTERN = v.FACTOR_PATTERN AND g.EFFECT_DATE >= v.PROD_DATE)""",
        "daily_volume",
        "contribution_factor",
        ctes={"shares": factor_match("completion")},
    )
)
def forward_factor_match(field: Field) -> DataFrame:
    matched = forward_matched(field.volumes.select(*DAY), field.factors)
    return matched.select(*DAY, "FACTOR_PATTERN", "EFFECT_DATE", "FACTOR", "LAST_EFFECT_DATE")


@register(
    with_tables(
        """SELECT f.ID_COMPLETION, p.ID_PATTERN, p.DATE, p.PRESSURE, f.EFFECT_DATE, f.FACTOR
           FROM contribution_factor f, pattern_pressure p
           WHERE f.ID_PATTERN = p.ID_PATTERN AND f.EFFECT_DATE <= p.DATE""",
        "contribution_factor",
        "pattern_pressure",
    )
)
def cross_where_join(field: Field) -> DataFrame:
    """A comma join with its equality in WHERE, which is planned as an equi-join."""
    return field.factors.sparkSession.sql(
        """SELECT f.ID_COMPLETION, p.ID_PATTERN, p.DATE, p.PRESSURE, f.EFFECT_DATE, f.FACTOR
           FROM {factors} f, {pressures} p
           WHERE f.ID_PATTERN = p.ID_PATTERN AND f.EFFECT_DATE <= p.DATE""",
        factors=field.factors,
        pressures=field.pressures,
    )


@register(
    with_tables(
        """SELECT v.ID_PATTERN, v.COMPLETION_ID, v.PROD_DATE, v.AMOUNT_TYPE, f.FACTOR_PATTERN, f.FACTOR,
                  p.DATE AS PRESSURE_DATE, p.PRESSURE, x.BRANCH, x.OIL_FORMATION_VOLUME_FACTOR, x.SOLUTION_GAS_OIL_RATIO
           FROM daily_volume v
           JOIN matched f ON f.COMPLETION_ID = v.COMPLETION_ID AND f.PROD_DATE = v.PROD_DATE
                         AND f.AMOUNT_TYPE = v.AMOUNT_TYPE
           JOIN pressure_ended p ON p.ID_PATTERN = f.FACTOR_PATTERN
                                AND v.PROD_DATE >= p.DATE AND v.PROD_DATE < p.END_DATE,
                LATERAL (SELECT * FROM answers a WHERE a.ID_COMPLETION = v.COMPLETION_ID
                         AND a.VRR_DATE = p.DATE AND a.PRESSURE = p.PRESSURE) x""",
        "requests",
        "pvt_ended",
        "daily_volume",
        "pressure_ended",
        ctes={
            **oracle.neighbours("all_to_date"),
            "answers": " UNION ALL ".join(oracle.branches("full").values()),
            "matched": factor_match("pair"),
        },
    )
)
def lateral_lookup(field: Field) -> DataFrame:
    """The table function, called LATERAL for every daily row with the factor and pressure in force."""
    spark = field.pvt.sparkSession
    sqlapi.register_lookup_function(spark, field.pvt, name="pvt_in_force")
    planned = schedule(field.factors, field.pressures).withColumnsRenamed(
        {"ID_PATTERN": "FACTOR_PATTERN", "VRR_DATE": "PRESSURE_DATE"}
    )
    daily = field.volumes.select(*DAY).withColumn("ID_COMPLETION", F.col("COMPLETION_ID"))
    rows = interval_join(daily, planned, ["ID_COMPLETION"], "PROD_DATE", "START_DATE", "END_DATE")
    return spark.sql(
        """SELECT r.ID_PATTERN, r.COMPLETION_ID, r.PROD_DATE, r.AMOUNT_TYPE, r.FACTOR_PATTERN, r.FACTOR,
                  r.PRESSURE_DATE, r.PRESSURE, x.BRANCH, x.OIL_FORMATION_VOLUME_FACTOR, x.SOLUTION_GAS_OIL_RATIO
           FROM {rows} r, LATERAL pvt_in_force(r.PRESSURE, r.COMPLETION_ID, r.PRESSURE_DATE) x""",
        rows=rows,
    )


@register(
    with_tables(
        """SELECT r.*, v.TEST_DATE, v.END_DATE
           FROM requests r LEFT JOIN (SELECT DISTINCT ID_COMPLETION, TEST_DATE, END_DATE FROM pvt_ended) v
             ON v.ID_COMPLETION = r.ID_COMPLETION AND v.TEST_DATE <= last_day(r.VRR_DATE)
            AND last_day(r.VRR_DATE) < v.END_DATE""",
        "requests",
        "pvt_ended",
    )
)
def active_test(field: Field) -> DataFrame:
    return with_known_tests(_asked(field), field.pvt).drop("TEST_NO")
