"""Queries over the fluid-property lookup."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from voidage.catalog import oracle
from voidage.catalog.oracle import with_tables
from voidage.catalog.registry import register
from voidage.plans import sqlapi
from voidage.functions.numeric import ROUNDING, interpolate
from voidage.operators.curve_index import refresh_index, store_index
from voidage.operators.curves import bracket, packed_bracket
from voidage.plans.pvt import property_value, pvt_lookup, requests_by_factor, with_branch, with_line
from voidage.sources.derived import Field
from voidage.sources.schemas import PROPERTIES


def _asked(field: Field) -> DataFrame:
    return requests_by_factor(field.factors, field.pressures)


def _branch(field: Field, name: str, **options) -> DataFrame:
    return pvt_lookup(_asked(field), field.pvt, **options).filter(F.col("BRANCH") == name)


@register(oracle.lookup(only=("exact",)))
def pvt_exact(field: Field) -> DataFrame:
    return _branch(field, "exact")


# Requests a little beside the points: within the tolerance on both sides, at it, and beyond.
_SHIFTED = """
    SELECT DISTINCT ID_COMPLETION, p.DATE AS VRR_DATE,
           PRESSURE + CASE quarter(p.DATE) WHEN 1 THEN 0.000004 WHEN 2 THEN -0.000006
                                           WHEN 3 THEN 0.00002 ELSE 0 END::DOUBLE AS PRESSURE
    FROM contribution_factor JOIN pattern_pressure p USING (ID_PATTERN)"""


def _shifted(field: Field) -> DataFrame:
    quarter = F.quarter("VRR_DATE")
    by = F.when(quarter == 1, 0.000004).when(quarter == 2, -0.000006).when(quarter == 3, 0.00002).otherwise(0.0)
    return _asked(field).withColumn("PRESSURE", F.col("PRESSURE") + by)


@register(oracle.lookup("active", tolerance="0.00001", requests=_SHIFTED))
def pvt_exact_tolerance(field: Field) -> DataFrame:
    return pvt_lookup(_shifted(field), field.pvt, scope="active", tolerance=1e-5)


@register(oracle.lookup(tolerance="0.00001", requests=_SHIFTED))
def pvt_exact_tolerance_all(field: Field) -> DataFrame:
    return pvt_lookup(_shifted(field), field.pvt, tolerance=1e-5)


@register(oracle.lookup(rounding="half_even"))
def pvt_half_even(field: Field) -> DataFrame:
    return pvt_lookup(_asked(field), field.pvt, rounding="half_even")


@register(oracle.lookup())
def pvt_guarded(field: Field) -> DataFrame:
    """The guard changes nothing here: an interpolated request lies between its two points."""
    return pvt_lookup(_asked(field), field.pvt, guarded=True)


def _side(table: str) -> str:
    props = ", ".join(f"s.{p}" for p in PROPERTIES)
    return with_tables(
        f"""SELECT r.*, s.PRESSURE AS POINT_PRESSURE, s.TEST_DATE, {props}
            FROM requests r JOIN {table} s ON {oracle.same_request('s')}""",
        "requests",
        "pvt_ended",
        ctes=oracle.neighbours("all_to_date"),
    )


def _points(field: Field, side: str) -> DataFrame:
    found = bracket(_asked(field), field.pvt).filter(F.col(side).isNotNull())
    return found.select(
        "ID_COMPLETION",
        "VRR_DATE",
        "PRESSURE",
        F.col(f"{side}.PRESSURE").alias("POINT_PRESSURE"),
        F.col(f"{side}.TEST_DATE").alias("TEST_DATE"),
        *(F.col(f"{side}.{p}").alias(p) for p in PROPERTIES),
    )


@register(_side("low"))
def pvt_lower(field: Field) -> DataFrame:
    return _points(field, "LOWER")


@register(_side("up"))
def pvt_upper(field: Field) -> DataFrame:
    return _points(field, "UPPER")


@register(oracle.lookup(only=("interp",)))
def pvt_interp(field: Field) -> DataFrame:
    return _branch(field, "interp")


_GUARDED = (
    "CASE WHEN r.PRESSURE BETWEEN least(a.PRESSURE, b.PRESSURE) AND greatest(a.PRESSURE, b.PRESSURE)"
    " THEN {line} END AS {name}"
)


@register(
    with_tables(
        "SELECT r.*, a.PRESSURE AS X1, b.PRESSURE AS X2, "
        + ", ".join(_GUARDED.format(line=oracle.ROUNDED["sql"](oracle.line("a", "b", p)), name=p) for p in PROPERTIES)
        + f""" FROM requests r JOIN up a ON {oracle.same_request('a')}
               JOIN (SELECT * FROM low UNION ALL SELECT * FROM up2) b ON {oracle.same_request('b')}""",
        "requests",
        "pvt_ended",
        ctes=oracle.neighbours("all_to_date"),
    )
)
def pvt_interp_guarded(field: Field) -> DataFrame:
    """The guarded line between the upper point and the lower or second upper
    point: NULL in the second case, where the request lies outside both."""
    found = bracket(_asked(field), field.pvt).filter(F.col("UPPER").isNotNull())
    others = found.withColumn("__other", F.explode(F.array("LOWER", "UPPER2"))).filter("__other IS NOT NULL")
    a, b, x = F.col("UPPER"), F.col("__other"), F.col("PRESSURE")
    return others.select(
        "ID_COMPLETION",
        "VRR_DATE",
        "PRESSURE",
        a["PRESSURE"].alias("X1"),
        b["PRESSURE"].alias("X2"),
        *(
            ROUNDING["sql"](interpolate(a["PRESSURE"], b["PRESSURE"], a[p], b[p], x, guarded=True)).alias(p)
            for p in PROPERTIES
        ),
    )


@register(oracle.lookup(only=("extrap_low",)))
def pvt_extrap_low(field: Field) -> DataFrame:
    return _branch(field, "extrap_low")


@register(oracle.lookup(only=("extrap_high",)))
def pvt_extrap_high(field: Field) -> DataFrame:
    return _branch(field, "extrap_high")


@register(oracle.lookup(only=("single_low", "single_up")))
def pvt_single(field: Field) -> DataFrame:
    return _branch(field, "single")


@register(oracle.lookup(only=("none",)))
def pvt_none(field: Field) -> DataFrame:
    return _branch(field, "none")


@register(oracle.lookup())
def pvt_full_all(field: Field) -> DataFrame:
    return pvt_lookup(_asked(field), field.pvt)


@register(oracle.lookup("active"))
def pvt_full_active(field: Field) -> DataFrame:
    return pvt_lookup(_asked(field), field.pvt, scope="active")


@register(oracle.lookup(policy="low_only"))
def pvt_low_only(field: Field) -> DataFrame:
    return pvt_lookup(_asked(field), field.pvt, policy="low_only")


@register(oracle.lookup(policy="low_only_null", rounding="half_up"))
def pvt_low_only_null(field: Field) -> DataFrame:
    return pvt_lookup(_asked(field), field.pvt, policy="low_only_null", rounding="half_up")


@register(oracle.lookup(policy="nearest"))
def pvt_nearest(field: Field) -> DataFrame:
    return pvt_lookup(_asked(field), field.pvt, policy="nearest")


@register(oracle.lookup())
def union_branches(field: Field) -> DataFrame:
    """The lookup again, as a union of one-point and two-point answers over one bracket join.

    The bracket is read once: each request is tagged with its branch, then sent as one
    narrow row per property set of the points that its branch needs.
    """
    named = with_branch(packed_bracket(_asked(field), field.pvt), "full")
    # One pass makes the two kinds of rows that the union consists of.
    kinds = F.array(
        F.struct(F.lit("line").alias("kind"), F.col("__b").isNotNull().alias("ours")),
        F.struct(F.lit("flat").alias("kind"), F.col("__b").isNull().alias("ours")),
    )
    tagged = with_line(named).withColumn("__kind", F.explode(F.filter(kinds, lambda k: k["ours"])))
    return tagged.select(
        "ID_COMPLETION",
        "VRR_DATE",
        "PRESSURE",
        "BRANCH",
        F.col("__a.PRESSURE").alias("POINT_PRESSURE"),
        *(
            ROUNDING["sql"](
                F.when(F.col("__kind.kind") == "line", property_value(p)).otherwise(
                    F.get(F.col("__a.VALUES"), F.lit(k))
                )
            ).alias(p)
            for k, p in enumerate(PROPERTIES)
        ),
    )


@register(oracle.lookup(only=("interp", "extrap_low")))
def sql_scalar_udf(field: Field) -> DataFrame:
    """Both straight-line branches through the SQL scalar functions."""
    spark = field.pvt.sparkSession
    sqlapi.register_line_functions(spark)
    chosen = with_branch(bracket(_asked(field), field.pvt), "full").filter(
        F.col("BRANCH").isin("interp", "extrap_low")
    )
    values = ", ".join(
        f"""round(CASE BRANCH WHEN 'interp' THEN interpolate(a.PRESSURE, b.PRESSURE, a.{p}, b.{p}, PRESSURE)
            ELSE extrapolate(a.PRESSURE, b.PRESSURE, a.{p}, b.{p}, PRESSURE) END, 5) AS {p}"""
        for p in PROPERTIES
    )
    return spark.sql(
        "SELECT ID_COMPLETION, VRR_DATE, PRESSURE, BRANCH, a.PRESSURE AS POINT_PRESSURE, "
        + values
        + " FROM {chosen}",
        chosen=chosen.withColumnsRenamed({"__a": "a", "__b": "b"}),
    )


# Besides the requests of the report: a completion that does not exist, and pressures and dates beside all of theirs.
_ANY = """
    SELECT ID_COMPLETION, VRR_DATE, PRESSURE FROM {asked}
    UNION ALL SELECT 'Z' || ID_COMPLETION, VRR_DATE, PRESSURE FROM {asked} WHERE PRESSURE > 2000
    UNION ALL SELECT ID_COMPLETION, VRR_DATE + 40, PRESSURE + 17.25 FROM {asked}"""


@register(
    oracle.lookup(
        requests=f"""
        WITH asked AS (SELECT DISTINCT ID_COMPLETION, p.DATE AS VRR_DATE, PRESSURE
                       FROM contribution_factor JOIN pattern_pressure p USING (ID_PATTERN)) {_ANY.format(asked='asked')}"""
    )
)
def sql_table_function(field: Field) -> DataFrame:
    """The table function, called LATERAL with arguments that nobody told it before."""
    spark = field.pvt.sparkSession
    sqlapi.register_lookup_function(spark, field.pvt)
    return spark.sql(
        f"""SELECT r.ID_COMPLETION, r.VRR_DATE, r.PRESSURE, a.*
           FROM ({_ANY}) r, LATERAL pvt_at(r.PRESSURE, r.ID_COMPLETION, r.VRR_DATE) a""",
        asked=_asked(field),
    )


@register(oracle.lookup(requests="SELECT DISTINCT ID_COMPLETION, p.DATE + 40 AS VRR_DATE, PRESSURE + 17.25 AS PRESSURE"
                        " FROM contribution_factor JOIN pattern_pressure p USING (ID_PATTERN)"))
def pvt_indexed(field: Field) -> DataFrame:
    """The lookup from an index: one of the tests before 1996 is stored, then it gets the later tests and is read."""
    name = f"curves_{uuid.uuid4().hex}"
    early = F.col("TEST_DATE") < "1996-01-01"
    store_index(field.pvt.filter(early), name, buckets=8)
    index = refresh_index(field.pvt.filter(~early), name)
    asked = _asked(field).select(
        "ID_COMPLETION", F.date_add("VRR_DATE", 40).alias("VRR_DATE"), (F.col("PRESSURE") + 17.25).alias("PRESSURE")
    )
    return pvt_lookup(asked, index)


@register(
    with_tables(
        f"""SELECT r.ID_COMPLETION, r.VRR_DATE, count(*) AS REQUESTS,
                   count(*) FILTER (a.BRANCH = 'interp') AS INTERPOLATED,
                   max(a.OIL_FORMATION_VOLUME_FACTOR) AS MOST_OIL
            FROM requests r JOIN answers a ON a.ID_COMPLETION = r.ID_COMPLETION
             AND a.VRR_DATE = r.VRR_DATE AND a.PRESSURE = r.PRESSURE
            GROUP BY ALL""",
        "requests",
        "pvt_ended",
        ctes={
            **oracle.neighbours("all_to_date"),
            "answers": " UNION ALL ".join(oracle.branches("full").values()),
        },
    )
)
def view_over_view(field: Field) -> DataFrame:
    """A view that reads the lookup view."""
    spark = field.pvt.sparkSession
    (view,) = sqlapi.register_views(
        spark, field.volumes, field.factors, field.pressures, field.pvt, views=sqlapi.VIEWS[:1], prefix="check_"
    )
    return spark.sql(
        f"""SELECT ID_COMPLETION, VRR_DATE, count(*) AS REQUESTS,
                  count_if(BRANCH = 'interp') AS INTERPOLATED,
                  max(OIL_FORMATION_VOLUME_FACTOR) AS MOST_OIL
           FROM {view} GROUP BY ID_COMPLETION, VRR_DATE"""
    )
