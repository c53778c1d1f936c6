"""Queries that exercise windows, grouping and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from voidage.catalog import oracle
from voidage.catalog.oracle import settled, with_tables
from voidage.catalog.registry import register
from voidage.functions.numeric import settle
from voidage.operators.curves import bracket
from voidage.operators.extremes import first_rows
from voidage.operators.intervals import next_distinct_date as next_date
from voidage.operators.running import running_totals
from voidage.plans.pvt import requests_by_factor
from voidage.plans.vrr import pressure_in_force
from voidage.sources.derived import Field


@register(with_tables("SELECT ID_COMPLETION, TEST_DATE, PRESSURE, VISCOSITY_OIL, END_DATE FROM pvt_ended", "pvt_ended"))
def next_distinct_date(field: Field) -> DataFrame:
    points = field.pvt.select("ID_COMPLETION", "TEST_DATE", "PRESSURE", "VISCOSITY_OIL")
    return next_date(points, ["ID_COMPLETION"], "TEST_DATE")


@register(
    with_tables(
        """SELECT ID_COMPLETION, TEST_DATE, PRESSURE,
                  coalesce(lead(TEST_DATE) OVER (PARTITION BY ID_COMPLETION ORDER BY TEST_DATE, PRESSURE),
                           DATE '9999-12-31') AS END_DATE
           FROM pvt""",
        "pvt",
    )
)
def lead_date_ties(field: Field) -> DataFrame:
    """LEAD over rows that share a date: all but the last of a date end that day.

    The row after the last of a date is the first of the next date, so the
    window only needs the rows of one test; completions are not sorted whole.
    """
    points = next_date(field.pvt.select("ID_COMPLETION", "TEST_DATE", "PRESSURE"), ["ID_COMPLETION"], "TEST_DATE")
    test = W.partitionBy("ID_COMPLETION", "TEST_DATE").orderBy("PRESSURE")
    return points.withColumn("END_DATE", F.coalesce(F.lead("TEST_DATE").over(test), "END_DATE"))


@register(
    with_tables(
        """SELECT *, row_number() OVER (PARTITION BY ID_PATTERN, ID_COMPLETION ORDER BY EFFECT_DATE DESC) AS RN
           FROM contribution_factor""",
        "contribution_factor",
    )
)
def rank_latest(field: Field) -> DataFrame:
    latest_first = W.partitionBy("ID_PATTERN", "ID_COMPLETION").orderBy(F.col("EFFECT_DATE").desc())
    return field.factors.withColumn("RN", F.row_number().over(latest_first).cast("bigint"))


_POINT = ("ID_COMPLETION", "TEST_DATE", "PRESSURE", "OIL_FORMATION_VOLUME_FACTOR")


@register(
    with_tables(
        f"""SELECT {', '.join(_POINT)} FROM pvt
            QUALIFY row_number() OVER (PARTITION BY ID_COMPLETION ORDER BY TEST_DATE DESC, PRESSURE DESC) = 1""",
        "pvt",
    )
)
def qualify_top1(field: Field) -> DataFrame:
    order = [F.col("TEST_DATE").desc(), F.col("PRESSURE").desc()]
    return first_rows(field.pvt.select(*_POINT), ["ID_COMPLETION"], order)


@register(
    with_tables(
        f"""SELECT {', '.join(_POINT)} FROM pvt
            QUALIFY row_number() OVER (PARTITION BY ID_COMPLETION ORDER BY PRESSURE, TEST_DATE DESC) <= 2""",
        "pvt",
    )
)
def top2(field: Field) -> DataFrame:
    order = [F.col("PRESSURE").asc(), F.col("TEST_DATE").desc()]
    return first_rows(field.pvt.select(*_POINT), ["ID_COMPLETION"], order, 2)


@register(
    with_tables(
        """SELECT ID_PATTERN, COMPLETION_ID, PROD_DATE, AMOUNT_TYPE,
                  sum(THEOR_OIL_VOL_STB) OVER (PARTITION BY ID_PATTERN ORDER BY PROD_DATE) AS OIL_TO_DATE,
                  sum(THEOR_WATER_INJ_VOL_STB) OVER (PARTITION BY ID_PATTERN ORDER BY PROD_DATE) AS WATER_INJ_TO_DATE
           FROM daily_volume""",
        "daily_volume",
    )
)
def running_sum_range(field: Field) -> DataFrame:
    totals = {
        "OIL_TO_DATE": F.col("THEOR_OIL_VOL_STB"),
        "WATER_INJ_TO_DATE": F.col("THEOR_WATER_INJ_VOL_STB"),
    }
    running = running_totals(field.volumes, ["ID_PATTERN"], "PROD_DATE", totals)
    return running.select("ID_PATTERN", "COMPLETION_ID", "PROD_DATE", "AMOUNT_TYPE", *totals)


@register(
    with_tables(
        """SELECT ID_PATTERN, PROD_DATE, sum(THEOR_OIL_VOL_STB) AS OIL,
                  sum(sum(THEOR_OIL_VOL_STB)) OVER (PARTITION BY ID_PATTERN ORDER BY PROD_DATE) AS OIL_TO_DATE
           FROM daily_volume GROUP BY ID_PATTERN, PROD_DATE""",
        "daily_volume",
    )
)
def nested_sum_over(field: Field) -> DataFrame:
    return field.volumes.sparkSession.sql(
        """SELECT ID_PATTERN, PROD_DATE, sum(THEOR_OIL_VOL_STB) AS OIL,
                  sum(sum(THEOR_OIL_VOL_STB)) OVER (PARTITION BY ID_PATTERN ORDER BY PROD_DATE) AS OIL_TO_DATE
           FROM {volumes} GROUP BY ID_PATTERN, PROD_DATE""",
        volumes=field.volumes,
    )


@register(
    with_tables(
        f"""SELECT v.ID_PATTERN, v.PROD_DATE, p.PRESSURE AS PRESSURE_IN_FORCE, avg(p.PRESSURE) AS PRESSURE,
                   count(*) AS ROWS_IN_GROUP, sum(v.THEOR_OIL_VOL_STB) AS OIL, sum(v.FREE_GAS) AS FREE_GAS
            FROM daily_volume v JOIN pressure_ended p
              ON p.ID_PATTERN = v.ID_PATTERN AND v.PROD_DATE >= p.DATE AND v.PROD_DATE < p.END_DATE
            GROUP BY v.ID_PATTERN, v.PROD_DATE, p.PRESSURE""",
        "daily_volume",
        "pressure_ended",
    )
)
def group_three_keys(field: Field) -> DataFrame:
    return (
        pressure_in_force(field.volumes, field.pressures)
        .groupBy("ID_PATTERN", "PROD_DATE", F.col("PRESSURE").alias("PRESSURE_IN_FORCE"))
        .agg(
            F.avg("PRESSURE").alias("PRESSURE"),
            F.count(F.lit(1)).alias("ROWS_IN_GROUP"),
            F.sum("THEOR_OIL_VOL_STB").alias("OIL"),
            F.sum("FREE_GAS").alias("FREE_GAS"),
        )
    )


@register(
    with_tables(
        """SELECT ID_PATTERN, PROD_DATE, AMOUNT_TYPE, THEOR_OIL_VOL_STB, THEOR_GAS_VOL_KSCF
           FROM daily_volume GROUP BY ALL""",
        "daily_volume",
    )
)
def group_as_distinct(field: Field) -> DataFrame:
    kept = ["ID_PATTERN", "PROD_DATE", "AMOUNT_TYPE", "THEOR_OIL_VOL_STB", "THEOR_GAS_VOL_KSCF"]
    return field.volumes.select(*kept).dropDuplicates(kept)


@register(
    with_tables(
        "SELECT DISTINCT ID_COMPLETION, p.DATE AS VRR_DATE FROM contribution_factor JOIN pattern_pressure p USING (ID_PATTERN)",
        "contribution_factor",
        "pattern_pressure",
    )
)
def distinct_requests(field: Field) -> DataFrame:
    members = field.factors.select("ID_COMPLETION", "ID_PATTERN").distinct()
    dates = field.pressures.select("ID_PATTERN", F.col("DATE").alias("VRR_DATE"))
    return members.join(dates, "ID_PATTERN").select("ID_COMPLETION", "VRR_DATE").distinct()


@register(
    with_tables(
        """SELECT r.*, count(*) FILTER (k.PRESSURE < k.X) AS BELOW, count(*) FILTER (k.PRESSURE > k.X) AS ABOVE,
                  count(*) FILTER (k.PRESSURE > k.X) > 1 AS CAN_EXTEND_LOW
           FROM requests r LEFT JOIN known k
             ON k.ID_COMPLETION = r.ID_COMPLETION AND k.VRR_DATE = r.VRR_DATE AND k.X = r.PRESSURE
           GROUP BY ALL""",
        "requests",
        "pvt_ended",
        ctes={"known": oracle.known("all_to_date")},
    )
)
def count_threshold(field: Field) -> DataFrame:
    """Known points below and above each request, and whether more than one is above."""
    found = bracket(requests_by_factor(field.factors, field.pressures), field.pvt)
    return found.select(
        "ID_COMPLETION", "VRR_DATE", "PRESSURE", "BELOW", "ABOVE", (F.col("ABOVE") > 1).alias("CAN_EXTEND_LOW")
    )


@register(
    with_tables(
        f"""SELECT ID_COMPLETION, min(PRESSURE) AS LOWEST, max(PRESSURE) AS HIGHEST,
                   min(TEST_DATE) AS FIRST_TEST, max(TEST_DATE) AS LAST_TEST, count(*) AS POINTS,
                   count(*) FILTER (VISCOSITY_GAS IS NULL) AS WITHOUT_GAS_VISCOSITY,
                   {settled('avg(VISCOSITY_OIL)', 6)} AS MEAN_VISCOSITY_OIL,
                   min(PRESSURE) = (SELECT min(PRESSURE) FROM pvt) AS HAS_FIELD_LOWEST
            FROM pvt GROUP BY ID_COMPLETION""",
        "pvt",
    )
)
def min_max_by_key(field: Field) -> DataFrame:
    lowest = field.pvt.agg(F.min("PRESSURE")).scalar()
    return (
        field.pvt.groupBy("ID_COMPLETION")
        .agg(
            F.min("PRESSURE").alias("LOWEST"),
            F.max("PRESSURE").alias("HIGHEST"),
            F.min("TEST_DATE").alias("FIRST_TEST"),
            F.max("TEST_DATE").alias("LAST_TEST"),
            F.count(F.lit(1)).alias("POINTS"),
            F.count_if(F.col("VISCOSITY_GAS").isNull()).alias("WITHOUT_GAS_VISCOSITY"),
            settle(F.avg("VISCOSITY_OIL"), 6).alias("MEAN_VISCOSITY_OIL"),
        )
        .withColumn("HAS_FIELD_LOWEST", F.col("LOWEST") == lowest)
    )
