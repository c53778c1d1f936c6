"""Queries over single tables: scans, projections, scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from voidage.catalog.oracle import settled, with_tables
from voidage.catalog.registry import register
from voidage.functions.dates import month_end, pattern_key
from voidage.functions.numeric import ROUNDING, ratio_or_zero, round_binary, round_half_up, settle
from voidage.functions.volumes import scf
from voidage.plans.pvt import pvt_stub, requests_by_factor
from voidage.sources.derived import Field
from voidage.sources.schemas import PROPERTIES
from voidage.sources.tables import known_points

KNOWN_BY = dt.date(1997, 12, 31)


@register(with_tables("SELECT * FROM pvt", "pvt"))
def scan_pvt(field: Field) -> DataFrame:
    return field.pvt


@register(with_tables("SELECT * FROM pattern_pressure", "pattern_pressure"))
def scan_pattern_pressure(field: Field) -> DataFrame:
    return field.pressures


@register(with_tables("SELECT * FROM contribution_factor", "contribution_factor"))
def scan_contribution_factor(field: Field) -> DataFrame:
    return field.factors


@register(with_tables("SELECT * FROM daily_volume", "daily_volume"))
def scan_daily_volume(field: Field) -> DataFrame:
    return field.volumes


@register(
    with_tables(
        f"""SELECT * FROM pvt WHERE TEST_DATE <= DATE '{KNOWN_BY}'
            AND ID_COMPLETION IN (SELECT ID_COMPLETION FROM contribution_factor)""",
        "pvt",
        "contribution_factor",
    )
)
def bound_scan(field: Field) -> DataFrame:
    """The bound date is a SQL parameter, the completions asked for are a table."""
    asked = field.factors.select("ID_COMPLETION").distinct()
    spark = field.pvt.sparkSession
    return known_points(spark, field.pvt, KNOWN_BY, asked=asked)


_NULLS = ", ".join(f"CAST(NULL AS DOUBLE) AS {p}" for p in PROPERTIES)


@register(with_tables(f"SELECT *, {_NULLS} FROM requests", "requests"), name="pvt_stub")
def stub_rows(field: Field) -> DataFrame:
    return pvt_stub(requests_by_factor(field.factors, field.pressures))


@register(
    with_tables(
        """SELECT COMPLETION_ID AS ID_COMPLETION, PROD_DATE AS DATE, CAST(ID_PATTERN AS VARCHAR) AS ID_PATTERN,
                  THEOR_OIL_VOL_STB AS OIL, THEOR_GAS_VOL_KSCF * 1000 AS GAS_SCF,
                  ALLOC_GAS_VOL_KSCF * 1000 AS GAS_WELL_GAS_SCF, THEOR_GAS_INJ_VOL_KSCF * 1000 AS GAS_INJ_SCF,
                  CAST(FREE_GAS AS BIGINT) AS FREE_GAS_WHOLE
           FROM daily_volume""",
        "daily_volume",
    )
)
def typed_projection(field: Field) -> DataFrame:
    return field.volumes.select("*").select(
        F.col("COMPLETION_ID").alias("ID_COMPLETION"),
        F.col("PROD_DATE").cast("date").alias("DATE"),
        F.col("ID_PATTERN").cast("varchar(32)").alias("ID_PATTERN"),
        F.col("THEOR_OIL_VOL_STB").cast("double").alias("OIL"),
        scf(F.col("THEOR_GAS_VOL_KSCF")).alias("GAS_SCF"),
        scf(F.col("ALLOC_GAS_VOL_KSCF")).alias("GAS_WELL_GAS_SCF"),
        scf(F.col("THEOR_GAS_INJ_VOL_KSCF")).alias("GAS_INJ_SCF"),
        F.col("FREE_GAS").cast("bigint").alias("FREE_GAS_WHOLE"),
    )


@register(
    with_tables(
        """SELECT ID_PATTERN || strftime(DATE, '%d-%m-%Y') AS ID_PATTERN_VRR, ID_PATTERN, DATE, PRESSURE
           FROM pattern_pressure""",
        "pattern_pressure",
    ),
    name="pattern_key",
)
def pattern_keys(field: Field) -> DataFrame:
    return field.pressures.select(
        pattern_key(F.col("ID_PATTERN"), F.col("DATE")).alias("ID_PATTERN_VRR"),
        "ID_PATTERN",
        "DATE",
        "PRESSURE",
    )


_ROUNDED = ", ".join(f"round({p} / 3, 5) AS {p}" for p in ("PRESSURE", *PROPERTIES))


@register(with_tables(f"SELECT ID_COMPLETION, TEST_DATE, {_ROUNDED} FROM pvt", "pvt"))
def round_properties(field: Field) -> DataFrame:
    """Thirds of every property, rounded to five places; NULL stays NULL."""
    return field.pvt.select(
        "ID_COMPLETION",
        "TEST_DATE",
        *(ROUNDING["sql"](F.col(p) / 3).alias(p) for p in ("PRESSURE", *PROPERTIES)),
    )


@register(
    with_tables(
        """SELECT ID_PATTERN, DATE, last_day(DATE) AS MONTH_END,
                  strftime(DATE, '%d-%m-%Y') AS NUMERIC_DAY, strftime(DATE, '%d-%b-%Y') AS NAMED_DAY,
                  CAST(strptime(strftime(DATE, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS PARSED,
                  CAST(CAST('9999-12-31 00:00:00' AS TIMESTAMP) AS DATE) AS OPEN_END,
                  last_day(DATE) < DATE '1998-07-01' AS BEFORE_CUTOFF
           FROM pattern_pressure""",
        "pattern_pressure",
    )
)
def date_functions(field: Field) -> DataFrame:
    date = F.col("DATE")
    return field.pressures.select(
        "ID_PATTERN",
        "DATE",
        month_end(date).alias("MONTH_END"),
        F.date_format(date, "dd-MM-yyyy").alias("NUMERIC_DAY"),
        F.date_format(date, "dd-MMM-yyyy").alias("NAMED_DAY"),
        F.to_date(F.date_format(date, "dd-MM-yyyy"), "dd-MM-yyyy").alias("PARSED"),
        F.to_timestamp(F.lit("9999-12-31 00:00:00")).cast("date").alias("OPEN_END"),
        (month_end(date) < F.lit("1998-07-01").cast("date")).alias("BEFORE_CUTOFF"),
    )


@register(
    with_tables(
        f"""SELECT ID_PATTERN, COMPLETION_ID, PROD_DATE, AMOUNT_TYPE,
                   coalesce(THEOR_WATER_VOL_STB, THEOR_WATER_INJ_VOL_STB, 0) AS ANY_WATER,
                   nullif(THEOR_OIL_VOL_STB, 0) AS OIL_OR_NULL,
                   {settled('coalesce(THEOR_GAS_VOL_KSCF * 1000 / nullif(THEOR_OIL_VOL_STB, 0), 0)', 4)} AS GAS_OIL_RATIO,
                   CASE WHEN AMOUNT_TYPE = 'Production' THEN coalesce(FREE_GAS, 0) ELSE 0 END AS PRODUCED_FREE_GAS
            FROM daily_volume""",
        "daily_volume",
    )
)
def null_case_functions(field: Field) -> DataFrame:
    return field.volumes.select(
        "ID_PATTERN",
        "COMPLETION_ID",
        "PROD_DATE",
        "AMOUNT_TYPE",
        F.coalesce("THEOR_WATER_VOL_STB", "THEOR_WATER_INJ_VOL_STB", F.lit(0.0)).alias("ANY_WATER"),
        F.nullif("THEOR_OIL_VOL_STB", F.lit(0.0)).alias("OIL_OR_NULL"),
        settle(ratio_or_zero(scf(F.col("THEOR_GAS_VOL_KSCF")), F.col("THEOR_OIL_VOL_STB")), 4).alias(
            "GAS_OIL_RATIO"
        ),
        F.when(F.col("AMOUNT_TYPE") == "Production", F.coalesce("FREE_GAS", F.lit(0.0)))
        .otherwise(0.0)
        .alias("PRODUCED_FREE_GAS"),
    )


@register(
    with_tables(
        """SELECT ID_COMPLETION, TEST_DATE, PRESSURE,
                  round(-GAS_FORMATION_VOLUME_FACTOR, 5) AS AWAY_FROM_ZERO,
                  floor(-GAS_FORMATION_VOLUME_FACTOR * 100000 + 0.5) / 100000 AS HALF_UP,
                  CAST(printf('%.5f', -GAS_FORMATION_VOLUME_FACTOR) AS DOUBLE) AS HALF_EVEN
           FROM pvt""",
        "pvt",
    )
)
def rounding_modes(field: Field) -> DataFrame:
    """Negative values tell the three rules apart on halves."""
    value = -F.col("GAS_FORMATION_VOLUME_FACTOR")
    return field.pvt.select(
        "ID_COMPLETION",
        "TEST_DATE",
        "PRESSURE",
        ROUNDING["sql"](value).alias("AWAY_FROM_ZERO"),
        round_half_up(value).alias("HALF_UP"),
        ROUNDING["half_even"](value).alias("HALF_EVEN"),
    )


# Besides the factors themselves, which are halves of the binary value where they are odd multiples of
# 1/64, the doubles nearest to decimal halves, and their neighbours.
_BESIDE_HALVES = """
    SELECT ID_COMPLETION, TEST_DATE, PRESSURE, {k} AS STEP,
           (floor(1000 * PRESSURE * VISCOSITY_OIL) + 0.5D) / 100000 * (1 + {k} / 4503599627370496D) AS VALUE"""


@register(
    with_tables(
        "SELECT *, CAST(printf('%.5f', VALUE) AS DOUBLE) AS HALF_EVEN, CAST(printf('%.3f', -VALUE) AS DOUBLE) AS THREE_PLACES"
        f" FROM ({_BESIDE_HALVES.format(k='k').replace('0.5D', '0.5::DOUBLE').replace('6D', '6::DOUBLE')}"
        " FROM pvt, (VALUES (-1), (0), (1)) AS s(k))",
        "pvt",
    )
)
def round_exact_binary(field: Field) -> DataFrame:
    """Halves to even of values next to halves, by their exact binary value."""
    steps = field.pvt.withColumn("k", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    spark = field.pvt.sparkSession
    beside = spark.sql(f"{_BESIDE_HALVES.format(k='k')} FROM {{steps}}", steps=steps)
    value = F.col("VALUE")
    return beside.select(
        "*", round_binary(value).alias("HALF_EVEN"), round_binary(-value, 3).alias("THREE_PLACES")
    )
