"""Queries over split volumes, the rollup and the ratio reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from voidage.catalog import oracle
from voidage.catalog.joins import DAY, factor_match
from voidage.catalog.oracle import settled, with_tables
from voidage.catalog.registry import register
from voidage.functions.numeric import settle
from voidage.functions.volumes import allocated_volumes
from voidage.plans import relations
from voidage.plans.stored import refresh_rollup, store_rollup, stored_view
from voidage.plans.vrr import (
    VRR_COLUMNS,
    ratios,
    rollup,
    rollup_with_cumulatives,
    splits,
    vrr_report as report,
    vrr_view,
    with_factor,
)
from voidage.sources.derived import Field
from voidage.sources.schemas import PROPERTIES
from voidage.sources.tables import read_daily_volumes, store_daily_volumes

# Decimal places kept in the checks: ratios four, sums of doubles three.
_EXACT = ("ID_PATTERN_VRR", "ID_PATTERN", "DATE", "PRESSURE")
_RATIOS = ("VRR", "CUMULATIVE_VRR")


def _places(name: str) -> int:
    return 4 if name in _RATIOS else 3


def _settled(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    def column(name: str) -> Column:
        return F.col(name) if name in _EXACT else settle(F.col(name), _places(name)).alias(name)

    return df.select(*(column(name) for name in columns))


def _settled_sql(columns: tuple[str, ...]) -> str:
    return ", ".join(c if c in _EXACT else f"{settled(c, _places(c))} AS {c}" for c in columns)


# ---------------------------------------------------------------- oracle text

# Stored volumes by the share f of a daily row v; gas is stored in thousands.
_ALLOCATED_SQL = {
    "OIL_VOLUME": "coalesce(v.THEOR_OIL_VOL_STB * f.FACTOR, v.THEOR_OIL_VOL_STB, 0)",
    "WATER_VOLUME": "coalesce(v.THEOR_WATER_VOL_STB * f.FACTOR, v.THEOR_WATER_VOL_STB, 0)",
    "GAS_VOLUME": "coalesce(v.THEOR_GAS_VOL_KSCF * 1000 * f.FACTOR, v.THEOR_GAS_VOL_KSCF * 1000, 0)",
    "WATER_INJ_VOLUME": "coalesce(v.THEOR_WATER_INJ_VOL_STB * f.FACTOR, v.THEOR_WATER_INJ_VOL_STB, 0)",
    "GAS_WELL_GAS_VOLUME": "coalesce(v.ALLOC_GAS_VOL_KSCF * 1000 * f.FACTOR, v.ALLOC_GAS_VOL_KSCF * 1000, 0)",
    "GAS_INJ_VOLUME": "coalesce(v.THEOR_GAS_INJ_VOL_KSCF * 1000 * f.FACTOR, v.THEOR_GAS_INJ_VOL_KSCF * 1000, 0)",
}

_ABOVE_SOLUTION = (
    "coalesce((v.THEOR_GAS_VOL_KSCF * 1000 / nullif(v.THEOR_OIL_VOL_STB, 0) - a.SOLUTION_GAS_OIL_RATIO)"
    " * v.THEOR_OIL_VOL_STB * f.FACTOR * a.{factor}, 0)"
)
_FREE_GAS_SQL = {
    "gor": "CASE WHEN v.AMOUNT_TYPE = 'Production' THEN "
    + _ABOVE_SOLUTION.format(factor="GAS_FORMATION_VOLUME_FACTOR")
    + " ELSE 0 END",
    "stored": "CASE WHEN v.AMOUNT_TYPE = 'Production' THEN"
    " coalesce(v.FREE_GAS * f.FACTOR * a.GAS_FORMATION_VOLUME_FACTOR, v.FREE_GAS, 0) ELSE 0 END",
    "untyped": _ABOVE_SOLUTION.format(factor="INJECTED_GAS_FORMATION_VOLUME_FACTOR"),
}


def _shares_ctes(
    factor: str, pressure_key: str, gas_rule: str, require_gas: bool, scope: str = "all_to_date", policy: str = "full"
) -> dict[str, str]:
    """CTEs up to ``shares``: one row per daily row, factor and pressure."""
    pattern = "f.FACTOR_PATTERN" if pressure_key == "factor" else "v.ID_PATTERN"
    gas = "WHERE v.THEOR_GAS_VOL_KSCF IS NOT NULL" if require_gas else ""
    volumes = ", ".join(f"{sql} AS {name}" for name, sql in _ALLOCATED_SQL.items())
    props = ", ".join(f"a.{p}" for p in PROPERTIES)
    asked = {}
    if pressure_key == "volume":
        asked["requests"] = """
            SELECT DISTINCT v.COMPLETION_ID AS ID_COMPLETION, p.DATE AS VRR_DATE, p.PRESSURE
            FROM pattern_pressure p JOIN daily_volume v ON v.ID_PATTERN = p.ID_PATTERN"""
    return {
        **asked,
        **oracle.neighbours(scope),
        "answers": " UNION ALL ".join(oracle.branches(policy).values()),
        "matched": factor_match(factor),
        "shares": f"""
            SELECT v.ID_PATTERN, v.COMPLETION_ID AS ID_COMPLETION, f.FACTOR_PATTERN, v.PROD_DATE AS DATE,
                   v.AMOUNT_TYPE, {volumes}, {_FREE_GAS_SQL[gas_rule]} AS FREE_GAS,
                   f.FACTOR, p.PRESSURE, {props}
            FROM daily_volume v
            LEFT JOIN matched f ON f.COMPLETION_ID = v.COMPLETION_ID AND f.PROD_DATE = v.PROD_DATE
                               AND f.AMOUNT_TYPE = v.AMOUNT_TYPE
            JOIN pressure_ended p ON p.ID_PATTERN = {pattern}
                                 AND v.PROD_DATE >= p.DATE AND v.PROD_DATE < p.END_DATE
            LEFT JOIN answers a ON a.ID_COMPLETION = v.COMPLETION_ID AND a.VRR_DATE = p.DATE
                               AND a.PRESSURE = p.PRESSURE
            {gas}""",
    }


_OIL = "sum(OIL_VOLUME * OIL_FORMATION_VOLUME_FACTOR)"
_WATER = "sum(WATER_VOLUME * WATER_FORMATION_VOLUME_FACTOR)"
_WINJ = "sum(WATER_INJ_VOLUME * INJECTED_WATER_FORMATION_VOLUME_FACTOR)"
_GINJ = "sum(GAS_INJ_VOLUME * INJECTED_GAS_FORMATION_VOLUME_FACTOR)"


def _to_date(x: str) -> str:
    return f"sum({x}) OVER (PARTITION BY ID_PATTERN ORDER BY DATE)"


_ROLLED = f"""
    SELECT ID_PATTERN, DATE, avg(PRESSURE) AS PRESSURE,
           sum(OIL_VOLUME) AS OIL_VOLUME_STB, sum(WATER_VOLUME) AS WATER_VOLUME_STB,
           {_OIL} AS OIL_VOLUME_RES_BBL, {_WATER} AS WATER_VOLUME_RES_BBL,
           sum(WATER_INJ_VOLUME) AS WATER_INJ_VOLUME_STB, {_WINJ} AS WATER_INJ_VOLUME_RES_BBL,
           sum(GAS_WELL_GAS_VOLUME) AS GAS_WELL_GAS_VOLUME_SCF, sum(GAS_INJ_VOLUME) AS GAS_INJ_VOLUME_SCF,
           sum(GAS_VOLUME) AS GAS_VOLUME_SCF, sum(FREE_GAS) AS FREE_GAS, {_GINJ} AS GAS_INJ_VOLUME_RES_BBL,
           sum(SOLUTION_GAS_OIL_RATIO) AS SOLUTION_GAS_OIL_RATIO,
           {_OIL} + {_WATER} + sum(FREE_GAS) AS PRODUCTION_VOLUME_RES_BBL,
           {_WINJ} + {_GINJ} AS INJECTION_VOLUME_RES_BBL,
           {_to_date(_OIL)} AS CUMULATIVE_OIL_PRODUCTION_VOLUME_RES_BBL,
           {_to_date(_WATER)} AS CUMULATIVE_WATER_PRODUCTION_VOLUME_RES_BBL,
           {_to_date(_WINJ)} AS CUMULATIVE_WATER_INJECTION_VOLUME_RES_BBL,
           {_to_date(_GINJ)} AS CUMULATIVE_GAS_INJECTION_VOLUME_RES_BBL,
           {_to_date(f'{_OIL} + {_WATER}')} AS CUMULATIVE_PRODUCTION_VOLUME_RES_BBL,
           {_to_date(f'{_WINJ} + {_GINJ}')} AS CUMULATIVE_INJECTION_VOLUME_RES_BBL
    FROM shares GROUP BY ID_PATTERN, DATE, shares.PRESSURE"""

_RATED = """
    SELECT *, ID_PATTERN || strftime(DATE, '%d-%m-%Y') AS ID_PATTERN_VRR,
           coalesce(INJECTION_VOLUME_RES_BBL / nullif(PRODUCTION_VOLUME_RES_BBL, 0), 0) AS VRR,
           coalesce(CUMULATIVE_INJECTION_VOLUME_RES_BBL
                    / nullif(CUMULATIVE_PRODUCTION_VOLUME_RES_BBL, 0), 0) AS CUMULATIVE_VRR
    FROM rolled"""


def _rolled_sql(
    columns: tuple[str, ...],
    factor: str = "pair",
    pressure_key: str = "factor",
    gas_rule: str = "gor",
    require_gas: bool = False,
    where: str = "",
    scope: str = "all_to_date",
    policy: str = "full",
) -> str:
    tables = ["daily_volume", "contribution_factor", "pressure_ended", "pvt_ended"]
    if pressure_key == "factor":
        tables.append("requests")
    return with_tables(
        f"SELECT {_settled_sql(columns)} FROM rated {where}",
        *tables,
        ctes={
            **_shares_ctes(factor, pressure_key, gas_rule, require_gas, scope, policy),
            "rolled": _ROLLED,
            "rated": _RATED,
        },
    )


def _view_sql(**options) -> str:
    return _rolled_sql(VRR_COLUMNS, where="WHERE CUMULATIVE_PRODUCTION_VOLUME_RES_BBL <> 0", **options)


# ------------------------------------------------------------------- queries


def _view(field: Field, **options) -> DataFrame:
    view = vrr_view(field.volumes, field.factors, field.pressures, field.pvt, **options)
    return _settled(view, VRR_COLUMNS)


def _shares(field: Field, **options) -> DataFrame:
    return splits(field.volumes, field.factors, field.pressures, field.pvt, **options)


@register(
    with_tables(
        "SELECT v.ID_PATTERN, v.COMPLETION_ID, v.PROD_DATE, v.AMOUNT_TYPE, f.FACTOR_PATTERN, "
        + ", ".join(f"{sql} AS {name}" for name, sql in _ALLOCATED_SQL.items())
        + """ FROM daily_volume v LEFT JOIN matched f ON f.COMPLETION_ID = v.COMPLETION_ID
              AND f.PROD_DATE = v.PROD_DATE AND f.AMOUNT_TYPE = v.AMOUNT_TYPE""",
        "daily_volume",
        "contribution_factor",
        ctes={"matched": factor_match("pair")},
    ),
    name="allocated_volumes",
)
def allocated(field: Field) -> DataFrame:
    shares = with_factor(field.volumes, field.factors, "pair")
    return shares.select(*DAY, "FACTOR_PATTERN", *allocated_volumes(F.col("FACTOR")))


def _free_gas_sql(gas_rule: str, factor: str = "pair") -> str:
    return with_tables(
        f"""SELECT ID_PATTERN, ID_COMPLETION, DATE, PRESSURE, FACTOR,
                   {settled('FREE_GAS', 4)} AS FREE_GAS FROM shares""",
        "daily_volume",
        "contribution_factor",
        "pressure_ended",
        "pvt_ended",
        "requests",
        ctes=_shares_ctes(factor, "factor", gas_rule, False),
    )


def _free_gas(field: Field, gas_rule: str, factor: str = "pair") -> DataFrame:
    shares = _shares(field, factor=factor, gas_rule=gas_rule)
    return shares.select(
        "ID_PATTERN",
        "ID_COMPLETION",
        "DATE",
        "PRESSURE",
        "FACTOR",
        settle(F.col("FREE_GAS"), 4).alias("FREE_GAS"),
    )


@register(_free_gas_sql("gor"))
def free_gas_gor(field: Field) -> DataFrame:
    return _free_gas(field, "gor")


@register(_free_gas_sql("stored", "latest"))
def free_gas_stored(field: Field) -> DataFrame:
    return _free_gas(field, "stored", "latest")


@register(_free_gas_sql("untyped"))
def free_gas_untyped(field: Field) -> DataFrame:
    return _free_gas(field, "untyped")


_ROLLUP_COLUMNS = (
    "ID_PATTERN",
    "DATE",
    "PRESSURE",
    "OIL_VOLUME_STB",
    "WATER_VOLUME_STB",
    "OIL_VOLUME_RES_BBL",
    "WATER_VOLUME_RES_BBL",
    "WATER_INJ_VOLUME_STB",
    "WATER_INJ_VOLUME_RES_BBL",
    "GAS_WELL_GAS_VOLUME_SCF",
    "GAS_INJ_VOLUME_SCF",
    "GAS_VOLUME_SCF",
    "FREE_GAS",
    "GAS_INJ_VOLUME_RES_BBL",
    "SOLUTION_GAS_OIL_RATIO",
    "PRODUCTION_VOLUME_RES_BBL",
    "INJECTION_VOLUME_RES_BBL",
)


@register(_rolled_sql(_ROLLUP_COLUMNS))
def reservoir_rollup(field: Field) -> DataFrame:
    return _settled(rollup(_shares(field)), _ROLLUP_COLUMNS)


_CUMULATIVE = ("ID_PATTERN", "DATE", "PRESSURE", *(c for c in VRR_COLUMNS if c.startswith("CUMULATIVE_") and c != "CUMULATIVE_VRR"))


@register(_rolled_sql(_CUMULATIVE))
def cumulative_series(field: Field) -> DataFrame:
    return _settled(rollup_with_cumulatives(_shares(field)), _CUMULATIVE)


_DAILY = (*_EXACT, "VRR", "INJECTION_VOLUME_RES_BBL", "PRODUCTION_VOLUME_RES_BBL")
_TO_DATE = (
    *_EXACT,
    "CUMULATIVE_VRR",
    "CUMULATIVE_INJECTION_VOLUME_RES_BBL",
    "CUMULATIVE_PRODUCTION_VOLUME_RES_BBL",
)


@register(_rolled_sql(_DAILY))
def vrr_daily(field: Field) -> DataFrame:
    return _settled(ratios(rollup_with_cumulatives(_shares(field))), _DAILY)


@register(_rolled_sql(_TO_DATE))
def vrr_cumulative(field: Field) -> DataFrame:
    return _settled(ratios(rollup_with_cumulatives(_shares(field))), _TO_DATE)


@register(_view_sql(factor="pair", require_gas=True))
def vrr_view_pair(field: Field) -> DataFrame:
    return _view(field, factor="pair", require_gas=True)


@register(_view_sql(factor="pattern"))
def vrr_view_pattern(field: Field) -> DataFrame:
    return _view(field, factor="pattern")


@register(_view_sql(factor="latest", gas_rule="stored"))
def vrr_view_latest(field: Field) -> DataFrame:
    return _view(field, factor="latest", free_gas="stored")


@register(_view_sql(factor="pair", require_gas=True))
def vrr_view_stored(field: Field) -> DataFrame:
    """The view from a stored rollup: days before July 1996 are rolled up and stored, the later ones then added."""
    spark = field.pvt.sparkSession
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/rollup_{uuid.uuid4().hex}"
    tables = (field.factors, field.pressures, field.pvt)
    options = {"factor": "pair", "require_gas": True}
    later = F.col("PROD_DATE") >= "1996-07-11"
    store_rollup(field.volumes.filter(~later), *tables, path, **options)
    refresh_rollup(field.volumes.filter(later).select("PROD_DATE"), field.volumes, *tables, path, **options)
    return _settled(stored_view(spark, path), VRR_COLUMNS)


@register(_view_sql(factor="pair", require_gas=True))
def vrr_view_bucketed(field: Field) -> DataFrame:
    """The view over daily rows stored in buckets by completion and month, which it does not move."""
    spark = field.pvt.sparkSession
    name = f"volumes_{uuid.uuid4().hex}"
    store_daily_volumes(field.volumes, name, buckets=16)
    rows = vrr_view(
        read_daily_volumes(spark, name), field.factors, field.pressures, field.pvt, factor="pair", require_gas=True
    )
    return _settled(rows, VRR_COLUMNS)


@register(_view_sql(factor="latest", pressure_key="volume", gas_rule="stored"))
def vrr_view_latest_own_pressure(field: Field) -> DataFrame:
    return _view(field, factor="latest", pressure_key="volume", free_gas="stored")


@register(_view_sql(factor="pair", gas_rule="untyped", require_gas=True))
def vrr_view_untyped(field: Field) -> DataFrame:
    return _view(field, factor="pair", free_gas="untyped", require_gas=True)


@register(_view_sql(factor="pair", scope="active"))
def vrr_view_active(field: Field) -> DataFrame:
    return _view(field, factor="pair", scope="active")


@register(_view_sql(factor="pair", policy="low_only"))
def vrr_view_low_only(field: Field) -> DataFrame:
    return _view(field, factor="pair", policy="low_only")


_REPORT = """
    SELECT DISTINCT f.FACTOR_PATTERN || strftime(v.PROD_DATE, '%d-%b-%Y') AS ID_PATTERN,
           v.PROD_DATE AS DATE, p.PRESSURE,
           coalesce(v.CUMULATIVE_INJECTION_VOLUME_RES_BBL
                    / nullif(v.CUMULATIVE_PRODUCTION_VOLUME_RES_BBL, 0), 0) AS VRR_INJECTION_VOLUME_PRODUCTION_VOLUME,
           coalesce(v.THEOR_OIL_VOL_STB, 0) AS THEOR_OIL_VOL_STB,
           coalesce(v.THEOR_WATER_VOL_STB, 0) AS THEOR_WATER_VOL_STB,
           coalesce(v.THEOR_GAS_VOL_KSCF * 1000, 0) AS THEOR_GAS_VOL_KSCF,
           v.CUMULATIVE_PRODUCTION_VOLUME_RES_BBL AS PRODUCTION_VOLUME_RES_BBL,
           s.FACTOR AS FACTORS
    FROM daily_volume v
    JOIN matched f ON f.COMPLETION_ID = v.COMPLETION_ID AND f.PROD_DATE = v.PROD_DATE
                  AND f.AMOUNT_TYPE = v.AMOUNT_TYPE
    JOIN pressure_ended p ON p.ID_PATTERN = f.FACTOR_PATTERN
                         AND v.PROD_DATE >= p.DATE AND v.PROD_DATE < p.END_DATE
    JOIN contribution_factor s ON s.ID_PATTERN = f.FACTOR_PATTERN
    WHERE v.CUMULATIVE_PRODUCTION_VOLUME_RES_BBL > 0
      AND v.PROD_DATE <= (SELECT max(g.EFFECT_DATE) FROM contribution_factor g
                          WHERE g.ID_PATTERN = s.ID_PATTERN AND g.EFFECT_DATE >= v.PROD_DATE)"""


@register(
    with_tables(
        f"""SELECT * REPLACE ({settled('VRR_INJECTION_VOLUME_PRODUCTION_VOLUME', 6)}
                              AS VRR_INJECTION_VOLUME_PRODUCTION_VOLUME) FROM report""",
        "daily_volume",
        "contribution_factor",
        "pressure_ended",
        ctes={"matched": factor_match("completion"), "report": _REPORT},
    )
)
def vrr_report(field: Field) -> DataFrame:
    ratio = "VRR_INJECTION_VOLUME_PRODUCTION_VOLUME"
    rows = report(field.volumes, field.factors, field.pressures)
    return rows.withColumn(ratio, settle(F.col(ratio), 6))


def _children_sql(name: str, rows: str, parent: str) -> str:
    return f"""
        SELECT '{name}' AS RELATIONSHIP, count(*) AS PARENTS, CAST(coalesce(sum(n), 0) AS BIGINT) AS CHILDREN,
               min(n) AS FEWEST, max(n) AS MOST
        FROM (SELECT count(*) AS n FROM {rows} WHERE {parent} IS NOT NULL GROUP BY {parent})"""


_PRODUCED = "(SELECT DISTINCT ID_PATTERN, PROD_DATE FROM daily_volume WHERE AMOUNT_TYPE = 'Production')"
_INJECTED = "(SELECT DISTINCT ID_PATTERN, PROD_DATE FROM daily_volume WHERE AMOUNT_TYPE = 'Injection')"
_MEMBERS = "(SELECT DISTINCT ID_PATTERN, ID_COMPLETION FROM contribution_factor)"


@register(
    with_tables(
        " UNION ALL ".join(
            [
                _children_sql("pattern to production day", _PRODUCED, "ID_PATTERN"),
                _children_sql("pattern to injection day", _INJECTED, "ID_PATTERN"),
                _children_sql("pattern to completion", _MEMBERS, "ID_PATTERN"),
                _children_sql("completion to pattern", _MEMBERS, "ID_COMPLETION"),
                _children_sql("completion to property record", "pvt", "ID_COMPLETION"),
                _children_sql("pattern to pressure record", "pattern_pressure", "ID_PATTERN"),
            ]
        ),
        "daily_volume",
        "contribution_factor",
        "pattern_pressure",
        "pvt",
    )
)
def relationship_counts(field: Field) -> DataFrame:
    return relations.relationship_counts(field.volumes, field.factors, field.pressures, field.pvt)
