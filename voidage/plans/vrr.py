"""Daily volumes split over patterns, converted to reservoir barrels, rolled up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voidage.functions.dates import pattern_key
from voidage.functions.numeric import ratio_or_zero
from voidage.functions.volumes import FREE_GAS_INPUTS, allocated_volumes, free_gas, scf
from voidage.operators import factors as factor_rules
from voidage.operators.intervals import interval_join, overlap_join, validity_intervals
from voidage.operators.running import running_totals
from voidage.plans.pvt import pvt_lookup
from voidage.sources.schemas import MONTH_PLACE, PROPERTIES, REQUEST_KEY, VOLUME_COLUMNS

# The columns of the ratio report, in order.
VRR_COLUMNS = (
    "ID_PATTERN_VRR",
    "ID_PATTERN",
    "DATE",
    "PRESSURE",
    "VRR",
    "CUMULATIVE_VRR",
    "OIL_VOLUME_STB",
    "OIL_VOLUME_RES_BBL",
    "GAS_VOLUME_SCF",
    "FREE_GAS",
    "WATER_VOLUME_STB",
    "WATER_VOLUME_RES_BBL",
    "PRODUCTION_VOLUME_RES_BBL",
    "CUMULATIVE_PRODUCTION_VOLUME_RES_BBL",
    "GAS_INJ_VOLUME_SCF",
    "WATER_INJ_VOLUME_STB",
    "INJECTION_VOLUME_RES_BBL",
    "CUMULATIVE_INJECTION_VOLUME_RES_BBL",
    "WATER_INJ_VOLUME_RES_BBL",
    "GAS_INJ_VOLUME_RES_BBL",
    "CUMULATIVE_OIL_PRODUCTION_VOLUME_RES_BBL",
    "CUMULATIVE_WATER_PRODUCTION_VOLUME_RES_BBL",
    "CUMULATIVE_WATER_INJECTION_VOLUME_RES_BBL",
    "CUMULATIVE_GAS_INJECTION_VOLUME_RES_BBL",
)

PRESSURE_KEYS = ("factor", "volume")


def pressure_intervals(pressures: DataFrame) -> DataFrame:
    """Pattern pressures with the date each one ends."""
    return validity_intervals(pressures, ["ID_PATTERN"], "DATE")


def pressure_in_force(volumes: DataFrame, pressures: DataFrame) -> DataFrame:
    """Daily rows with the pressure of their own pattern in force that day."""
    intervals = pressure_intervals(pressures).withColumnRenamed("DATE", "PRESSURE_DATE")
    return interval_join(
        volumes,
        intervals,
        on=["ID_PATTERN"],
        at="PROD_DATE",
        start="PRESSURE_DATE",
        end="END_DATE",
    ).drop("END_DATE")


def with_factor(volumes: DataFrame, factors: DataFrame, rule: str = "pair", how: str = "left") -> DataFrame:
    """Daily rows with the factors in force, one row per factor.

    Adds FACTOR_PATTERN, EFFECT_DATE and FACTOR.  The ``latest`` rule also
    matches on the row's own pattern; the others give a row for every pattern
    of the completion.
    """
    return _join_factors(
        volumes.withColumn("ID_COMPLETION", F.col("COMPLETION_ID")), factors, rule, how
    ).drop("ID_COMPLETION")


def _join_factors(daily: DataFrame, factors: DataFrame, rule: str, how: str) -> DataFrame:
    return interval_join(
        daily,
        _factor_intervals(factors, rule),
        on=_factor_keys(rule),
        at="PROD_DATE",
        start="EFFECT_DATE",
        end="END_DATE",
        how=how,
    ).drop("END_DATE")


def _factor_intervals(factors: DataFrame, rule: str) -> DataFrame:
    intervals = factor_rules.RULES[rule](factors)
    if rule == "latest":
        return intervals.withColumn("FACTOR_PATTERN", F.col("ID_PATTERN"))
    return intervals.withColumnRenamed("ID_PATTERN", "FACTOR_PATTERN")


def _factor_keys(rule: str) -> list[str]:
    return ["ID_PATTERN", "ID_COMPLETION"] if rule == "latest" else ["ID_COMPLETION"]


def schedule(factors: DataFrame, pressures: DataFrame, rule: str = "pair") -> DataFrame:
    """Factor and pressure in force per completion, pattern and period.

    This is where the small tables meet: factor periods and pressure periods of
    a pattern are cut to their common part, so that a daily row later finds
    factor, pressure and fluid properties by one join.
    """
    return _with_pressure(factor_rules.RULES[rule](factors), pressures)


def _pressure_periods(pressures: DataFrame) -> DataFrame:
    return pressure_intervals(pressures).select(
        "ID_PATTERN",
        "PRESSURE",
        F.col("DATE").alias("VRR_DATE"),
        F.col("DATE").alias("START_DATE"),
        "END_DATE",
    )


def _with_pressure(intervals: DataFrame, pressures: DataFrame) -> DataFrame:
    periods = intervals.withColumnRenamed("EFFECT_DATE", "START_DATE")
    return overlap_join(periods, _pressure_periods(pressures), ["ID_PATTERN"], "START_DATE", "END_DATE")


def splits(
    volumes: DataFrame,
    factors: DataFrame,
    pressures: DataFrame,
    pvt: DataFrame,
    factor: str = "pair",
    pressure_key: str = "factor",
    gas_rule: str = "gor",
    require_gas: bool = False,
    scope: str = "all_to_date",
    policy: str = "full",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Daily rows per pattern share: allocated volumes, free gas, pressure, properties."""
    if pressure_key not in PRESSURE_KEYS:
        raise ValueError(f"unknown pressure key: {pressure_key}")
    if require_gas:
        volumes = volumes.filter(F.col("THEOR_GAS_VOL_KSCF").isNotNull())
    daily = volumes.select(
        "ID_PATTERN",
        F.col("COMPLETION_ID").alias("ID_COMPLETION"),
        F.col("PROD_DATE").alias("PROD_DATE"),
        *VOLUME_COLUMNS,
        *FREE_GAS_INPUTS[gas_rule],
        *(c for c in (MONTH_PLACE,) if c in volumes.columns),
    )
    if pressure_key == "factor":
        placed = _by_schedule(daily, factors, pressures, pvt, factor, scope, policy, broadcast_bytes)
    else:
        placed = _by_own_pattern(daily, volumes, factors, pressures, pvt, factor, scope, policy)
    return placed.select(
        "ID_PATTERN",
        "ID_COMPLETION",
        F.col("PROD_DATE").alias("DATE"),
        *allocated_volumes(F.col("FACTOR")),
        free_gas(gas_rule, F.col("FACTOR")).alias("FREE_GAS"),
        "FACTOR",
        "PRESSURE",
        *PROPERTIES,
    )


def _properties(planned: DataFrame, pvt: DataFrame, scope: str, policy: str) -> DataFrame:
    """Planned periods with their fluid properties, NULL where the policy gives no row.

    A pressure that several periods or patterns ask for is looked up once.
    """
    key = list(REQUEST_KEY)
    answers = pvt_lookup(planned.select(*key).distinct(), pvt, scope, policy)
    same = [F.col(f"__q.{name}").eqNullSafe(F.col(f"__a.{name}")) for name in key]
    found = planned.alias("__q").join(answers.select(*key, *PROPERTIES).alias("__a"), same, "left")
    return found.select(*(F.col(f"__q.{c}") for c in planned.columns if c != "VRR_DATE"), *PROPERTIES)


def _by_schedule(daily, factors, pressures, pvt, factor, scope, policy, broadcast_bytes) -> DataFrame:
    looked_up = _properties(schedule(factors, pressures, factor), pvt, scope, policy)
    if factor != "latest":
        looked_up = looked_up.drop("ID_PATTERN")
    return interval_join(
        daily,
        looked_up,
        on=_factor_keys(factor),
        at="PROD_DATE",
        start="START_DATE",
        end="END_DATE",
        broadcast_bytes=broadcast_bytes,
        place=MONTH_PLACE if MONTH_PLACE in daily.columns else None,
    )


def _by_own_pattern(daily, volumes, factors, pressures, pvt, factor, scope, policy) -> DataFrame:
    # The pressure follows the volume's own pattern, so a row without a factor
    # stays: volumes meet pressures and properties first, factors last.
    # The filter says what every reader of the members drops, so that they share one reading.
    members = (
        volumes.filter(F.col("ID_PATTERN").isNotNull() & F.col("COMPLETION_ID").isNotNull())
        .select("ID_PATTERN", F.col("COMPLETION_ID").alias("ID_COMPLETION"))
        .distinct()
    )
    planned = members.join(_pressure_periods(pressures), "ID_PATTERN")
    placed = interval_join(
        daily,
        _properties(planned, pvt, scope, policy),
        on=["ID_PATTERN", "ID_COMPLETION"],
        at="PROD_DATE",
        start="START_DATE",
        end="END_DATE",
    )
    return _join_factors(placed.drop("START_DATE", "END_DATE"), factors, factor, "left")


# Sums per pattern, day and pressure: name -> aggregate, as SQL text.
_ROLLUP = {
    "OIL_VOLUME_STB": "sum(OIL_VOLUME)",
    "WATER_VOLUME_STB": "sum(WATER_VOLUME)",
    "OIL_VOLUME_RES_BBL": "sum(OIL_VOLUME * OIL_FORMATION_VOLUME_FACTOR)",
    "WATER_VOLUME_RES_BBL": "sum(WATER_VOLUME * WATER_FORMATION_VOLUME_FACTOR)",
    "WATER_INJ_VOLUME_STB": "sum(WATER_INJ_VOLUME)",
    "WATER_INJ_VOLUME_RES_BBL": "sum(WATER_INJ_VOLUME * INJECTED_WATER_FORMATION_VOLUME_FACTOR)",
    "GAS_WELL_GAS_VOLUME_SCF": "sum(GAS_WELL_GAS_VOLUME)",
    "GAS_INJ_VOLUME_SCF": "sum(GAS_INJ_VOLUME)",
    "GAS_VOLUME_SCF": "sum(GAS_VOLUME)",
    "FREE_GAS": "sum(FREE_GAS)",
    "GAS_INJ_VOLUME_RES_BBL": "sum(GAS_INJ_VOLUME * INJECTED_GAS_FORMATION_VOLUME_FACTOR)",
    "SOLUTION_GAS_OIL_RATIO": "sum(SOLUTION_GAS_OIL_RATIO)",
    "PRESSURE": "avg(PRESSURE)",
}

_GROUP = ("ID_PATTERN", "DATE")


def rollup_vector(shares: DataFrame) -> DataFrame:
    """The sums as one array column ``m``, in the order of ``_ROLLUP``.

    The running totals read the grouped rows a second time.  As separate
    columns, column pruning would trim the two readers differently and Spark
    would group twice; as one array both need the same column and the second
    reader reuses the shuffle of the first.
    """
    return (
        shares.withColumn("__pressure", F.col("PRESSURE"))
        .groupBy(*_GROUP, "__pressure")
        .agg(F.expr(f"array({', '.join(_ROLLUP.values())}) AS m"))
        .select(*_GROUP, "m")
    )


def _m(name: str) -> str:
    return f"m[{list(_ROLLUP).index(name)}]"


def _unpacked(names: Sequence[str] = tuple(_ROLLUP)) -> list[Column]:
    return [F.expr(f"{_m(name)} AS {name}") for name in names]


def rollup(shares: DataFrame) -> DataFrame:
    """Surface and reservoir volumes per pattern, day and pressure, with totals."""
    return _with_totals(rollup_vector(shares).select(*_GROUP, *_unpacked()))


def _with_totals(rolled: DataFrame) -> DataFrame:
    # A total is NULL where one of its parts is: properties are then unknown.
    return rolled.withColumn(
        "PRODUCTION_VOLUME_RES_BBL",
        F.col("OIL_VOLUME_RES_BBL") + F.col("WATER_VOLUME_RES_BBL") + F.col("FREE_GAS"),
    ).withColumn(
        "INJECTION_VOLUME_RES_BBL",
        F.col("WATER_INJ_VOLUME_RES_BBL") + F.col("GAS_INJ_VOLUME_RES_BBL"),
    )


def rollup_with_cumulatives(shares: DataFrame, cumulative_includes_free_gas: bool = False) -> DataFrame:
    """``rollup`` plus the six running totals per pattern."""
    return with_cumulatives(rollup_vector(shares), cumulative_includes_free_gas)


def with_cumulatives(vector: DataFrame, cumulative_includes_free_gas: bool = False) -> DataFrame:
    """The same from sums that ``rollup_vector`` made."""
    oil, water, water_in, gas_in = (
        _m(f"{name}_RES_BBL") for name in ("OIL_VOLUME", "WATER_VOLUME", "WATER_INJ_VOLUME", "GAS_INJ_VOLUME")
    )
    produced = f"{oil} + {water}" + (f" + {_m('FREE_GAS')}" if cumulative_includes_free_gas else "")
    totals = {
        "CUMULATIVE_OIL_PRODUCTION_VOLUME_RES_BBL": oil,
        "CUMULATIVE_WATER_PRODUCTION_VOLUME_RES_BBL": water,
        "CUMULATIVE_WATER_INJECTION_VOLUME_RES_BBL": water_in,
        "CUMULATIVE_GAS_INJECTION_VOLUME_RES_BBL": gas_in,
        "CUMULATIVE_PRODUCTION_VOLUME_RES_BBL": produced,
        "CUMULATIVE_INJECTION_VOLUME_RES_BBL": f"{water_in} + {gas_in}",
    }
    totals = {name: F.expr(value) for name, value in totals.items()}
    running = running_totals(vector, ["ID_PATTERN"], "DATE", totals, shared=True)
    return _with_totals(running.select(*_GROUP, *_unpacked(), *totals))


def ratios(rolled: DataFrame) -> DataFrame:
    """Add the daily and cumulative voidage replacement ratio and the report key."""
    return (
        rolled.withColumn(
            "VRR", ratio_or_zero(F.col("INJECTION_VOLUME_RES_BBL"), F.col("PRODUCTION_VOLUME_RES_BBL"))
        )
        .withColumn(
            "CUMULATIVE_VRR",
            ratio_or_zero(
                F.col("CUMULATIVE_INJECTION_VOLUME_RES_BBL"), F.col("CUMULATIVE_PRODUCTION_VOLUME_RES_BBL")
            ),
        )
        .withColumn("ID_PATTERN_VRR", pattern_key(F.col("ID_PATTERN"), F.col("DATE")))
    )


def vrr_view(
    volumes: DataFrame,
    factors: DataFrame,
    pressures: DataFrame,
    pvt: DataFrame,
    factor: str = "pair",
    pressure_key: str = "factor",
    free_gas: str = "gor",
    require_gas: bool = False,
    scope: str = "all_to_date",
    policy: str = "full",
    cumulative_includes_free_gas: bool = False,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Voidage replacement ratio per pattern, day and pressure.

    ``factor``        which factor is in force: pair, pattern, completion, latest
    ``pressure_key``  whose pattern gives the pressure: the factor's or the volume's
    ``free_gas``      gor, stored or untyped
    ``require_gas``   leave out daily rows without a gas volume
    ``broadcast_bytes`` measure the schedule now and send it to the daily rows if it is no larger

    The output pattern is the volume's own, so one pattern and day can have
    several pressures.  Days before the first production are left out.
    """
    shares = splits(
        volumes, factors, pressures, pvt, factor, pressure_key, free_gas, require_gas, scope, policy, broadcast_bytes
    )
    return report_rows(rollup_with_cumulatives(shares, cumulative_includes_free_gas))


def report_rows(rolled: DataFrame) -> DataFrame:
    """The columns of the report, without the days before a pattern's first production."""
    return ratios(rolled).filter(F.col("CUMULATIVE_PRODUCTION_VOLUME_RES_BBL") != 0).select(*VRR_COLUMNS)


def _until_last_effect(intervals: DataFrame, factors: DataFrame) -> DataFrame:
    """Cut factor intervals after the last effect date of their pattern.

    A day has a factor of its pattern effective then or later exactly when it
    is not after that date, so the cut stands in for the match.
    """
    last = factors.groupBy("ID_PATTERN").agg(F.max("EFFECT_DATE").alias("LAST_EFFECT_DATE"))
    cut = F.least("END_DATE", F.date_add("LAST_EFFECT_DATE", 1))
    return intervals.join(last, "ID_PATTERN").withColumn("END_DATE", cut)


def forward_matched(volumes: DataFrame, factors: DataFrame) -> DataFrame:
    """Daily rows under their completion's factors whose pattern has a factor
    effective on that day or later."""
    intervals = _until_last_effect(factor_rules.by_completion(factors), factors)
    return interval_join(
        volumes.withColumn("ID_COMPLETION", F.col("COMPLETION_ID")),
        intervals.withColumnRenamed("ID_PATTERN", "FACTOR_PATTERN"),
        on=["ID_COMPLETION"],
        at="PROD_DATE",
        start="EFFECT_DATE",
        end="END_DATE",
    ).drop("ID_COMPLETION", "END_DATE")


def vrr_report(volumes: DataFrame, factors: DataFrame, pressures: DataFrame) -> DataFrame:
    """The report over stored cumulative volumes, one row per distinct factor of the pattern."""
    intervals = _until_last_effect(factor_rules.by_completion(factors), factors)
    planned = _with_pressure(intervals, pressures).drop("FACTOR", "LAST_EFFECT_DATE")
    daily = volumes.filter(F.col("CUMULATIVE_PRODUCTION_VOLUME_RES_BBL") > 0).select(
        F.col("COMPLETION_ID").alias("ID_COMPLETION"),
        "PROD_DATE",
        *VOLUME_COLUMNS[:3],
        "CUMULATIVE_INJECTION_VOLUME_RES_BBL",
        "CUMULATIVE_PRODUCTION_VOLUME_RES_BBL",
    )
    matched = interval_join(daily, planned, ["ID_COMPLETION"], "PROD_DATE", "START_DATE", "END_DATE")
    rows = matched.select(
        "ID_PATTERN",
        F.col("PROD_DATE").alias("DATE"),
        "PRESSURE",
        ratio_or_zero(
            F.col("CUMULATIVE_INJECTION_VOLUME_RES_BBL"), F.col("CUMULATIVE_PRODUCTION_VOLUME_RES_BBL")
        ).alias("VRR_INJECTION_VOLUME_PRODUCTION_VOLUME"),
        F.coalesce("THEOR_OIL_VOL_STB", F.lit(0.0)).alias("THEOR_OIL_VOL_STB"),
        F.coalesce("THEOR_WATER_VOL_STB", F.lit(0.0)).alias("THEOR_WATER_VOL_STB"),
        F.coalesce(scf(F.col("THEOR_GAS_VOL_KSCF")), F.lit(0.0)).alias("THEOR_GAS_VOL_KSCF"),
        F.col("CUMULATIVE_PRODUCTION_VOLUME_RES_BBL").alias("PRODUCTION_VOLUME_RES_BBL"),
    )
    # Both sides are distinct before they meet, so their pairs are as well. The join has
    # exchanges of its own: where Spark measures that a pattern's days are too many for
    # one task, it splits them and copies that pattern's factors alone.
    pattern_factors = factors.select("ID_PATTERN", F.col("FACTOR").alias("FACTORS")).distinct()
    report = rows.distinct().join(pattern_factors, "ID_PATTERN")
    return report.withColumn("ID_PATTERN", pattern_key(F.col("ID_PATTERN"), F.col("DATE"), "dd-MMM-yyyy"))
