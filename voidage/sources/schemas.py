"""Schemas of the four base tables and of the lookup request."""

from __future__ import annotations

from pyspark.sql import types as T

# The fluid properties, in output order.
PROPERTIES = (
    "OIL_FORMATION_VOLUME_FACTOR",
    "GAS_FORMATION_VOLUME_FACTOR",
    "WATER_FORMATION_VOLUME_FACTOR",
    "SOLUTION_GAS_OIL_RATIO",
    "VOLATIZED_OIL_GAS_RATIO",
    "VISCOSITY_OIL",
    "VISCOSITY_WATER",
    "VISCOSITY_GAS",
    "INJECTED_GAS_FORMATION_VOLUME_FACTOR",
    "INJECTED_WATER_FORMATION_VOLUME_FACTOR",
)

# Fixed value: end date of an interval that is still in force.
OPEN_END = "9999-12-31"

# Column of stored daily volumes: the place of the day's month in the cycle of months.
MONTH_PLACE = "MONTH_PLACE"

REQUEST_KEY = ("ID_COMPLETION", "VRR_DATE", "PRESSURE")


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


PVT = _schema(
    ("ID_COMPLETION", T.StringType()),
    ("TEST_DATE", T.DateType()),
    ("PRESSURE", T.DoubleType()),
    *((name, T.DoubleType()) for name in PROPERTIES),
)

PATTERN_PRESSURE = _schema(
    ("ID_PATTERN", T.StringType()),
    ("DATE", T.DateType()),
    ("PRESSURE", T.DoubleType()),
)

CONTRIBUTION_FACTOR = _schema(
    ("ID_PATTERN", T.StringType()),
    ("ID_COMPLETION", T.StringType()),
    ("EFFECT_DATE", T.DateType()),
    ("FACTOR", T.DoubleType()),
)

VOLUME_COLUMNS = (
    "THEOR_OIL_VOL_STB",
    "THEOR_WATER_VOL_STB",
    "THEOR_GAS_VOL_KSCF",
    "THEOR_WATER_INJ_VOL_STB",
    "ALLOC_GAS_VOL_KSCF",
    "THEOR_GAS_INJ_VOL_KSCF",
)

DAILY_VOLUME = _schema(
    ("ID_PATTERN", T.StringType()),
    ("COMPLETION_ID", T.StringType()),
    ("PROD_DATE", T.DateType()),
    ("AMOUNT_TYPE", T.StringType()),
    *((name, T.DoubleType()) for name in VOLUME_COLUMNS),
    ("FREE_GAS", T.DoubleType()),
    ("CUMULATIVE_INJECTION_VOLUME_RES_BBL", T.DoubleType()),
    ("CUMULATIVE_PRODUCTION_VOLUME_RES_BBL", T.DoubleType()),
)

REQUEST = _schema(
    ("ID_COMPLETION", T.StringType()),
    ("VRR_DATE", T.DateType()),
    ("PRESSURE", T.DoubleType()),
)

TABLES = {
    "completion_pvt_characteristics": PVT,
    "pattern_pressure": PATTERN_PRESSURE,
    "pattern_contribution_factor": CONTRIBUTION_FACTOR,
    "production_volumes_daily_oilfield": DAILY_VOLUME,
}
