"""Volume expressions: allocation to a pattern, unit conversion, free gas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: standard cubic feet in a thousand.
SCF_PER_KSCF = 1000

# Allocated volume <- stored volume, and whether it is in KSCF.
ALLOCATED = {
    "OIL_VOLUME": ("THEOR_OIL_VOL_STB", False),
    "WATER_VOLUME": ("THEOR_WATER_VOL_STB", False),
    "GAS_VOLUME": ("THEOR_GAS_VOL_KSCF", True),
    "WATER_INJ_VOLUME": ("THEOR_WATER_INJ_VOL_STB", False),
    "GAS_WELL_GAS_VOLUME": ("ALLOC_GAS_VOL_KSCF", True),
    "GAS_INJ_VOLUME": ("THEOR_GAS_INJ_VOL_KSCF", True),
}

#: Columns of the volume table each free-gas rule reads besides the allocated ones.
FREE_GAS_INPUTS = {
    "gor": ("AMOUNT_TYPE",),
    "stored": ("AMOUNT_TYPE", "FREE_GAS"),
    "untyped": (),
}


def scf(kscf: Column) -> Column:
    return kscf * SCF_PER_KSCF


def allocate(volume: Column, factor: Column) -> Column:
    """Share of a volume: unsplit without a factor, 0 without a volume."""
    return F.coalesce(volume * factor, volume, F.lit(0.0))


def allocated_volumes(factor: Column) -> list[Column]:
    """The six allocated volumes, gas in SCF."""
    return [
        allocate(scf(F.col(stored)) if kscf else F.col(stored), factor).alias(name)
        for name, (stored, kscf) in ALLOCATED.items()
    ]


def _gas_above_solution(factor: Column, gas_factor: str) -> Column:
    oil = F.col("THEOR_OIL_VOL_STB")
    gas_oil_ratio = scf(F.col("THEOR_GAS_VOL_KSCF")) / F.nullif(oil, F.lit(0.0))
    return F.coalesce(
        (gas_oil_ratio - F.col("SOLUTION_GAS_OIL_RATIO")) * oil * factor * F.col(gas_factor),
        F.lit(0.0),
    )


def _if_production(value: Column) -> Column:
    return F.when(F.col("AMOUNT_TYPE") == "Production", value).otherwise(0.0)


def free_gas(rule: str, factor: Column) -> Column:
    """Free gas in reservoir barrels.

    ``gor``      produced gas beyond the solution ratio, production rows only
    ``stored``   the stored free gas, split and converted, production rows only
    ``untyped``  as ``gor`` for every row, with the injected-gas volume factor
    """
    if rule == "gor":
        return _if_production(_gas_above_solution(factor, "GAS_FORMATION_VOLUME_FACTOR"))
    if rule == "stored":
        stored = F.col("FREE_GAS")
        return _if_production(
            F.coalesce(stored * factor * F.col("GAS_FORMATION_VOLUME_FACTOR"), stored, F.lit(0.0))
        )
    if rule == "untyped":
        return _gas_above_solution(factor, "INJECTED_GAS_FORMATION_VOLUME_FACTOR")
    raise ValueError(f"unknown free-gas rule: {rule}")
