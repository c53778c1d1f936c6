"""Contribution factors in force: four rules for what ends a factor.

Each rule returns the factor rows with a ``[EFFECT_DATE, END_DATE)`` interval,
so that all four meet the daily volumes through the same interval join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voidage.functions.dates import open_end
from voidage.operators.intervals import next_distinct_date


def by_pair(factors: DataFrame) -> DataFrame:
    """Until the next effect date of the same pattern and completion."""
    return next_distinct_date(factors, ["ID_PATTERN", "ID_COMPLETION"], "EFFECT_DATE")


def by_pattern(factors: DataFrame) -> DataFrame:
    """Until the next effect date of the pattern, whichever completion has it."""
    return next_distinct_date(factors, ["ID_PATTERN"], "EFFECT_DATE")


def by_completion(factors: DataFrame) -> DataFrame:
    """Until the next effect date of the completion, whichever pattern has it."""
    return next_distinct_date(factors, ["ID_COMPLETION"], "EFFECT_DATE")


def latest(factors: DataFrame) -> DataFrame:
    """Only the last factor of each pattern and completion, from its date on."""
    return (
        factors.groupBy("ID_PATTERN", "ID_COMPLETION")
        .agg(
            F.max("EFFECT_DATE").alias("EFFECT_DATE"),
            F.max_by("FACTOR", "EFFECT_DATE").alias("FACTOR"),
        )
        .withColumn("END_DATE", open_end())
    )


RULES = {"pair": by_pair, "pattern": by_pattern, "completion": by_completion, "latest": latest}
