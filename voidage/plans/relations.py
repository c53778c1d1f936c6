"""Row counts along the relationships of the data model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _children(name: str, df: DataFrame, parent: str) -> DataFrame:
    per_parent = df.filter(F.col(parent).isNotNull()).groupBy(parent).agg(F.count(F.lit(1)).alias("n"))
    return per_parent.agg(
        F.count(F.lit(1)).alias("PARENTS"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("CHILDREN"),
        F.min("n").alias("FEWEST"),
        F.max("n").alias("MOST"),
    ).select(F.lit(name).alias("RELATIONSHIP"), "PARENTS", "CHILDREN", "FEWEST", "MOST")


def relationship_counts(
    volumes: DataFrame, factors: DataFrame, pressures: DataFrame, pvt: DataFrame
) -> DataFrame:
    """For each relationship: parents, children, and fewest and most children of one parent."""
    members = factors.select("ID_PATTERN", "ID_COMPLETION").distinct()
    days = volumes.groupBy("ID_PATTERN", "PROD_DATE", "AMOUNT_TYPE").agg(F.count(F.lit(1)).alias("rows"))
    counted = [
        _children("pattern to production day", days.filter("AMOUNT_TYPE = 'Production'"), "ID_PATTERN"),
        _children("pattern to injection day", days.filter("AMOUNT_TYPE <> 'Production'"), "ID_PATTERN"),
        _children("pattern to completion", members, "ID_PATTERN"),
        _children("completion to pattern", members, "ID_COMPLETION"),
        _children("completion to property record", pvt, "ID_COMPLETION"),
        _children("pattern to pressure record", pressures, "ID_PATTERN"),
    ]
    return reduce(DataFrame.unionByName, counted)
