"""Bounded numbers of rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key.

    Spark keeps only ``n`` rows per key and task before the shuffle, so a hot
    key reaches its window as a few rows.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def two_extremes(df: DataFrame, key: str, value: str) -> DataFrame:
    """The two lowest and the two highest distinct values per key."""
    values = df.select(key, value).filter(F.col(value).isNotNull()).distinct()

    def ends(order: Column, first: str, second: str, nearest, farthest) -> DataFrame:
        two = first_rows(values, [key], [order], 2)
        both = F.count(F.lit(1)) == 2
        return two.groupBy(key).agg(
            nearest(value).alias(first), F.when(both, farthest(value)).alias(second)
        )

    low = ends(F.col(value).asc(), "LOWEST", "SECOND_LOWEST", F.min, F.max)
    high = ends(F.col(value).desc(), "HIGHEST", "SECOND_HIGHEST", F.max, F.min)
    return low.join(high, key)
