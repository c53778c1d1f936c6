"""The rollup of the daily volumes, stored by month and kept up with appended days.

What a view over daily volumes spends its time on is reading, splitting and summing
up the days; what comes after works on one row per pattern, day and pressure.  These
rows are stored here as Parquet files, a folder per month.  Days that are appended
change the sums of their own months only, and running totals are taken when the
view is read, from the totals of months (see ``voidage.operators.running``).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from voidage.plans.vrr import report_rows, rollup_vector, splits, with_cumulatives

STORED = "ID_PATTERN string, DATE date, m array<double>, MONTH string"


def _by_month(volumes, factors, pressures, pvt, **options) -> DataFrame:
    rolled = rollup_vector(splits(volumes, factors, pressures, pvt, **options))
    return rolled.withColumn("MONTH", F.date_format("DATE", "yyyy-MM")).hint("rebalance", F.col("MONTH"))


def store_rollup(
    volumes: DataFrame, factors: DataFrame, pressures: DataFrame, pvt: DataFrame, path: str, **options
) -> None:
    """Roll all volumes up into a new folder; ``options`` are those of ``splits``."""
    _by_month(volumes, factors, pressures, pvt, **options).write.partitionBy("MONTH").parquet(path)


def refresh_rollup(
    appended: DataFrame,
    volumes: DataFrame,
    factors: DataFrame,
    pressures: DataFrame,
    pvt: DataFrame,
    path: str,
    **options,
) -> list[dt.date]:
    """Roll the months of the ``appended`` rows up again; returns the first days of these months.

    ``appended`` needs PROD_DATE only, ``volumes`` are all rows, the appended ones
    among them, of which those months are read.  Each month's folder is replaced as
    a whole, so a refresh that is run again changes nothing, and one that failed is
    run again.  Changed factors, pressures or tests are not followed: they belong
    to all the months that they are in force in, which ``appended`` may name.
    """
    # At most the calendar's months, of days that came in since the last refresh.
    first = F.trunc("PROD_DATE", "month")
    months = sorted(row[0] for row in appended.filter("PROD_DATE IS NOT NULL").select(first).distinct().collect())
    if months:
        inside = reduce(
            lambda a, b: a | b,
            ((F.col("PROD_DATE") >= F.lit(start)) & (F.col("PROD_DATE") < F.lit(end)) for start, end in _runs(months)),
        )
        rolled = _by_month(volumes.filter(inside), factors, pressures, pvt, **options)
        rolled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("MONTH").parquet(path)
    return months


def _next(month: dt.date) -> dt.date:
    return (month + dt.timedelta(days=31)).replace(day=1)


def _runs(months: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Months as ranges of days, those that follow one another as one."""
    runs: list[tuple[dt.date, dt.date]] = []
    for month in months:
        if runs and runs[-1][1] == month:
            runs[-1] = (runs[-1][0], _next(month))
        else:
            runs.append((month, _next(month)))
    return runs


def stored_view(spark: SparkSession, path: str, cumulative_includes_free_gas: bool = False) -> DataFrame:
    """The rows of ``vrr_view`` from a stored rollup."""
    vector = spark.read.schema(STORED).parquet(path).drop("MONTH")
    return report_rows(with_cumulatives(vector, cumulative_includes_free_gas))
