"""Running totals that do not put a whole key into one task."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def running_totals(
    df: DataFrame, keys: Sequence[str], date: str, totals: Mapping[str, Column], shared: bool = False
) -> DataFrame:
    """Add running sums per key by date; rows of one date share the total.

    The default window frame includes every row of the current date, so the
    running sum depends only on the total of each date.  Rows are first summed
    to one per key and date.  Those are summed up within each month, the totals of
    the months before are added, and the result joins back on (key, date).  So a
    window orders the days of one month or the months of one key, however long a
    key's history and however many its rows are.

    They join as one struct, which equals itself whether or not its fields
    are NULL: a row without a key or date keeps its totals.

    ``df`` is read twice.  With ``shared`` it is shuffled on (key, date) first,
    and as long as both readers need the same columns the second one reuses
    that shuffle.
    """
    rest = [c for c in df.columns if c not in (*keys, date)]
    keyed = df.select(F.struct(*keys, date).alias("__key"), *rest)
    if shared:
        keyed = keyed.repartition("__key")
    daily = keyed.groupBy("__key").agg(*(F.sum(value).alias(name) for name, value in totals.items()))
    running = summed_up(daily.select("__key.*", *totals), keys, date, totals)
    joinable = running.select(F.struct(*keys, date).alias("__key"), *totals)
    return keyed.join(joinable, "__key").select("__key.*", *rest, *totals)


def summed_up(daily: DataFrame, keys: Sequence[str], date: str, names: Iterable[str]) -> DataFrame:
    """Daily totals, one row per key and date, replaced by running ones: sums within months, and of months before."""
    names, of_key = list(names), ", ".join(f"__month.{k}" for k in keys)
    month = daily.withColumn("__month", F.struct(*keys, F.trunc(date, "month").alias("__first")))
    so_far = (f"sum({n}) OVER (PARTITION BY __month ORDER BY {date}) AS {n}" for n in names)
    days = month.selectExpr("__month", date, *so_far, *(f"{n} AS __{n}" for n in names))
    # The days lie by month already, so that their sums need no shuffle.
    months = days.groupBy("__month").agg(*(F.sum(f"__{n}").alias(f"__{n}") for n in names))
    before = f"PARTITION BY {of_key} ORDER BY __month.__first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    carried = months.selectExpr("__month", *(f"sum(__{n}) OVER ({before}) AS __before_{n}" for n in names))
    total = (f"coalesce(__before_{n} + {n}, __before_{n}, {n}) AS {n}" for n in names)
    return days.join(carried, "__month").selectExpr(*(f"__month.{k} AS {k}" for k in keys), date, *total)
