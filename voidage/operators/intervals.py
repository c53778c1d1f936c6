"""Validity intervals and joins against them.

Several tables hold rows that are in force from their own date until the next
date of the same key.  The end is derived once, on the table that carries the
dates, and other tables then meet ``[start, end)`` through an equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from voidage.functions.dates import CYCLE, month_index, month_place, open_end

_MONTH = "__month"


def next_distinct_date(df: DataFrame, keys: Sequence[str], date: str, end: str = "END_DATE") -> DataFrame:
    """Add the next later date of the key; rows that share a date share the end.

    The window sees one row per key and date, so no key is longer than the
    calendar however many rows it has.  Rows come back by an equi-join on
    (key, date), which adaptive execution can split where it is skewed.  There
    can be as many dates as rows, so that they are never sent to every task.
    """
    keys = list(keys)
    dates = df.select(*keys, date).distinct()
    ends = dates.withColumn(
        end, F.coalesce(F.lead(date).over(W.partitionBy(*keys).orderBy(date)), open_end())
    )
    return df.join(ends.hint("merge"), [*keys, date], "left")


def validity_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str = "END_DATE") -> DataFrame:
    """Add the next date of the key, for a table with one row per key and date."""
    follows = F.lead(start).over(W.partitionBy(*keys).orderBy(start))
    return df.withColumn(end, F.coalesce(follows, open_end()))


def fits(df: DataFrame, limit_bytes: int) -> bool:
    """Whether the rows of ``df`` take at most ``limit_bytes``, by one aggregation of their text lengths."""
    widths = F.sum(sum((F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns), F.lit(16)))
    return (df.agg(widths).first()[0] or 0) <= limit_bytes


def filed_by_month(df: DataFrame, start: str, end: str, month: str) -> DataFrame:
    """Each interval once for every place in the cycle of months that it touches; empty ones are left out."""
    first, last = month_index(F.col(start)), month_index(F.date_sub(F.col(end), 1))
    months = F.sequence(first, F.least(last, first + F.lit(CYCLE - 1)))
    places = F.explode(F.transform(months, lambda m: m % CYCLE))
    return df.filter(F.col(start) < F.col(end)).withColumn(month, places)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    at: str,
    start: str,
    end: str,
    how: str = "inner",
    broadcast_bytes: int | None = None,
    place: str | None = None,
) -> DataFrame:
    """Join each left row to the right rows of its key in force at a date.

    A plain join on the key would test every interval of the key and put the
    whole key into one partition.  Here a calendar month joins the key, counted
    round a cycle of ``CYCLE`` months: a right row is repeated for each place in
    the cycle that its months take, at most ``CYCLE`` times however long it is,
    a left row has exactly one place, and the interval bounds stay as the
    residual condition.  A left row is then tested only against intervals that
    touch its month or one whole cycles away from it, and a hot key is spread
    over the cycle.  Nothing of the data has to be known for this, least of all
    where open-ended intervals could stop being repeated.

    ``on`` names columns that both sides have and ``at`` the left date; the
    result keeps one of each key.  ``place`` names a left column that holds the place of
    ``at``; a table stored in buckets by ``on`` and that column is joined where it
    lies, and only the intervals move.  Otherwise both sides are shuffled and merged:
    Spark takes the repeated intervals for as small as the ones they were made from, and
    would send up to ``CYCLE`` times what it expects to every task, by way of the driver.
    They are sent only where ``broadcast_bytes`` asks to measure them now and they are no more.
    """
    by_month = filed_by_month(right, start, end, _MONTH)
    keyed = left.withColumn(_MONTH, month_place(F.col(at)) if place is None else F.col(place))
    condition = (F.col(f"__l.{at}") >= F.col(f"__r.{start}")) & (F.col(f"__l.{at}") < F.col(f"__r.{end}"))
    for name in [*on, _MONTH]:
        condition = condition & (F.col(f"__l.{name}") == F.col(f"__r.{name}"))
    if broadcast_bytes is not None and fits(by_month, broadcast_bytes):
        by_month = F.broadcast(by_month)
    else:
        by_month = by_month.hint("merge")
    joined = keyed.alias("__l").join(by_month.alias("__r"), condition, how)
    return joined.select(
        *(F.col(f"__l.{name}") for name in left.columns),
        *(F.col(f"__r.{name}") for name in right.columns if name not in on),
    )


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[str], start: str, end: str) -> DataFrame:
    """Pair the intervals of two tables that overlap, cut to the common part.

    Two intervals overlap when one starts within the other, so this is two
    interval joins: left starts within right intervals, and right starts within
    left intervals that began earlier.  No other pairs are tried.

    Both sides carry ``start`` and ``end``; the result has one of each.
    """
    names = {start: "__start", end: "__end"}

    def starts_within(inner: DataFrame, outer: DataFrame) -> DataFrame:
        outer = outer.withColumnsRenamed(names)
        return interval_join(inner, outer, on, start, "__start", "__end")

    first = starts_within(left, right)
    second = starts_within(right, left).filter(F.col(start) > F.col("__start"))
    return (
        first.unionByName(second).withColumn(end, F.least(end, "__end")).drop("__start", "__end")
    )
