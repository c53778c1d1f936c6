"""The newest test with a point near a pressure, without pairing requests and points.

The points within a tolerance of a request are a stretch of its completion's
points in order of pressure, and what is asked for is the greatest test number in
it.  Pressures are cut into cells a little narrower than the stretch.  Then a
stretch is the end of one cell, the beginning of another and whole cells between
them: the greatest number so far, seen from above and from below, and a maximum
per cell answer it.  Each block of tests (see ``voidage.operators.curves``) makes
one row of a point and two of a request, and one for each whole cell between,
of which there is at most one unless the tolerance is wider than ``RANGE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from voidage.operators.curves import RANGE, blocks_of_prefix, blocks_of_test

_CELL = ("ID_COMPLETION", "__size", "__block", "__cell")


def _lost(a: Column, b: Column, total: Column) -> Column:
    """What ``total``, the rounded sum of two doubles, lacks of their exact sum."""
    second = total - a
    return (a - (total - second)) + (b - second)


def newest_within(known: DataFrame, points: DataFrame, tests: DataFrame, tolerance: float) -> DataFrame:
    """Distinct requests with NEWEST, the number of the newest known test that has a point within the tolerance.

    ``known`` are requests with the TEST_NO that they know last; those without such
    a point are left out.  ``points`` are as ``curves.measured`` gives them and
    ``tests`` have TEST_NO and TESTS.  A point is within the tolerance if its exact
    distance is less; the tolerance has to exceed the rounding of the pressures.
    """
    key = [c for c in known.columns if c not in ("TEST_NO", "TEST_DATE", "END_DATE", "SINCE", "UNTIL")]
    width = F.lit(min(1.9 * tolerance, RANGE))
    cell = lambda x: F.floor(x / width)
    sizes, block = blocks_of_test("all_to_date")
    filed = (
        points.select("ID_COMPLETION", "TEST_DATE", "PRESSURE")
        .join(tests.select("ID_COMPLETION", "TEST_DATE", "TEST_NO", "TESTS"), ["ID_COMPLETION", "TEST_DATE"])
        .withColumn("__size", F.explode(sizes))
        .withColumn("__block", block)
        .withColumn("__cell", cell(F.col("PRESSURE")))
        .groupBy(*_CELL, F.col("PRESSURE").alias("__at"))
        .agg(F.max("TEST_NO").alias("__newest"))
    )
    sizes, block = blocks_of_prefix("all_to_date")
    x, far = F.col("PRESSURE"), F.lit(float(tolerance))
    asked = (
        known.filter(F.col("PRESSURE").isNotNull() & F.col("TEST_NO").isNotNull())
        .withColumn("__size", F.explode(sizes))
        .withColumn("__block", block)
        .select(F.struct(*key).alias("__key"), *_CELL[:3], (x - far).alias("__low"), (x + far).alias("__high"), x.alias("__x"))
    )
    low, high = F.col("__low"), F.col("__high")
    # Where a bound was rounded, a point at it is on the side that the exact bound leaves it on.
    ends = F.array(
        F.struct(
            low.alias("__at"),
            F.when(_lost(F.col("__x"), -far, low) < 0, -1).otherwise(1).alias("__turn"),
            F.lit(True).alias("__up"),
        ),
        F.struct(
            high.alias("__at"),
            F.when(_lost(F.col("__x"), far, high) > 0, 1).otherwise(-1).alias("__turn"),
            F.lit(False).alias("__up"),
        ),
    )
    bounds = asked.select("__key", *_CELL[:3], F.explode(ends).alias("e")).select(
        "__key", *_CELL[:3], cell(F.col("e.__at")).alias("__cell"), "e.*"
    )
    both = filed.withColumn("__turn", F.lit(0)).unionByName(bounds, allowMissingColumns=True)
    in_cell = W.partitionBy(*_CELL)
    so_far = lambda *order: F.max("__newest").over(in_cell.orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    seen = both.select(
        "__key",
        F.when(F.col("__up"), so_far(F.col("__at").desc(), F.col("__turn").desc()))
        .otherwise(so_far(F.col("__at").asc(), F.col("__turn").asc()))
        .alias("__newest"),
    )
    whole = filed.groupBy(*_CELL).agg(F.max("__newest").alias("__newest"))
    first, last = cell(low) + 1, cell(high) - 1
    between = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    across = asked.withColumn("__cell", F.explode(between)).join(whole, list(_CELL)).select("__key", "__newest")
    found = seen.filter(F.col("__key").isNotNull() & F.col("__newest").isNotNull()).unionByName(across)
    return found.groupBy("__key").agg(F.max("__newest").alias("NEWEST")).select("__key.*", "NEWEST")
