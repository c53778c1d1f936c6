"""Curves prepared once, for lookups that come later.

``bracket`` works the blocks of tests out each time it runs.  An index keeps them:
for every block (see ``voidage.operators.curves``) and every two neighbouring
pressures in it one row, which has the points around that stretch.  A request
needs one row of each block of its prefix, and finds it by an equi-join.

* Stretches are filed under cells of pressure, counted round a cycle, as dates
  are under months in an interval join: a row is repeated for the cells that it
  touches, a request has one cell.  Cells are halved and the cycle is doubled
  with each doubling of the block, so that neither the repetition nor the rows
  that a request is tested against grow with the number of tests.  They grow with
  the number of points within ``CELL_WIDTH`` of a single test.
* Blocks of earlier tests never change when later tests arrive, as they are
  consecutive tests and only full blocks are used.  A refresh adds the blocks that
  have become full.  Only where a test comes late, between others or to one that
  is there already, all blocks of its completion are written anew.  Each refresh
  is a generation; a completion's tests say which of them are its own.

Stored, an index is two tables: ``<name>_tests``, and ``<name>_points`` in buckets
by completion, block and cell, so that a lookup moves its requests alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from voidage.functions.dates import month_end
from voidage.operators.curves import (
    FOUND,
    RANGE,
    SCOPES,
    answered,
    blocks_of_prefix,
    blocks_of_test,
    gathered,
    levels,
    measured,
    neighbours,
    numbered_tests,
)
from voidage.operators.intervals import interval_join

#: Width of a cell and number of cells in a cycle for the block of a single test.
CELL_WIDTH, CELLS = 500.0, 4
#: Doublings after which cells get no narrower.
MOST_DOUBLINGS = 12

BUCKETED_BY = ("ID_COMPLETION", "SIZE", "BLOCK", "CELL")
_POINTS = ("POINT", "DOWN", "DOWN2", "UP", "UP2", "HERE", "PASSED", "TOTAL")

_TIMES = f"shiftleft(1, least(SIZE, {MOST_DOUBLINGS}))"


def cell_of(pressure: str) -> str:
    """The cell of a pressure in the blocks of SIZE, as SQL text."""
    return f"CAST(pmod({_place(pressure)}, {CELLS} * {_TIMES}) AS INT)"


def _place(pressure: str) -> str:
    return f"floor({pressure} * {_TIMES} / {CELL_WIDTH}D)"


def _cells() -> Column:
    """Cells that the stretch from FROM_PRESSURE to TO_PRESSURE touches; one without an end touches all."""
    cycle, first = f"{CELLS} * {_TIMES}", _place("FROM_PRESSURE")
    last = f"least({_place('TO_PRESSURE')}, {first} + {cycle} - 1)"
    ends = "FROM_PRESSURE = double('-Infinity') OR TO_PRESSURE = double('Infinity')"
    return F.expr(
        f"""CASE WHEN {ends} THEN sequence(0, {cycle} - 1)
            ELSE transform(sequence({first}, {last}), c -> CAST(pmod(c, {cycle}) AS INT)) END"""
    )


def _stretches(points: DataFrame) -> DataFrame:
    """One row per stretch of a block and cell, from ``levels``; the stretch below the lowest point has no POINT."""
    near = neighbours(points)
    none, nothing = F.lit(None).cast(near.schema["POINT"].dataType), F.lit(0).cast("bigint")
    own = F.struct(*_POINTS)
    below = F.struct(
        *(none.alias(c) for c in ("POINT", "DOWN", "DOWN2")),
        F.col("POINT").alias("UP"),
        F.col("UP").alias("UP2"),
        nothing.alias("HERE"),
        nothing.alias("PASSED"),
        F.col("TOTAL").alias("TOTAL"),
    )
    rows = F.when(F.col("DOWN").isNull(), F.array(below, own)).otherwise(F.array(own))
    ends = {
        "FROM_PRESSURE": F.coalesce(F.col("r.POINT.PRESSURE"), F.lit(float("-inf"))),
        "TO_PRESSURE": F.coalesce(F.col("r.UP.PRESSURE"), F.lit(float("inf"))),
    }
    return (
        near.select("ID_COMPLETION", F.col("__size").alias("SIZE"), F.col("__block").alias("BLOCK"), F.explode(rows).alias("r"))
        .withColumns(ends)
        .withColumn("CELL", F.explode(_cells()))
        .select(*BUCKETED_BY, *ends, "r.*")
    )


@dataclass(frozen=True)
class CurveIndex:
    """``tests``: TEST_NO of each completion's test dates, and the generations SINCE and UNTIL its blocks count.

    ``points``: stretches of blocks with the points around them and their GENERATION.
    """

    tests: DataFrame
    points: DataFrame

    @classmethod
    def of(cls, pvt: DataFrame) -> CurveIndex:
        """An index as a plan, worked out by each lookup that reads it."""
        first = F.lit(0)
        tests = numbered_tests(pvt)
        points = _stretches(levels(measured(pvt), tests.drop("END_DATE"), *blocks_of_test("index"), RANGE))
        return cls(
            tests.drop("TESTS").withColumns({"SINCE": first, "UNTIL": first}), points.withColumn("GENERATION", first)
        )

    @classmethod
    def load(cls, spark: SparkSession, name: str) -> CurveIndex:
        """A stored index as it is now."""
        tests = spark.table(f"{name}_tests")
        # The last generation that has a completion has all its tests.
        newest = F.max("GENERATION").over(W.partitionBy("ID_COMPLETION"))
        current = tests.withColumn("UNTIL", newest).filter("GENERATION = UNTIL").drop("GENERATION")
        return cls(current, spark.table(f"{name}_points"))

    def bracket(self, requests: DataFrame, scope: str = "all_to_date") -> DataFrame:
        """What ``packed_bracket`` gives, from the index; no raw point is read."""
        if scope not in SCOPES:
            raise ValueError(f"unknown scope: {scope}")
        return answered(requests, lambda asked: self._search(asked, scope))

    def _search(self, asked: DataFrame, scope: str) -> DataFrame:
        return self.search(self.with_known_tests(asked), scope)

    def with_known_tests(self, requests: DataFrame) -> DataFrame:
        """Requests with the last test known at the end of their month, if any."""
        return interval_join(
            requests.withColumn("__month_end", month_end(F.col("VRR_DATE"))),
            self.tests,
            on=["ID_COMPLETION"],
            at="__month_end",
            start="TEST_DATE",
            end="END_DATE",
            how="left",
        ).drop("__month_end")

    def search(self, known: DataFrame, scope: str) -> DataFrame:
        """The points around requests that know their TEST_NO."""
        sizes, block = blocks_of_prefix(scope)
        key = [c for c in known.columns if c not in self.tests.columns or c == "ID_COMPLETION"]
        # Requests without a test or a pressure have no block, and stay for the left join.
        probes = (
            known.select(F.struct(*key).alias("__key"), "ID_COMPLETION", "PRESSURE", "TEST_NO", "SINCE", "UNTIL")
            .withColumn("__size", F.explode_outer(F.when(F.col("PRESSURE").isNotNull(), sizes)))
            .withColumnsRenamed({"PRESSURE": "__x"})
            .withColumn("BLOCK", block)
            .withColumnRenamed("__size", "SIZE")
            .withColumn("CELL", F.expr(cell_of("__x")))
        )
        q, i, x = (lambda c: F.col(f"__q.{c}")), (lambda c: F.col(f"__i.{c}")), F.col("__q.__x")
        same = [q(c) == i(c) for c in BUCKETED_BY]
        within = [i("FROM_PRESSURE") <= x, x < i("TO_PRESSURE"), i("GENERATION").between(q("SINCE"), q("UNTIL"))]
        hit, none = i("FROM_PRESSURE") == x, F.lit(0).cast("bigint")
        found = (
            probes.alias("__q")
            .join(self.points.alias("__i"), [*same, *within], "left")
            .select(
                q("__key").alias("__key"),
                F.when(hit, i("POINT")).alias("AT"),
                F.when(hit, i("DOWN")).otherwise(i("POINT")).alias("LOWER"),
                F.when(hit, i("DOWN2")).otherwise(i("DOWN")).alias("LOWER2"),
                i("UP").alias("UPPER"),
                i("UP2").alias("UPPER2"),
                F.coalesce(i("PASSED") - F.when(hit, i("HERE")).otherwise(none), none).alias("BELOW"),
                F.coalesce(i("TOTAL") - i("PASSED"), none).alias("ABOVE"),
            )
        )
        return (found if scope == "active" else gathered(found)).select("__key.*", *FOUND)

    def measured(self) -> DataFrame:
        """The points that the index was built from, as ``curves.measured`` gives them: equal ones once, counted."""
        own_cell = F.expr(f"POINT IS NOT NULL AND SIZE = 0 AND CELL = {cell_of('FROM_PRESSURE')}")
        points = self.points.filter(own_cell).select("ID_COMPLETION", "BLOCK", "POINT", "HERE", "GENERATION")
        tests = self.tests.select(F.col("ID_COMPLETION").alias("__c"), "TEST_NO", "SINCE", "UNTIL")
        same = F.expr("ID_COMPLETION = __c AND BLOCK = TEST_NO AND GENERATION BETWEEN SINCE AND UNTIL")
        joined = points.join(tests, same)
        return joined.select(
            "ID_COMPLETION",
            F.col("POINT.TEST_DATE").alias("TEST_DATE"),
            F.col("POINT.PRESSURE").alias("PRESSURE"),
            F.col("POINT").alias("p"),
            F.col("HERE").alias("n"),
        )


def store_index(pvt: DataFrame, name: str, buckets: int = 64) -> CurveIndex:
    """Build the index of ``pvt`` as generation 0 of new tables ``<name>_tests`` and ``<name>_points``."""
    built = CurveIndex.of(pvt)
    in_buckets = built.points.repartition(buckets, *BUCKETED_BY)
    in_buckets.write.partitionBy("GENERATION").bucketBy(buckets, *BUCKETED_BY).saveAsTable(f"{name}_points")
    tests = built.tests.drop("UNTIL").withColumn("GENERATION", F.lit(0))
    tests.write.partitionBy("GENERATION").saveAsTable(f"{name}_tests")
    return CurveIndex.load(pvt.sparkSession, name)


def refresh_index(new: DataFrame, name: str) -> CurveIndex:
    """Add points to a stored index; of what is there only completions with new points are read, from the index.

    The generation counts from the moment its tests are written, which is last: a
    refresh that fails before leaves the index as it was, and the next one writes
    over what it left behind.
    """
    spark = new.sparkSession
    was = CurveIndex.load(spark, name)
    generation = 1 + spark.table(f"{name}_tests").agg(F.coalesce(F.max("GENERATION"), F.lit(0))).first()[0]
    tests, points = _refreshed(was, new, generation)
    bucket_count = spark.sql(f"DESCRIBE EXTENDED {name}_points").filter("col_name = 'Num Buckets'").first()["data_type"]
    _append(points.repartition(int(bucket_count), *BUCKETED_BY), f"{name}_points", generation)
    _append(tests, f"{name}_tests", generation)
    return CurveIndex.load(spark, name)


def _refreshed(was: CurveIndex, new: DataFrame, generation: int) -> tuple[DataFrame, DataFrame]:
    """Tests and new blocks of the completions that ``new`` has points of."""
    fresh = new.filter(F.col("TEST_DATE").isNotNull()).select("ID_COMPLETION", "TEST_DATE").distinct()
    touched = fresh.groupBy("ID_COMPLETION").agg(F.min("TEST_DATE").alias("__first"))
    old = was.tests.join(touched, "ID_COMPLETION", "left_semi")
    had = old.groupBy("ID_COMPLETION").agg(
        F.count(F.lit(1)).alias("__had"), F.max("TEST_DATE").alias("__last"), F.max("SINCE").alias("__since")
    )
    # A completion whose new tests are all later keeps its blocks; any other starts again.
    goes_on = F.coalesce(F.col("__first") > F.col("__last"), F.lit(False))
    state = touched.join(had, "ID_COMPLETION", "left").select(
        "ID_COMPLETION",
        F.when(goes_on, F.col("__had")).otherwise(F.lit(0)).alias("__had"),
        F.when(goes_on, F.col("__since")).otherwise(F.lit(generation)).alias("SINCE"),
    )
    tests = numbered_tests(old.select("ID_COMPLETION", "TEST_DATE").union(fresh)).join(state, "ID_COMPLETION")
    kept = was.measured().join(touched, "ID_COMPLETION", "left_semi")
    last_of_block = F.expr("shiftleft(shiftright(TEST_NO, __size) + 1, __size)")
    filed = levels(
        kept.unionByName(measured(new)),
        tests.select("ID_COMPLETION", "TEST_DATE", "TEST_NO", "TESTS", "__had"),
        *blocks_of_test("index"),
        RANGE,
        only=last_of_block > F.col("__had"),
    )
    return tests.select("ID_COMPLETION", "TEST_DATE", "TEST_NO", "END_DATE", "SINCE"), _stretches(filed)


def _append(rows: DataFrame, table: str, generation: int) -> None:
    """Write a generation; what a failed refresh wrote under its number goes first."""
    spark = rows.sparkSession
    columns = ", ".join(c for c in spark.table(table).columns if c != "GENERATION")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (GENERATION = {generation})")
    spark.sql(f"INSERT INTO {table} PARTITION (GENERATION = {generation}) SELECT {columns} FROM {{rows}}", rows=rows)
