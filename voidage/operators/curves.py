"""Nearest points of a laboratory curve for many requests at once.

A request asks, for its completion, for the nearest pressures below and above
its own among all tests known at a date.  Joining requests to points would pair
every request with every point of the completion.  Two steps avoid that:

* Tests of a completion are numbered by date, and the tests known to a request
  are the first ``KNOWN`` of them.  That prefix is cut into at most 17 blocks of
  2^k consecutive tests, one for each binary digit of ``KNOWN``; each point is
  filed under the blocks that a prefix can use.  Repetition is logarithmic in
  the number of tests, which the calendar bounds.
* Within a block every point carries its neighbours, so a request only needs
  the last point at or below its pressure: requests and points are sorted
  together and "last point seen" is a running value.

The few block results of a request are then reduced to one.

Blocks are cut at multiples of a pressure, so that no task sorts a whole block,
however many points or requests it has. What a request near a cut needs from the
other side, the two nearest points on each side of every range and the number of
points before it, is worked out on one row per block and range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from voidage.functions.dates import month_end, open_end
from voidage.operators.intervals import interval_join
from voidage.sources.schemas import PROPERTIES, REQUEST_KEY

SCOPES = ("all_to_date", "active")

#: Width of the pressure ranges into which blocks are cut.
RANGE = 250.0

_BLOCK = ("ID_COMPLETION", "__size", "__block")
_PIECE = (*_BLOCK, "__range")


def packed_point() -> Column:
    """A point as the search carries it, its properties as one array.

    With three fields instead of twelve the code generated for sorting, comparing
    and choosing points is a quarter as long, and short enough to be compiled.
    """
    return F.struct("PRESSURE", "TEST_DATE", F.array(*PROPERTIES).alias("VALUES"))


def unpacked(point: Column) -> Column:
    """A packed point as a struct of pressure, test date and properties."""
    values = (F.get(point["VALUES"], F.lit(k)).alias(name) for k, name in enumerate(PROPERTIES))
    whole = F.struct(point["PRESSURE"].alias("PRESSURE"), point["TEST_DATE"].alias("TEST_DATE"), *values)
    return F.when(point.isNotNull(), whole)


def numbered_tests(pvt: DataFrame) -> DataFrame:
    """Test dates per completion with their number, end date and count.

    One row per completion and date, so the windows are bounded by the calendar.
    """
    completion = W.partitionBy("ID_COMPLETION")
    in_order = completion.orderBy("TEST_DATE")
    return (
        pvt.filter(F.col("TEST_DATE").isNotNull())
        .select("ID_COMPLETION", "TEST_DATE")
        .distinct()
        .select(
            "ID_COMPLETION",
            "TEST_DATE",
            (F.row_number().over(in_order) - 1).alias("TEST_NO"),
            F.coalesce(F.lead("TEST_DATE").over(in_order), open_end()).alias("END_DATE"),
            F.count(F.lit(1)).over(completion).cast("int").alias("TESTS"),
        )
    )


def with_known_tests(requests: DataFrame, pvt: DataFrame) -> DataFrame:
    """Add the last test known at the end of the request's month, if any.

    Adds TEST_NO, TEST_DATE and END_DATE, so the requests must not have these.
    """
    return interval_join(
        requests.withColumn("__month_end", month_end(F.col("VRR_DATE"))),
        numbered_tests(pvt).select("ID_COMPLETION", "TEST_NO", "TEST_DATE", "END_DATE"),
        on=["ID_COMPLETION"],
        at="__month_end",
        start="TEST_DATE",
        end="END_DATE",
        how="left",
    ).drop("__month_end")


def _sizes(n: str) -> str:
    """The binary digits that a number up to ``n`` can have."""
    return f"sequence(0, CAST(floor(log2({n})) AS INT) + 1)"


def blocks_of_prefix_sql(scope: str) -> tuple[str, str]:
    """The sizes of the blocks that the tests up to TEST_NO consist of, and the block of a ``{size}``, as SQL text."""
    if scope not in SCOPES:
        raise ValueError(f"unknown scope: {scope}")
    if scope == "active":
        return "array(0)", "TEST_NO"
    sizes = f"filter({_sizes('TEST_NO + 1')}, k -> shiftright(TEST_NO + 1, k) & 1 = 1)"
    return sizes, "shiftright(TEST_NO + 1, {size} + 1) * 2"


def blocks_of_prefix(scope: str) -> tuple[Column, Column]:
    sizes, block = blocks_of_prefix_sql(scope)
    return F.expr(sizes), F.expr(block.format(size="__size"))


def blocks_of_test(scope: str) -> tuple[Column, Column]:
    if scope == "active":
        return F.expr("array(0)"), F.col("TEST_NO")
    # A prefix only uses even-numbered blocks that are full. An index has every test as a block, too.
    single = "k = 0 OR " if scope == "index" else ""
    used = f"{single}(shiftright(TEST_NO, k) & 1 = 0 AND shiftleft(shiftright(TEST_NO, k) + 1, k) <= TESTS)"
    return F.expr(f"filter({_sizes('TESTS')}, k -> {used})"), F.expr("shiftright(TEST_NO, __size)")


def _range_of(pressure: str, width: float) -> Column:
    return F.floor(F.col(pressure) / F.lit(float(width)))


def measured(pvt: DataFrame) -> DataFrame:
    """Points that a search can find: packed (``p``), with the number of rows each stands for (``n``)."""
    return pvt.filter(F.col("PRESSURE").isNotNull() & F.col("TEST_DATE").isNotNull()).select(
        "ID_COMPLETION", "TEST_DATE", "PRESSURE", packed_point().alias("p"), F.lit(1).cast("bigint").alias("n")
    )


def _points(pvt: DataFrame, scope: str, width: float) -> DataFrame:
    return levels(measured(pvt), numbered_tests(pvt).drop("END_DATE"), *blocks_of_test(scope), width)


def levels(
    points: DataFrame, tests: DataFrame, sizes: Column, block: Column, width: float, only: Column | None = None
) -> DataFrame:
    """Points per block and range with their neighbours in the range.

    One row per block and pressure, of equal pressures the latest test.  A task
    sorts the distinct pressures of one range of a block.  ``only`` chooses blocks.
    """
    filed = (
        points.join(tests, ["ID_COMPLETION", "TEST_DATE"])
        .withColumn("__size", F.explode(sizes))
        .withColumn("__block", block)
    )
    distinct = (
        (filed if only is None else filed.filter(only))
        .withColumn("__range", _range_of("PRESSURE", width))
        .groupBy(*_PIECE, "PRESSURE")
        .agg(F.max("p").alias("p"), F.sum("n").alias("__points"))
    )
    rising = f"OVER (PARTITION BY {', '.join(_PIECE)} ORDER BY PRESSURE)"
    return distinct.selectExpr(
        *_PIECE,
        "p",
        f"lag(p, 1) {rising} AS below",
        f"lag(p, 2) {rising} AS below2",
        f"lead(p, 1) {rising} AS above",
        f"lead(p, 2) {rising} AS above2",
        f"sum(__points) {rising} AS to_here",
        "__points",
    )


def _surroundings(points: DataFrame, probes: DataFrame | None = None) -> DataFrame:
    """Per block and range that has points or requests, what lies around it.

    ``own`` are the two lowest points of the range itself, ``under`` the two
    nearest below the range and ``over`` the two nearest above it, nearest first;
    ``before`` is the number of points below the range, ``all`` that of the block.
    Only a block's ranges are sorted together, one row each.
    """
    ends = points.filter("below2 IS NULL OR above2 IS NULL").selectExpr(
        *_PIECE,
        "CASE WHEN below2 IS NULL THEN p END AS low",
        "CASE WHEN above2 IS NULL THEN p END AS high",
        "to_here AS n",
    )
    if probes is not None:
        ends = ends.unionByName(probes.select(*_PIECE), allowMissingColumns=True)
    ranges = ends.groupBy(*_PIECE).agg(
        F.expr("array_sort(collect_list(low)) AS low"),
        F.expr("sort_array(collect_list(high), false) AS high"),
        F.expr("max(n) AS n"),
    )
    of_block = f"PARTITION BY {', '.join(_BLOCK)}"
    earlier = f"OVER ({of_block} ORDER BY __range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    later = f"OVER ({of_block} ORDER BY __range ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    last = lambda c: f"last(CASE WHEN n IS NOT NULL THEN {c} END, true) {earlier}"
    first = lambda c: f"first(CASE WHEN n IS NOT NULL THEN {c} END, true) {later}"
    # Two neighbouring ranges with points have two points between them.
    linked = ranges.selectExpr(
        *_PIECE,
        "slice(low, 1, 2) AS own",
        f"{_two('low', first('low'))} AS up",
        f"{_two('high', last('high'))} AS down",
        f"sum(n) {earlier} AS before",
        f"sum(n) OVER ({of_block}) AS all",
        "n",
    )
    return linked.selectExpr(
        *_PIECE,
        f"""struct(own, {last('down')} AS under, {first('up')} AS over, coalesce(before, 0L) AS before,
                   coalesce(all, 0L) AS all) AS around""",
    )


def _two(near: str, beyond: str) -> str:
    """The first two points of an array and then those of another, which may be NULL."""
    return f"slice(concat({near}, coalesce({beyond}, slice({near}, 1, 0))), 1, 2)"


def _present(*points: str) -> str:
    return f"filter(array({', '.join(points)}), p -> p IS NOT NULL)"


def neighbours(points: DataFrame) -> DataFrame:
    """``levels`` with each point's neighbours in its whole block, and the points up to it and in all."""
    linked = points.join(_surroundings(points), list(_PIECE)).selectExpr(
        "*",
        f"{_two(_present('below', 'below2'), 'around.under')} AS __down",
        f"{_two(_present('above', 'above2'), 'around.over')} AS __up",
    )
    return linked.selectExpr(
        *_BLOCK,
        "p AS POINT",
        "get(__down, 0) AS DOWN",
        "get(__down, 1) AS DOWN2",
        "get(__up, 0) AS UP",
        "get(__up, 1) AS UP2",
        "__points AS HERE",
        "around.before + to_here AS PASSED",
        "around.all AS TOTAL",
    )


def _floors(points: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes (``__key``, ``__x``) with the points around them, from one sort per range of a block."""
    level = "struct(p, below, below2, above, above2, to_here, __points) AS f"
    merged = (
        points.selectExpr(*_PIECE, "p.PRESSURE AS __x", level)
        .unionByName(probes, allowMissingColumns=True)
        .unionByName(_surroundings(points, probes), allowMissingColumns=True)
    )
    # What is around comes first, and a point precedes the requests at its pressure.
    rising = f"OVER (PARTITION BY {', '.join(_PIECE)} ORDER BY __x ASC NULLS FIRST, f IS NULL ROWS UNBOUNDED PRECEDING)"
    found = merged.selectExpr(
        "__key", "__x", f"last(f, true) {rising} AS f", f"first(around, true) {rising} AS c"
    ).filter("__key IS NOT NULL")
    hit = found.selectExpr("*", "coalesce(f.p.PRESSURE = __x, false) AS __hit")
    sides = hit.selectExpr(
        "__key",
        "CASE WHEN __hit THEN f.p END AS AT",
        f"""{_two("CASE WHEN __hit THEN " + _present('f.below', 'f.below2') + " ELSE " + _present('f.p', 'f.below') + " END",
                  'c.under')} AS __below""",
        f"""{_two("CASE WHEN f IS NULL THEN " + _present('get(c.own, 0)', 'get(c.own, 1)') + " ELSE "
                  + _present('f.above', 'f.above2') + " END", 'c.over')} AS __above""",
        "c.before + coalesce(f.to_here, 0L) - CASE WHEN __hit THEN f.__points ELSE 0L END AS BELOW",
        "c.all - c.before - coalesce(f.to_here, 0L) AS ABOVE",
    )
    return sides.selectExpr(
        "__key",
        "AT",
        "get(__below, 0) AS LOWER",
        "get(__below, 1) AS LOWER2",
        "get(__above, 0) AS UPPER",
        "get(__above, 1) AS UPPER2",
        "BELOW",
        "ABOVE",
    )


SIDES = ("AT", "LOWER", "LOWER2", "UPPER", "UPPER2")
FOUND = (*SIDES, "BELOW", "ABOVE")


def bracket(
    requests: DataFrame, pvt: DataFrame, scope: str = "all_to_date", width: float | None = None
) -> DataFrame:
    """Add the nearest points of each request.

    ``requests`` have ID_COMPLETION, VRR_DATE and PRESSURE; other columns are
    kept, and rows that repeat come back as often.  Added are the points AT the
    pressure, LOWER and LOWER2 (the two nearest distinct pressures below), UPPER
    and UPPER2 (above), each a struct of pressure, test date and properties or
    NULL, and the number of points BELOW and ABOVE.  Of equal pressures the
    latest test wins.

    ``scope`` is ``all_to_date`` for the points of every test known by the end
    of the request's month, or ``active`` for those of the last such test only.
    ``width`` is that of the pressure ranges by which the work is cut; it does
    not change the result.
    """
    found = packed_bracket(requests, pvt, scope, width)
    return found.withColumns({name: unpacked(F.col(name)) for name in SIDES})


def packed_bracket(
    requests: DataFrame, pvt: DataFrame, scope: str = "all_to_date", width: float | None = None
) -> DataFrame:
    """``bracket`` with its points packed, for those who choose among them first."""
    if scope not in SCOPES:
        raise ValueError(f"unknown scope: {scope}")
    return answered(requests, lambda asked: search(with_known_tests(asked, pvt), pvt, scope, width))


def search(known: DataFrame, pvt: DataFrame, scope: str, width: float | None = None) -> DataFrame:
    """The points around requests that know their TEST_NO, one row per request: its columns and ``FOUND``."""
    width = RANGE if width is None else width
    sizes, block = blocks_of_prefix(scope)
    key = [c for c in known.columns if c not in ("TEST_NO", "TEST_DATE", "END_DATE")]
    known = (
        # A request without a pressure matches nothing, like one without a test.
        known.withColumn("TEST_NO", F.when(F.col("PRESSURE").isNotNull(), F.col("TEST_NO")))
        .withColumn("__key", F.struct(*key))
    )
    probes = (
        known.filter(F.col("TEST_NO").isNotNull())
        .withColumn("__size", F.explode(sizes))
        .withColumn("__block", block)
        .withColumn("__range", _range_of("PRESSURE", width))
        .select(*_PIECE, F.col("PRESSURE").alias("__x"), "__key")
    )
    found = _floors(_points(pvt, scope, width), probes)
    if scope != "active":
        found = gathered(found)
    none = F.lit(0).cast("bigint")
    point = found.schema["AT"].dataType
    without = known.filter(F.col("TEST_NO").isNull()).select(
        "__key", *(F.lit(None).cast(point).alias(n) for n in SIDES), none.alias("BELOW"), none.alias("ABOVE")
    )
    return found.unionByName(without).select("__key.*", *FOUND)


def answered(requests: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Requests with what ``search`` adds to their keys; equal requests are searched once.

    ``search`` gets one row per distinct key and gives one row back for each, with
    columns of its own behind the columns it got.
    """
    key = list(REQUEST_KEY)
    only_keys = set(requests.columns) == set(key)
    asked = requests.groupBy(*key).agg(F.count(F.lit(1)).alias("__times"))
    answers = search(asked)
    added = [c for c in answers.columns if c not in (*key, "__times")]
    if only_keys:
        again = answers.withColumn("__time", F.explode(F.sequence(F.lit(1), F.col("__times"))))
        return again.select(*requests.columns, *added)
    same = [F.col(f"__q.{name}").eqNullSafe(F.col(f"__a.{name}")) for name in key]
    joined = requests.alias("__q").join(answers.alias("__a"), same, "left")
    return joined.select(*(F.col(f"__q.{c}") for c in requests.columns), *(F.col(f"__a.{n}") for n in added))


def gathered(found: DataFrame) -> DataFrame:
    """The block results of each request as one."""
    lists = found.groupBy("__key").agg(
        F.expr("max(AT) AS AT"),
        F.expr("flatten(collect_list(array(LOWER, LOWER2))) AS __lower"),
        F.expr("flatten(collect_list(array(UPPER, UPPER2))) AS __upper"),
        F.expr("sum(BELOW) AS BELOW"),
        F.expr("sum(ABOVE) AS ABOVE"),
    )
    nearest = lists.selectExpr("*", "array_max(__lower) AS LOWER", f"{lowest('__upper')} AS UPPER")
    second = nearest.selectExpr(
        "*",
        "array_max(filter(__lower, p -> p.PRESSURE < LOWER.PRESSURE)) AS LOWER2",
        "filter(__upper, p -> p.PRESSURE > UPPER.PRESSURE) AS __above",
    )
    return second.selectExpr("__key", *(f"{lowest('__above')} AS UPPER2" if n == "UPPER2" else n for n in FOUND))


def lowest(points: str) -> str:
    """The point of the lowest pressure in an array, and of those the one tested last, as SQL text."""
    pressure = f"array_min(transform({points}, p -> p.PRESSURE))"
    return f"array_max(filter({points}, p -> p.PRESSURE = {pressure}))"
