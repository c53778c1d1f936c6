"""The base tables, derived from the star-schema Parquet files used for checks."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from voidage.sources import schemas
from voidage.sources.tables import conform


class Field:
    """The four base tables of one field, each derived when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def pvt(self) -> DataFrame:
        return pvt(self.spark, self.sf_dir)

    @cached_property
    def pressures(self) -> DataFrame:
        return pattern_pressure(self.spark, self.sf_dir)

    @cached_property
    def factors(self) -> DataFrame:
        return contribution_factor(self.spark, self.sf_dir)

    @cached_property
    def volumes(self) -> DataFrame:
        return daily_volume(self.spark, self.sf_dir)


# The columns read, typed so that no file is opened to infer them.
_READ = {
    "part": "p_partkey BIGINT, p_size INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_READ[name]).parquet(f"{sf_dir}/{name}.parquet")


def _named(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def pvt(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    points = (
        _read(spark, sf_dir, "part")
        .withColumn("n", n)
        .selectExpr("p_partkey % n AS s", "p_partkey div n AS k", "CAST(p_size AS DOUBLE) AS z")
    )
    # A tenth of the completions have no test and a tenth one point: their other
    # points belong to test wells, which no factor and no volume refers to.
    elsewhere = F.expr("s % 10 = 9 OR (s % 10 = 8 AND k <> 0)")
    z = F.col("z")
    k = F.col("k")
    return conform(
        points.select(
            F.when(elsewhere, _named("T", F.col("s"))).otherwise(_named("C", F.col("s"))).alias("ID_COMPLETION"),
            F.date_add(F.lit("1995-01-15").cast("date"), (500 * (k % 4)).cast("int")).alias("TEST_DATE"),
            (1000 + 500 * F.expr("k div 4") + 50 * (z % 10)).alias("PRESSURE"),
            (1 + z / 64).alias("OIL_FORMATION_VOLUME_FACTOR"),
            (z / 1024).alias("GAS_FORMATION_VOLUME_FACTOR"),
            (1 + z / 512).alias("WATER_FORMATION_VOLUME_FACTOR"),
            (100 + 10 * z).alias("SOLUTION_GAS_OIL_RATIO"),
            (z / 4096).alias("VOLATIZED_OIL_GAS_RATIO"),
            (1 + z / 16).alias("VISCOSITY_OIL"),
            (0.5 + z / 128).alias("VISCOSITY_WATER"),
            F.when(z != 13, z / 2048).alias("VISCOSITY_GAS"),
            (z / 2048).alias("INJECTED_GAS_FORMATION_VOLUME_FACTOR"),
            (1 + z / 256).alias("INJECTED_WATER_FORMATION_VOLUME_FACTOR"),
        ),
        schemas.PVT,
    )


def pattern_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("DATE"),
    )
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return conform(
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .groupBy("c_nationkey", "DATE")
        .agg(F.sum("o_orderkey").alias("keys"))
        .select(
            _named("P", F.col("c_nationkey")).alias("ID_PATTERN"),
            "DATE",
            (800 + 50 * (F.col("keys") % 60)).alias("PRESSURE"),
        ),
        schemas.PATTERN_PRESSURE,
    )


def contribution_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every supplier belongs to two patterns; most change factor once.
    role, period = F.col("x"), F.col("v")
    suppliers = (
        _read(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_nationkey")
        .withColumn("x", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    )
    # A seventh of the completions have no factor and a fifth no second one: these
    # factors belong to planned wells, which have no volumes and no tests.
    elsewhere = F.expr("s_suppkey % 7 = 0 OR (v = 1 AND s_suppkey % 5 = 0)")
    return conform(
        suppliers.select(
            _named("P", (F.col("s_nationkey") + role) % 25).alias("ID_PATTERN"),
            F.when(elsewhere, _named("N", F.col("s_suppkey")))
            .otherwise(_named("C", F.col("s_suppkey")))
            .alias("ID_COMPLETION"),
            F.when(period == 0, "1996-01-01")
            .when(role == 0, "1999-01-01")
            .otherwise("1999-07-01")
            .cast("date")
            .alias("EFFECT_DATE"),
            F.when(role == 0, 0.625 + 0.125 * period).otherwise(0.375 - 0.125 * period).alias("FACTOR"),
        ),
        schemas.CONTRIBUTION_FACTOR,
    )


def daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Reduce the lines to one row per completion, day and type before anything
    # else is joined to them: at most two rows per completion and calendar day.
    days = (
        _read(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("PROD_DATE"), "l_linestatus")
        .agg(
            F.sum("l_quantity").cast("bigint").cast("double").alias("q"),
            F.sum("l_linenumber").cast("double").alias("n"),
        )
    )
    suppliers = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    q, n, produced = F.col("q"), F.col("n"), F.col("l_linestatus") == "F"
    to_date = W.partitionBy("l_suppkey").orderBy("PROD_DATE")
    return conform(
        days.join(suppliers, days.l_suppkey == suppliers.s_suppkey).select(
            _named("P", F.col("s_nationkey")).alias("ID_PATTERN"),
            _named("C", F.col("l_suppkey")).alias("COMPLETION_ID"),
            "PROD_DATE",
            F.when(produced, "Production").otherwise("Injection").alias("AMOUNT_TYPE"),
            F.when(produced & (q % 13 != 0), q).otherwise(0.0).alias("THEOR_OIL_VOL_STB"),
            F.when(produced, 0.5 * q).alias("THEOR_WATER_VOL_STB"),
            F.when(q % 11 == 0, None)
            .when(produced, 0.25 * q + n)
            .otherwise(0.0)
            .alias("THEOR_GAS_VOL_KSCF"),
            F.when(~produced, 2.0 * q).alias("THEOR_WATER_INJ_VOL_STB"),
            F.when(produced, 0.125 * q).alias("ALLOC_GAS_VOL_KSCF"),
            F.when(~produced, 0.5 * n).alias("THEOR_GAS_INJ_VOL_KSCF"),
            F.when(q % 17 != 0, 8.0 * n).alias("FREE_GAS"),
            F.sum(F.when(~produced, q)).over(to_date).alias("CUMULATIVE_INJECTION_VOLUME_RES_BBL"),
            F.sum(F.when(produced, q)).over(to_date).alias("CUMULATIVE_PRODUCTION_VOLUME_RES_BBL"),
        ),
        schemas.DAILY_VOLUME,
    )

