"""Reading and writing the base tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from voidage.functions.dates import month_place
from voidage.sources import schemas


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project a table onto its declared columns and types.

    Stored numerics may be decimals and dates may be timestamps; everything
    downstream works in double and date.  Names match without regard to case.
    """
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def read_path(spark: SparkSession, path: str, table: str, stored_as: T.StructType | None = None) -> DataFrame:
    """A base table stored as Parquet.

    Without ``stored_as``, names and types as stored, files are opened to infer
    them; a table stored by its declaration has ``schemas.TABLES[table]``.
    """
    reader = spark.read if stored_as is None else spark.read.schema(stored_as)
    return conform(reader.parquet(path), schemas.TABLES[table])


def read_table(spark: SparkSession, name: str, table: str) -> DataFrame:
    """A base table registered in a catalog, e.g. ``field.volumes.daily``."""
    return conform(spark.table(name), schemas.TABLES[table])


def write_daily_volumes(volumes: DataFrame, path: str) -> None:
    """Store daily volumes by production year, so date filters prune files.

    Rows are gathered by year before the write; adaptive execution splits a large
    year and merges small ones, so tasks and files are of its advisory size.
    """
    (
        volumes.withColumn("PROD_YEAR", F.year("PROD_DATE"))
        .hint("rebalance", F.col("PROD_YEAR"))
        .write.mode("overwrite")
        .partitionBy("PROD_YEAR")
        .parquet(path)
    )


def store_daily_volumes(volumes: DataFrame, name: str, buckets: int = 64) -> None:
    """Store daily volumes as a catalog table, in buckets by completion and place of the month.

    These are the columns by which the views join daily rows to their schedule, so
    that rows read by ``read_daily_volumes`` are moved once, here, and not again by
    every view. A completion with very many rows is spread over the places of its
    months. ``buckets`` should be a few times the cores, and large enough that a bucket
    of a file is not above the memory of a task.
    """
    by = ["COMPLETION_ID", schemas.MONTH_PLACE]
    placed = volumes.withColumn(schemas.MONTH_PLACE, month_place(F.col("PROD_DATE")))
    placed.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)


def read_daily_volumes(spark: SparkSession, name: str) -> DataFrame:
    """Daily volumes with the place of their month, as ``store_daily_volumes`` has stored them."""
    stored = spark.table(name)
    volumes = schemas.TABLES["production_volumes_daily_oilfield"]
    return stored.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in volumes.fields), F.col(schemas.MONTH_PLACE)
    )


def known_points(
    spark: SparkSession,
    pvt: DataFrame,
    known_by: dt.date,
    completion: str | None = None,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Parameter-bound scan: PVT points tested on or before ``known_by``.

    One completion is bound as a SQL parameter; many are given as a DataFrame
    with an ``ID_COMPLETION`` column and become a semi join.
    """
    if completion is not None:
        return spark.sql(
            "SELECT * FROM {pvt} WHERE ID_COMPLETION = :completion AND TEST_DATE <= :known_by",
            args={"completion": completion, "known_by": known_by},
            pvt=pvt,
        )
    known = spark.sql(
        "SELECT * FROM {pvt} WHERE TEST_DATE <= :known_by", args={"known_by": known_by}, pvt=pvt
    )
    return known if asked is None else known.join(asked, "ID_COMPLETION", "left_semi")
