"""What the operators share: input columns, intermediate tables, components."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whether Spark removes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that no other column can clash; null text is empty."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that the driver and all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only where it is not
    set and the session runs in one process, as in tests, is it a folder below
    ``/tmp``; executors elsewhere would not see that one, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: no folder that the driver and all executors share is known")
        root = "file:/tmp/checkpoints"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back; its lineage ends there.

    Lost executors cost nothing that is stored. The files stay until the
    application's folder below ``spark.checkpoint.dir`` is removed, as the result
    that reads them is lazy.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    # What a finished step shuffled is not needed again: its table is.
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every id in ``edges`` (columns ``a``, ``b``): ``id``, ``component``.

    Alternating large-star and small-star steps: every node hangs its neighbours
    under the smallest of them, first the larger ones, then the smaller ones, until
    all edges point to a component's smallest id. Path lengths shrink
    geometrically. A step is an aggregation (combined before the shuffle) and an
    equi-join that adaptive execution can split, so that a node with very many
    links is not gathered anywhere. Each step is stored, which cuts the lineage.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    )
    seen = _checksum(now)
    if not seen[0]:
        return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    for _ in range(rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        )
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        after = stored(small.select("e.u", "e.v").filter("u != v").distinct())
        was, seen = seen, _checksum(after)
        now = after
        if seen == was:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    star = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return star.union(star.select(F.col("component").alias("id"), "component").distinct())


def _checksum(edges: DataFrame) -> tuple[int, int, int]:
    """Number of edges and two sums of their hashes: equal as long as no edge changes."""
    half = lambda seed: F.coalesce(F.sum(F.xxhash64("u", "v", F.lit(seed)) % (1 << 20)), F.lit(0))
    return tuple(edges.agg(F.count(F.lit(1)), half(1), half(2)).first())
