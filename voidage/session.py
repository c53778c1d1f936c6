"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution resizes shuffle partitions and splits skewed join
#: partitions at run time; the rest keeps scans pruned and dates zone-free.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where every partition of the smaller side is at most this large, hash it
    # instead of sorting the larger side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    # A view has some fifty generated classes; the default of 100 entries forgets
    # them between two runs and compiles all of them again.
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.sql.session.timeZone": "UTC",
    # Plans are built from many small expressions; do not record a Python
    # stack trace for each of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voidage")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Small check data would otherwise be coalesced onto one or two cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
