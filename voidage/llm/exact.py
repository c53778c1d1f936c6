"""Exact deduplication by keyed streaming state that never expires."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voidage.llm.common import id_and_text, shared_folder, stored

#: Keyed state lives in RocksDB on the executors' disks, its memory bounded for all
#: partitions of an executor together, and is kept in the shared checkpoint folder.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else every partition sets aside megabytes for files of a few kilobytes.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def digest_state(digests: DataFrame) -> DataFrame:
    """The state of the stream ``digests`` (``digest``, ``doc_id``, ``source_file``): one row per digest.

    It retains the digest, the stable identifier of the copy that stays (the
    largest ``doc_id``), the locator of its content (file and identifier) and the
    number of copies. Nothing expires: there is no watermark. Copies are combined
    before the shuffle, so a digest that a third of all rows share moves one row per task.
    """
    return digests.groupBy("digest").agg(
        F.max(F.struct("doc_id", "source_file")).alias("retained"), F.count(F.lit(1)).alias("n")
    )


def run_stream(spark: SparkSession, path: str, schema, max_files: int | None = None, folder: str | None = None) -> DataFrame:
    """Bring the state up to date with all files below ``path``; returns the newest state row of each digest.

    ``folder`` keeps the state and its updates. A later call with the same folder
    reads only the files that are new. A micro-batch that is repeated after a
    failure overwrites its own folder of updates.
    """
    folder = folder or shared_folder(spark)
    source = spark.readStream.schema(schema)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)
    state = digest_state(source.parquet(path))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/updates/batch={number}")

    with _settings(spark, STATE):
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(keep)
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    columns = "digest binary, retained struct<doc_id: bigint, source_file: string>, n bigint"
    updates = spark.read.schema(f"{columns}, batch int").option("basePath", f"{folder}/updates")
    try:
        rows = updates.parquet(f"{folder}/updates")
    except Exception as error:  # no file has ever arrived
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], columns)
    # The number of copies only grows, so the largest is the newest.
    newest = rows.groupBy("digest").agg(F.max(F.struct("n", "retained")).alias("s"))
    return newest.select("digest", "s.retained", "s.n")


def classes(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> tuple[DataFrame, DataFrame]:
    """Classes of equal texts and the digest of every row.

    Classes: ``digest``, ``exact_text``, ``keep_id`` (largest ``doc_id``, null lowest),
    ``group_size``. Every row whose digest was met before is compared with the
    retained copy, byte by byte. ``exact_text`` is null unless different texts share
    a digest; such a digest has one class per text.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs).withColumn("digest", digest(F.col("text")))
    path = shared_folder(spark)
    texts.select("digest", "doc_id", F.input_file_name().alias("source_file")).write.parquet(path)
    rows = spark.read.schema("digest binary, doc_id bigint, source_file string").parquet(path)
    state = stored(run_stream(spark, path, rows.schema))
    hits = state.filter("n > 1").select("digest", F.col("retained.doc_id").alias("keep_id"))
    copy = (
        texts.join(hits, "digest")
        .filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("digest", F.col("text").alias("retained_text"))
    )
    copy = stored(copy.dropDuplicates(["digest"]))
    # Without an aggregation on top, so that adaptive execution can split a digest that very many rows have.
    differing = stored(texts.join(copy, "digest").filter("text != retained_text").select("digest")).distinct()
    plain = state.select(
        "digest",
        F.lit(None).cast("string").alias("exact_text"),
        F.col("retained.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
    )
    if differing.isEmpty():
        return plain, rows.select("digest", "doc_id")
    apart = (
        texts.join(differing, "digest")
        .groupBy("digest", F.col("text").alias("exact_text"))
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return plain.join(differing, "digest", "left_anti").unionByName(apart), texts


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    Texts are equal when identical; a null text is empty. The largest ``doc_id`` of
    equal texts stays; a null ``doc_id`` counts as lowest and stays only among
    nulls. Rows that repeat both ``doc_id`` and text are marked alike. An empty
    table gives no rows; other columns are not read.
    """
    found, rows = classes(docs, digest)
    joined = rows.join(found, "digest")
    if "text" in rows.columns:
        joined = joined.filter("exact_text IS NULL OR exact_text = text")
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def keep_one(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``docs`` with all its columns, one row of each class of equal texts.

    Of rows that repeat both ``doc_id`` and text, any one stays.
    """
    found, rows = classes(docs, digest)
    keys = found.select(
        F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep_id"), F.col("exact_text").alias("__exact_text")
    )
    text = F.coalesce(docs["text"], F.lit(""))
    kept = (
        docs.withColumn("__digest", digest(text))
        .join(keys, "__digest")
        .filter(docs["doc_id"].eqNullSafe(F.col("__keep_id")))
        .filter(F.col("__exact_text").isNull() | (F.col("__exact_text") == text))
    )
    if not rows.groupBy("digest", "doc_id").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["__digest", "__keep_id", "__exact_text"])
    return kept.select(*[docs[name] for name in docs.columns])
