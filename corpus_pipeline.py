"""Clean a corpus and pack it for training, in five stages, each one operator of ``voidage.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voidage.llm import exact, near, packing, pseudonyms, toxicity
from voidage.llm.common import stored


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from ``labels`` that are not held out."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of the documents with equal texts stays, that with the largest doc_id."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by four fifths of their five-word shingles, the smallest doc_id."""
    return near.keep_one(docs, width=5, percent=80)


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets pseudonyms; ``n_chars`` follows where it counted the old text."""
    text = docs["text"]
    counted = docs["n_chars"] == F.length(text)
    marked = docs.withColumn("n_chars", F.when(counted, F.lit(-1)).otherwise(docs["n_chars"]))
    clean = pseudonyms.pseudonymise(marked)
    n_chars = F.when(clean["n_chars"] == -1, F.length(clean["text"])).otherwise(clean["n_chars"])
    return clean.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of token sequences of at most 4096."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("toxicity", not_toxic),
    ("exact dedup", exact_dedup),
    ("minhash near-dedup", near_dedup),
    ("pii", no_personal_data),
    ("best-fit packing", packed),
]

#: Neither a trained network nor a tokenizer has a SQL form; the tests have a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
