"""A corpus from raw documents: quality, near-duplicates, benchmark passages, personal data, packed sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm import decontaminate, packing, pii, quality, simhash
from confluo.session import store_step


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group."""
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without much benchmark text."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked; the character count follows."""
    masked = pii.redact(docs, pii.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in masked.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of fixed length."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("packing", pack),
]

# Models, token ids and 64-bit hashes are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store_step(docs, f"corpus-{name}")
    return docs
