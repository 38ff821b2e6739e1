"""Registered queries of the training-data operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm import chat, decontaminate, language, lexical, licenses, packing, pii, quality, sharding, simhash, spelling, tokens, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


@_query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def longest_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where op3 finds benchmark text: every verbatim match at its full length."""
    return decontaminate.longest_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


@_query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


@_query
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.EVERY == 0)


@_query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


@_query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"))


@_query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), keep_ids=False)


@_query
def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_conversations(chat.with_probe(_table(spark, sf_dir, "conversations"))))


@_query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


@_query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLE = {
    "op1_sharding": sharding.sql_shards(),
    "op3_decontamination": decontaminate.sql_contamination(),
    "longest_matches": decontaminate.sql_longest(),
    "op6_top_k": topk.sql_top_k(),
    "op7_licenses": licenses.sql_licenses(),
    "op11_chat": chat.sql_chat(),
    "op12_spelling": spelling.sql_variants(),
    "op13_lexical": lexical.sql_ranked(),
}
