"""Catalogue views over the test tables, once in Spark and once in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.functions.text import strip_tags
from confluo.schemas import CATALOGUE
from confluo.session import spread

COLUMNS = CATALOGUE.names


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A name is the whole first sentence: what stands before the first stop or line break.
_SENTENCE = r"^[^.!?\n]*"


def first_sentence(text: str):
    return F.trim(F.regexp_extract(text, _SENTENCE, 0))


def _none(kind: str):
    return F.lit(None).cast(kind)


def _no_list():
    return F.array().cast("array<string>")


def src_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.lit("docs").alias("source"),
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("e"), F.col("doc_id").cast("string")).alias("entity_id"),
        first_sentence("text").alias("name"),
        _none("string").alias("storyline"),
        F.col("text").alias("summary"),
        F.array("lang").alias("genres"),
        F.array("source").alias("platforms"),
        F.array("source").alias("devs"),
        F.date_add(F.lit("2010-01-01").cast("date"), (F.col("doc_id") * 37 % 3650).cast("int")).cast("timestamp").alias("date"),
        F.col("n_chars").alias("popularity"),
    )


def src_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id").select(
        F.lit("pages").alias("source"),
        F.col("page_id").cast("string").alias("id"),
        F.concat(F.lit("e"), F.col("page_id").cast("string")).alias("entity_id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("name"),
        _none("string").alias("storyline"),
        strip_tags(F.col("html")).alias("summary"),
        F.array(F.regexp_extract("url", "^https?://[^/]+/([^/?#]+)", 1)).alias("genres"),
        _no_list().alias("platforms"),
        F.array(F.regexp_extract("url", "^https?://([^/]+)", 1)).alias("devs"),
        _none("timestamp").alias("date"),
        F.length("html").cast("long").alias("popularity"),
    )


def src_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per turn; the first turn stands for the entity shared with the other sources."""
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    name = first_sentence("text")
    return table(spark, sf_dir, "conversations").select(
        F.lit("conv").alias("source"),
        key.alias("id"),
        F.when(F.col("turn") == 0, F.concat(F.lit("e"), F.col("conv_id").cast("string")))
        .otherwise(F.concat(F.lit("c"), key))
        .alias("entity_id"),
        name.alias("name"),
        F.concat_ws(" ", F.col("role"), name).alias("storyline"),
        F.col("text").alias("summary"),
        F.array("role").alias("genres"),
        _no_list().alias("platforms"),
        _no_list().alias("devs"),
        _none("timestamp").alias("date"),
        (F.col("turn") + 1).alias("popularity"),
    )


def src_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lit("parts").alias("source"),
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("entity_id"),
        F.col("p_name").alias("name"),
        _none("string").alias("storyline"),
        _none("string").alias("summary"),
        F.array("p_type").alias("genres"),
        _no_list().alias("platforms"),
        F.array("p_brand").alias("devs"),
        _none("timestamp").alias("date"),
        F.col("p_size").cast("long").alias("popularity"),
    )


def src_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("entity_id"),
        F.col("o_orderpriority").alias("name"),
        _none("string").alias("storyline"),
        _none("string").alias("summary"),
        F.array("o_orderstatus").alias("genres"),
        _no_list().alias("platforms"),
        _no_list().alias("devs"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
        F.col("o_totalprice").cast("long").alias("popularity"),
    )


READERS = {"docs": src_docs, "pages": src_pages, "conv": src_conv, "parts": src_parts, "orders": src_orders}


# SQL twins ------------------------------------------------------------------------------------------------------------

TOK = r"'[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*'"


def sql_tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {TOK})"


def sql_sentence(text: str) -> str:
    return f"trim(regexp_extract({text}, '^[^.!?\\n]*'))"


SQL = {
    "docs": f"""SELECT 'docs' AS source, CAST(doc_id AS VARCHAR) AS id, 'e' || doc_id AS entity_id,
        {sql_sentence("text")} AS name, CAST(NULL AS VARCHAR) AS storyline, text AS summary, [lang] AS genres, [source] AS platforms,
        [source] AS devs, CAST(DATE '2010-01-01' + CAST(doc_id * 37 % 3650 AS INTEGER) AS TIMESTAMP) AS date, n_chars AS popularity
        FROM documents""",
    "pages": """SELECT 'pages' AS source, CAST(page_id AS VARCHAR) AS id, 'e' || page_id AS entity_id,
        regexp_extract(html, '<title>([^<]*)</title>', 1) AS name, CAST(NULL AS VARCHAR) AS storyline,
        regexp_replace(html, '<([^\\n]*?)>', '', 'g') AS summary, [regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1)] AS genres,
        CAST([] AS VARCHAR[]) AS platforms, [regexp_extract(url, '^https?://([^/]+)', 1)] AS devs,
        CAST(NULL AS TIMESTAMP) AS date, CAST(length(html) AS BIGINT) AS popularity FROM pages""",
    "conv": f"""SELECT 'conv' AS source, conv_id || '-' || turn AS id,
        CASE WHEN turn = 0 THEN 'e' || conv_id ELSE 'c' || conv_id || '-' || turn END AS entity_id,
        {sql_sentence("text")} AS name, role || ' ' || {sql_sentence("text")} AS storyline, text AS summary, [role] AS genres,
        CAST([] AS VARCHAR[]) AS platforms, CAST([] AS VARCHAR[]) AS devs, CAST(NULL AS TIMESTAMP) AS date,
        turn + 1 AS popularity FROM conversations""",
    "parts": """SELECT 'parts' AS source, CAST(p_partkey AS VARCHAR) AS id, 'p' || p_partkey AS entity_id, p_name AS name,
        CAST(NULL AS VARCHAR) AS storyline, CAST(NULL AS VARCHAR) AS summary, [p_type] AS genres, CAST([] AS VARCHAR[]) AS platforms,
        [p_brand] AS devs, CAST(NULL AS TIMESTAMP) AS date, CAST(p_size AS BIGINT) AS popularity FROM part""",
    "orders": """SELECT 'orders' AS source, CAST(o_orderkey AS VARCHAR) AS id, 'o' || o_orderkey AS entity_id,
        o_orderpriority AS name, CAST(NULL AS VARCHAR) AS storyline, CAST(NULL AS VARCHAR) AS summary, [o_orderstatus] AS genres,
        CAST([] AS VARCHAR[]) AS platforms, CAST([] AS VARCHAR[]) AS devs, CAST(o_orderdate AS TIMESTAMP) AS date,
        CAST(floor(o_totalprice) AS BIGINT) AS popularity FROM orders""",
}


def sql_catalogue(*sources: str) -> str:
    return "\nUNION ALL BY NAME\n".join(SQL[s] for s in sources)
