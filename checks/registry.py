"""Registered queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import sql_catalogue, sql_tokens
from confluo.functions.text import MIN_LENGTH, STOP_WORDS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def sql_analysed(text: str, min_length: int) -> str:
    return f"list_filter({sql_tokens(f'coalesce({text}, {chr(39) * 2})')}, lambda t: length(t) >= {min_length} AND t NOT IN ({STOP}))"


def sql_search(sources: list[str], fields: tuple[str, ...] = ("name", "storyline", "summary")) -> str:
    """CTE list: catalogue, tokens, postings, statistics and the BM25 part of every posting."""
    per_field = "\nUNION ALL\n".join(
        f"SELECT source, id, entity_id, '{f}' AS field, {sql_analysed(f, MIN_LENGTH[f])} AS tokens FROM cat" for f in fields
    )
    return f"""cat AS ({sql_catalogue(*sources)}),
tok AS (SELECT *, CAST(len(tokens) AS BIGINT) AS len FROM ({per_field}) WHERE len(tokens) > 0),
occ AS (SELECT source, id, entity_id, field, len, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos FROM tok),
post AS (SELECT source, id, entity_id, field, len, term, count(*) AS tf, min(pos) AS first_pos, max(pos) AS last_pos,
  sum(pos) AS sum_pos FROM occ GROUP BY ALL),
dfs AS (SELECT source, field, term, count(*) AS df FROM post GROUP BY ALL),
fst AS (SELECT source, field, count(*) AS n_docs, CAST(sum(len) AS BIGINT) AS total_len, sum(len) / count(*) AS avg_len
  FROM tok GROUP BY ALL),
bm AS (SELECT p.*, ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len)) AS bm
  FROM post p JOIN dfs USING (source, field, term) JOIN fst USING (source, field))"""


WEIGHTS = (("name", 6), ("storyline", 1), ("summary", 1))


def sql_words(rows: list[tuple]) -> str:
    """Rows ``(query_id, clause, role, field or None, boost, term)`` expanded to weighted (field, term) atoms."""
    out = []
    for q, clause, role, field, boost, term in rows:
        for f, w in WEIGHTS if field is None else ((field, 1),):
            if len(term) >= MIN_LENGTH[f]:
                out.append(f"('{q}', {clause}, '{role}', '{f}', CAST({boost * w} AS DOUBLE), '{term}')")
    return f"atom(query_id, clause, role, field, weight, term) AS (VALUES {', '.join(out)})"


TERM_HITS = "hit AS (SELECT a.query_id, a.clause, a.role, b.source, b.id, b.entity_id, a.weight * b.bm AS score FROM atom a JOIN bm b USING (field, term))"
DOC_SUM = "doc AS (SELECT query_id, source, id, entity_id, sum(score) AS score FROM hit GROUP BY ALL)"


def sql_top(k: int, by: str = "query_id", table: str = "doc") -> str:
    return f"""SELECT query_id, CAST(rank AS BIGINT) AS rank, source, id, round(score, 6) AS score FROM (
SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY round(score, 6) DESC, source, id) AS rank FROM {table}) WHERE rank <= {k}"""
