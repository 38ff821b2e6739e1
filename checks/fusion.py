"""Fusion over sources, result tables and evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.records import catalogue
from checks.registry import DOC_SUM, TERM_HITS, query, sql_search, sql_words
from checks.search import SQL_BATCH, TEXTS, hits_of, passages, tables_of
from checks.views import table
from confluo.functions.scoring import rounded
from confluo.operators import evaluate as ev
from confluo.operators import fuse
from confluo.operators.batch import best_entities
from confluo.operators.leaves import bag_of_words, words
from confluo.operators.present import result_table
from confluo.plans.search import search

QUERIES = {"a": [words("la the thble")], "b": [words("de", "name"), words("thanedble anea")], "c": [words("user system")]}
_ROWS = [("a", 0, "should", None, 1, "la"), ("a", 1, "should", None, 1, "thble"), ("b", 0, "should", "name", 40, "de"),
         ("b", 1, "should", None, 1, "thanedble"), ("b", 2, "should", None, 1, "anea"), ("c", 0, "should", None, 1, "user"),
         ("c", 1, "should", None, 1, "system")]

_FUSED = f"""{TERM_HITS}, {DOC_SUM},
ent AS (SELECT entity_id, count(DISTINCT source) AS n_sources FROM cat GROUP BY entity_id),
per AS (SELECT query_id, entity_id, source, max(score) AS score FROM doc GROUP BY ALL),
fused AS (SELECT query_id, entity_id, sum(score) / any_value(n_sources) AS total, any_value(n_sources) AS n_sources
  FROM per JOIN ent USING (entity_id) GROUP BY query_id, entity_id)"""


def _ranked(k: int) -> str:
    return f"""top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(total, 6) DESC, entity_id) AS rank
  FROM fused) WHERE rank <= {k})"""


_HITS = """ord(source, o) AS (VALUES ('docs', 0), ('pages', 1), ('conv', 2)),
pos AS (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY round(score, 6) DESC, id) AS place FROM doc),
th AS (SELECT t.query_id, t.rank, t.entity_id, t.total, c.source, c.id, o, coalesce(p.score, 0) AS score, p.place
  FROM top t JOIN cat c USING (entity_id) JOIN ord USING (source)
  LEFT JOIN pos p ON p.query_id = t.query_id AND p.source = c.source AND p.id = c.id),
lead AS (SELECT query_id, rank, first(o ORDER BY place, o) AS lo FROM th WHERE place IS NOT NULL GROUP BY ALL),
hits AS (SELECT th.*, row_number() OVER (PARTITION BY th.query_id, th.rank ORDER BY o <> lo, o) - 1 AS hit FROM th JOIN lead USING (query_id, rank))"""

_BASE = f"WITH {sql_search(TEXTS)}, {sql_words(_ROWS)}, {_FUSED}"


def _found(spark, sf):
    return hits_of(spark, sf, TEXTS, QUERIES)


def _directory(spark, sf):
    return tables_of(spark, sf, *TEXTS).entities()


@query(
    "fuse_sources",
    f"""{_BASE} SELECT query_id, entity_id, round(max(CASE WHEN source = 'docs' THEN score END), 6) AS score_0,
  round(max(CASE WHEN source = 'pages' THEN score END), 6) AS score_1, round(max(CASE WHEN source = 'conv' THEN score END), 6) AS score_2
FROM per GROUP BY query_id, entity_id""",
)
def fuse_sources(spark, sf):
    rows = fuse.fuse_sources(_found(spark, sf), TEXTS)
    return rows.select("query_id", "entity_id", *[rounded(F.col(f"score_{i}")).alias(f"score_{i}") for i in range(len(TEXTS))])


@query("fuse_average", f"{_BASE} SELECT query_id, entity_id, n_sources, round(total, 6) AS total_score FROM fused")
def fuse_average(spark, sf):
    rows = fuse.average(fuse.fuse_sources(_found(spark, sf), TEXTS), _directory(spark, sf), TEXTS)
    return rows.select(
        "query_id", "entity_id", F.col("n_sources").cast("long").alias("n_sources"), rounded(F.col("total_score")).alias("total_score")
    )


@query(
    "fuse_fill_missing",
    f"""{_BASE} SELECT t.query_id, t.entity_id, c.source, c.id, round(coalesce(d.score, 0), 6) AS score
FROM fused t JOIN cat c USING (entity_id) LEFT JOIN doc d ON d.query_id = t.query_id AND d.source = c.source AND d.id = c.id""",
)
def fuse_fill_missing(spark, sf):
    rows = fuse.fill_missing(fuse.fuse_sources(_found(spark, sf), TEXTS), _directory(spark, sf), TEXTS)
    return rows.withColumn("score", rounded(F.col("score")))


@query("fused_top_k", f"{_BASE}, {_ranked(5)} SELECT query_id, rank, entity_id, n_sources, round(total, 6) AS total_score FROM top")
def fused_top_k(spark, sf):
    top = fuse.fused_top_k(_found(spark, sf), _directory(spark, sf), TEXTS, 5)
    return top.select(
        "query_id",
        F.col("rank").cast("long").alias("rank"),
        "entity_id",
        F.col("n_sources").cast("long").alias("n_sources"),
        rounded(F.col("total_score")).alias("total_score"),
    )


@query(
    "fused_top_k_one_query",
    f"{_BASE} SELECT entity_id, round(total, 6) AS total_score FROM fused WHERE query_id = 'b' ORDER BY 2 DESC, 1 LIMIT 10",
)
def fused_top_k_one_query(spark, sf):
    found = hits_of(spark, sf, TEXTS, {"b": QUERIES["b"]})
    top = fuse.top_k_one_query(found, _directory(spark, sf), TEXTS, 10)
    return top.select("entity_id", rounded(F.col("total_score")).alias("total_score"))


@query(
    "fused_hits",
    f"""{_BASE}, {_ranked(5)}, {_HITS} SELECT query_id, rank, entity_id, round(any_value(total), 6) AS total_score,
  string_agg(source || ':' || id, '|' ORDER BY hit) AS hits FROM hits GROUP BY query_id, rank, entity_id""",
)
def fused_hits(spark, sf):
    rows = search(tables_of(spark, sf, *TEXTS), _query_table(spark))
    return rows.select(
        "query_id",
        F.col("rank").cast("long").alias("rank"),
        "entity_id",
        rounded(F.col("total_score")).alias("total_score"),
        F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["source"], h["id"])), "|").alias("hits"),
    )


def _query_table(spark):
    from confluo.operators.leaves import query_table

    return query_table(spark, QUERIES)


@query(
    "fused_batch",
    f"""WITH {sql_search(TEXTS)}, {SQL_BATCH}, {_FUSED}, {_ranked(5)}
SELECT query_id, rank, entity_id, round(total, 6) AS total_score FROM top""",
)
def fused_batch(spark, sf):
    top = best_entities(tables_of(spark, sf, *TEXTS), bag_of_words(passages(spark, sf)), 5)
    return top.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "entity_id", rounded(F.col("total_score")).alias("total_score")
    )


@query(
    "result_table",
    f"""{_BASE}, {_ranked(5)}, {_HITS} SELECT query_id, rank, h.entity_id, round(total, 6) AS total_score, CAST(hit AS INTEGER) AS pos, h.source, h.id,
  name, strftime(date, '%Y-%m-%d') AS date, array_to_string(genres, ',') AS genres, array_to_string(platforms, ',') AS platforms,
  array_to_string(devs, ',') AS devs, CASE WHEN length(summary) > 150 THEN substring(summary, 1, 150) || '...' ELSE summary END AS snippet
FROM hits h JOIN cat c ON c.source = h.source AND c.id = h.id""",
)
def result_rows(spark, sf):
    fused = search(tables_of(spark, sf, *TEXTS), _query_table(spark))
    rows = result_table(fused, catalogue(spark, sf, *TEXTS))
    return rows.withColumns(
        {
            "rank": F.col("rank").cast("long"),
            "total_score": rounded(F.col("total_score")),
            "date": F.date_format("date", "yyyy-MM-dd"),
        }
    )


# Evaluation -----------------------------------------------------------------------------------------------------------

METRICS = """ideal AS (SELECT query_id, relevance AS grade, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC) AS rank FROM qrels),
tot AS (SELECT query_id, count(*) FILTER (relevance >= 2) AS total FROM qrels GROUP BY query_id),
nat AS (SELECT query_id, rank, ordinal, total, ordinal / rank AS precision, ordinal / nullif(total, 0) AS recall FROM
  (SELECT *, count(*) FILTER (grade >= 2) OVER (PARTITION BY query_id ORDER BY rank) AS ordinal FROM graded) JOIN tot USING (query_id)
  WHERE grade >= 2),
interp AS (SELECT t.query_id, level, CASE WHEN total > 0 THEN coalesce((SELECT max(n.precision) FROM nat n
  WHERE n.query_id = t.query_id AND n.ordinal * 10 >= level * t.total), 0) END AS precision
  FROM tot t, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10]) AS level)),
ap AS (SELECT t.query_id, coalesce((SELECT sum(precision) FROM nat n WHERE n.query_id = t.query_id), 0) / nullif(total, 0) AS ap_raw,
  (SELECT avg(precision) FROM interp i WHERE i.query_id = t.query_id) AS ap_interpolated FROM tot t)"""
_QRELS = """qrels AS (SELECT d.lang AS query_id, 'docs' AS source, CAST(doc_id AS VARCHAR) AS id, 2 * quality + 1 - toxic AS relevance
  FROM labels JOIN documents d USING (doc_id))"""
_GRADED = f"""{_QRELS}, run AS (SELECT * FROM (SELECT lang AS query_id, CAST(doc_id AS VARCHAR) AS id,
  row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 10),
graded AS (SELECT query_id, rank, coalesce(relevance, 0) AS grade FROM run LEFT JOIN qrels USING (query_id, id)),
{METRICS}"""
_GAIN = "CASE WHEN rank = 1 THEN grade ELSE grade / log2(rank) END"


def qrels_of(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        F.col("lang").alias("query_id"),
        F.lit("docs").alias("source"),
        F.col("doc_id").cast("string").alias("id"),
        (2 * F.col("quality") + 1 - F.col("toxic")).cast("int").alias("relevance"),
    )


def graded_of(spark, sf):
    order = Window.partitionBy("lang").orderBy(F.col("n_chars").desc(), "doc_id")
    run = table(spark, sf, "documents").select(
        F.col("lang").alias("query_id"), F.lit("docs").alias("source"), F.col("doc_id").cast("string").alias("id"),
        F.row_number().over(order).alias("rank"),
    ).where("rank <= 10")
    return ev.grade_ranking(run, qrels_of(spark, sf))


_LANGS = {"en": [words("attion thanedble anea")], "fr": [words("la de")], "de": [words("der die")], "es": [words("el la")]}
_LANG_ROWS = [("en", 0, "should", None, 1, "attion"), ("en", 1, "should", None, 1, "thanedble"), ("en", 2, "should", None, 1, "anea"),
              ("fr", 0, "should", None, 1, "la"), ("fr", 1, "should", None, 1, "de"), ("de", 0, "should", None, 1, "der"),
              ("de", 1, "should", None, 1, "die"), ("es", 0, "should", None, 1, "el"), ("es", 1, "should", None, 1, "la")]


@query(
    "eval_join",
    f"""WITH {sql_search(TEXTS)}, {sql_words(_LANG_ROWS)}, {_FUSED}, {_ranked(10)}, {_HITS}, {_QRELS}
SELECT h.query_id, rank, CAST(coalesce(first(relevance ORDER BY hit) FILTER (relevance IS NOT NULL), 0) AS INTEGER) AS grade
FROM hits h LEFT JOIN qrels q ON q.query_id = h.query_id AND q.source = h.source AND q.id = h.id GROUP BY h.query_id, rank""",
)
def eval_join(spark, sf):
    from confluo.operators.leaves import query_table

    fused = search(tables_of(spark, sf, *TEXTS), query_table(spark, _LANGS), 10)
    rows = ev.grade_fused(fused, qrels_of(spark, sf))
    return rows.withColumn("rank", F.col("rank").cast("long"))


@query("eval_dcg", f"WITH {_GRADED} SELECT query_id, round(sum({_GAIN}), 6) AS dcg FROM graded GROUP BY query_id")
def eval_dcg(spark, sf):
    return ev.dcg(graded_of(spark, sf)).withColumn("dcg", F.round("dcg", 6))


@query(
    "eval_ndcg",
    f"""WITH {_GRADED} SELECT query_id, round(dcg, 6) AS dcg, round(ideal_dcg, 6) AS ideal_dcg, round(dcg / ideal_dcg, 6) AS ndcg FROM
(SELECT query_id, sum({_GAIN}) AS dcg FROM graded GROUP BY query_id) JOIN
(SELECT query_id, sum({_GAIN}) AS ideal_dcg FROM ideal GROUP BY query_id) USING (query_id)""",
)
def eval_ndcg(spark, sf):
    rows = ev.ndcg(graded_of(spark, sf), qrels_of(spark, sf), block=16)
    return rows.select("query_id", *[F.round(c, 6).alias(c) for c in ("dcg", "ideal_dcg", "ndcg")])


@query(
    "eval_precision",
    f"WITH {_GRADED} SELECT query_id, rank, ordinal, total, round(precision, 6) AS precision, round(recall, 6) AS recall FROM nat",
)
def eval_precision(spark, sf):
    rows = ev.natural_precision(graded_of(spark, sf), qrels_of(spark, sf))
    return rows.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "ordinal", "total",
        F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"),
    )


@query("eval_interpolated", f"WITH {_GRADED} SELECT query_id, level, round(precision, 6) AS precision FROM interp")
def eval_interpolated(spark, sf):
    rows = ev.interpolated_precision(graded_of(spark, sf), qrels_of(spark, sf))
    return rows.withColumn("precision", F.round("precision", 6))


@query(
    "eval_avg_precision",
    f"WITH {_GRADED} SELECT query_id, round(ap_raw, 6) AS ap_raw, round(ap_interpolated, 6) AS ap_interpolated FROM ap",
)
def eval_avg_precision(spark, sf):
    rows = ev.average_precision(graded_of(spark, sf), qrels_of(spark, sf))
    return rows.select("query_id", F.round("ap_raw", 6).alias("ap_raw"), F.round("ap_interpolated", 6).alias("ap_interpolated"))


@query(
    "eval_map",
    f"WITH {_GRADED} SELECT round(avg(ap_interpolated), 6) AS map_interpolated, round(avg(ap_raw), 6) AS map_raw FROM ap",
)
def eval_map(spark, sf):
    rows = ev.mean_average_precision(graded_of(spark, sf), qrels_of(spark, sf))
    return rows.select(F.round("map_interpolated", 6).alias("map_interpolated"), F.round("map_raw", 6).alias("map_raw"))


@query("eval_level_means", f"WITH {_GRADED} SELECT level, round(avg(precision), 6) AS mean_precision FROM interp GROUP BY level")
def eval_level_means(spark, sf):
    rows = ev.level_means(graded_of(spark, sf), qrels_of(spark, sf))
    return rows.withColumn("mean_precision", F.round("mean_precision", 6))
