"""Stored tables, dumps, streaming, query texts and evaluation from a suite."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fusion import _BASE, _FUSED, _HITS, _LANG_ROWS, METRICS, _ranked, qrels_of
from checks.records import catalogue
from checks.registry import DOC_SUM, TERM_HITS, query, sql_search, sql_words
from checks.resolution import _RIGHT, _sql_assign, _sql_edges, _sql_ids, _sql_part, sides
from checks.search import SQL_BATCH, TEXTS, hits_of, passages, shown, tables_of
from checks.views import table
from confluo.functions.scoring import rounded
from confluo.operators import fuse
from confluo.operators import resolve as R
from confluo.operators import tables as tb
from confluo.operators.batch import best_entities
from confluo.operators.leaves import bag_of_words, date_in, date_range, query_table
from confluo.operators.retrieve import retrieve
from confluo.operators.texts import query_texts, text_leaves
from confluo.operators.trees import query_trees, text_errors
from confluo.plans.search import evaluate_suite, search, search_ranked
from confluo.session import step_path
from confluo.sources.dumps import append_dump, in_files, read_dump, write_dump
from confluo.sources.judgements import parse_suite
from confluo.sources.store import StoredTables, materialise
from confluo.streaming.ingest import ingest, read_ingested


def stored(spark, sf, **layout) -> StoredTables:
    root, rows = step_path(spark, "store"), catalogue(spark, sf, *TEXTS)
    for name in TEXTS:
        materialise(rows, root, name, **layout)
    return StoredTables(spark, root, TEXTS)


def _top(top):
    return top.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "entity_id", rounded(F.col("total_score")).alias("total_score")
    )


_TOP = "SELECT query_id, rank, entity_id, round(total, 6) AS total_score FROM top"


@query("store_search", f"{_BASE}, {_ranked(5)} {_TOP}")
def store_search(spark, sf):
    from checks.fusion import QUERIES

    return _top(search(stored(spark, sf), query_table(spark, QUERIES)))


@query("store_bucketed_search", f"{_BASE}, {_ranked(5)} {_TOP}")
def store_bucketed_search(spark, sf):
    """Postings lie in many folders, of which the words of the queries ask for a few."""
    from checks.fusion import QUERIES

    return _top(search(stored(spark, sf, bucket_postings=4000), query_table(spark, QUERIES)))


# A frequent word beside a rare one, and passages: most blocks of the frequent words cannot matter.
_BOUNDED = {"a": "la thanedble", "b": "the der anea thble", "c": "de", "d": "user user system"}
_BOUNDED_ROWS = [(q, i, "should", None, 1, t) for q, text in _BOUNDED.items() for i, t in enumerate(text.split()) if t != "the"]


@query("store_ranked_search", f"WITH {sql_search(TEXTS)}, {sql_words(_BOUNDED_ROWS)}, {_FUSED}, {_ranked(5)} {_TOP}")
def store_ranked_search(spark, sf):
    from confluo.operators.leaves import words

    return _top(search_ranked(stored(spark, sf), query_table(spark, {q: [words(text)] for q, text in _BOUNDED.items()})))


@query("store_ranked_batch", f"WITH {sql_search(TEXTS)}, {SQL_BATCH}, {_FUSED}, {_ranked(5)} {_TOP}")
def store_ranked_batch(spark, sf):
    return _top(search_ranked(stored(spark, sf), bag_of_words(passages(spark, sf))))


@query("store_batch", f"WITH {sql_search(TEXTS)}, {SQL_BATCH}, {_FUSED}, {_ranked(5)} {_TOP}")
def store_batch(spark, sf):
    return _top(best_entities(stored(spark, sf), bag_of_words(passages(spark, sf)), 5))


# Documents no resolution has seen yet stand for themselves.
_UNSEEN = sql_search(TEXTS).replace("cat AS (", "cat0 AS (", 1).replace(
    "tok AS (",
    "cat AS (SELECT * REPLACE (CASE WHEN list_contains(genres, 'fr') THEN sha256(source || ':' || id) ELSE entity_id END AS entity_id) FROM cat0),\ntok AS (",
    1,
)
_UNSEEN_ROWS = [("a", 0, "should", None, 1, "la"), ("a", 1, "should", None, 1, "thble")]


@query("search_unresolved", f"WITH {_UNSEEN}, {sql_words(_UNSEEN_ROWS)}, {_FUSED}, {_ranked(20)} {_TOP}")
def search_unresolved(spark, sf):
    from confluo.operators.leaves import words

    rows = catalogue(spark, sf, *TEXTS)
    rows = rows.withColumn("entity_id", F.when(~F.array_contains("genres", "fr"), F.col("entity_id")))
    tables = tb.CatalogueTables(rows, TEXTS)
    found = retrieve(tables, query_table(spark, {"a": [words("la thble")]}))
    return _top(fuse.fused_top_k(found, tables.entities(), TEXTS, 20))


@query(
    "date_bounds",
    """WITH r(query_id, lo, hi) AS (VALUES ('year', TIMESTAMP '1996-01-01', TIMESTAMP '1997-01-01'),
  ('month', TIMESTAMP '1996-05-01', TIMESTAMP '1996-06-01'), ('digit', TIMESTAMP '1996-05-01', TIMESTAMP '1996-06-11'),
  ('day', TIMESTAMP '1996-05-09', TIMESTAMP '1996-05-10'), ('from', TIMESTAMP '1998-07-01', TIMESTAMP '9999-01-01'),
  ('to', TIMESTAMP '0001-01-01', TIMESTAMP '1992-02-02'), ('none', TIMESTAMP '0001-01-01', TIMESTAMP '9999-01-01'))
SELECT query_id, CAST(o_orderkey AS VARCHAR) AS id FROM orders JOIN r ON o_orderdate >= lo AND o_orderdate < hi""",
)
def date_bounds(spark, sf):
    queries = {
        "year": [date_in("1996")], "month": [date_range("199605", "1996-5")], "digit": [date_range("1996-5", "1996-6-10")],
        "day": [date_in("1996-5-9")], "from": [date_range("1998-07", None)], "to": [date_range(None, "19920201")], "none": [date_range(None, None)],
    }
    return hits_of(spark, sf, ["orders"], queries).select("query_id", "id")


# Dumps and streaming ---------------------------------------------------------------------------------------------------


@query(
    "dump_round_trip",
    """SELECT doc_id, md5(text) AS text_hash, lang, n_chars FROM documents
UNION ALL SELECT page_id, md5(html), NULL, CAST(length(html) AS BIGINT) FROM pages""",
)
def dump_round_trip(spark, sf):
    path = step_path(spark, "dump")
    schema = "doc_id long, text string, lang string, n_chars long"
    write_dump(table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars"), path)
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("html").alias("text"), F.lit(None).cast("string").alias("lang"), F.length("html").cast("long").alias("n_chars")
    )
    append_dump(pages, path)
    rows = read_dump(spark, path, spark.createDataFrame([], schema).schema)
    return rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_hash"), "lang", "n_chars")


@query(
    "stream_ingest",
    """SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS text_hash FROM documents
UNION ALL SELECT 'conv-' || conv_id || '-' || turn, md5(text) FROM conversations""",
)
def stream_ingest(spark, sf):
    """Documents arrive in several files; what arrives later under their keys is dropped, the turns that come with it are new."""
    base = step_path(spark, "stream")
    schema = spark.createDataFrame([], "id string, text string").schema
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    turns = table(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text"
    )
    write_dump(in_files(docs, "id", least=4), f"{base}/in", "append")
    ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", schema, "id").awaitTermination()
    append_dump(in_files(docs.withColumn("text", F.lit("late")).unionByName(turns), "id", least=4), f"{base}/in")
    ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", schema, "id").awaitTermination()
    return read_ingested(spark, f"{base}/out", schema).select("id", F.md5(F.col("text").cast("binary")).alias("text_hash"))


# Resolution with names that have no terms ------------------------------------------------------------------------------

_NO_NAME = f"SELECT * REPLACE (CASE WHEN list_contains(genres, 'de') THEN '...' ELSE name END AS name) FROM ({_sql_part('left', False)})"


@query(
    "er_no_terms",
    f"""WITH RECURSIVE {_sql_edges("", _NO_NAME, _RIGHT)}, {_sql_assign("")}
SELECT source, id, entity_id, reused FROM ({_sql_ids("", _NO_NAME)})""",
)
def er_no_terms(spark, sf):
    left, right = sides(spark, sf)
    left = left.withColumn("name", F.when(F.array_contains("genres", "de"), "...").otherwise(F.col("name")))
    matches = R.assign_one_to_one(R.candidate_edges(left, right, ["right"], for_matching=True))
    return R.with_entity_ids(left, matches).select("source", "id", "entity_id", "reused")


# Query texts -----------------------------------------------------------------------------------------------------------

_WORDS = "regexp_extract_all(lower(text), '[a-z]+')"


@query(
    "query_text_leaves",
    f"""WITH w AS (SELECT CAST(item_id AS VARCHAR) AS query_id, {_WORDS} AS w FROM benchmark),
l AS (SELECT query_id, 0 AS clause, true AS grouped, 'must' AS role, 'words' AS op, 'summary' AS field, w[1] AS value, NULL AS lo, NULL AS hi, 1 AS slop, 3.0 AS boost FROM w
UNION ALL SELECT query_id, 0, true, 'must', 'wildcard', 'summary', w[2] || '*', NULL, NULL, 1, 3.0 FROM w
UNION ALL SELECT query_id, 2, false, 'must', 'phrase', NULL, w[3] || ' ' || w[4], NULL, NULL, 4, 1.0 FROM w
UNION ALL SELECT query_id, 3, false, 'should', 'date', 'date', NULL, '2013', '20160510', 1, 2.0 FROM w
UNION ALL SELECT query_id, 4, false, 'should', 'keyword', 'platforms', 'src' || query_id, NULL, NULL, 1, 1.0 FROM w
UNION ALL SELECT query_id, 6, false, 'must_not', 'words', 'name', w[5], NULL, NULL, 1, 1.0 FROM w
UNION ALL SELECT query_id, 7, false, 'should', 'date', 'date', NULL, '2016', '2016', 1, 1.0 FROM w)
SELECT query_id, CAST(clause AS INTEGER) AS clause, grouped, role, op, field, value, lo, hi, CAST(slop AS INTEGER) AS slop, CAST(boost AS DOUBLE) AS boost FROM l""",
)
def query_text_leaves(spark, sf):
    w = table(spark, sf, "benchmark").select("item_id", F.expr("regexp_extract_all(lower(text), '[a-z]+', 0)").alias("w"))
    text = F.format_string(
        'summary:(%s %s*)^3 AND "%s %s"~4 date:[2013 TO 20160510]^2 platforms:src%d NOT name:%s date:2016',
        F.get("w", F.lit(0)), F.get("w", F.lit(1)), F.get("w", F.lit(2)), F.get("w", F.lit(3)), "item_id", F.get("w", F.lit(4)),
    )
    return text_leaves(w.select(F.col("item_id").alias("query_id"), text.alias("text")))


_TEXT_ROWS = [("a", 0, "should", "summary", 1, "thble"), ("a", 1, "should", "summary", 1, "erin"), ("a", 2, "should", None, 2, "thanedble"),
              ("b", 0, "should", "name", 40, "la"), ("b", 1, "should", None, 1, "was")]


@query(
    "search_query_texts",
    f"WITH {sql_search(TEXTS)}, {sql_words(_TEXT_ROWS)}, {TERM_HITS}, {DOC_SUM} SELECT query_id, source, id, round(score, 6) AS score FROM doc",
)
def search_query_texts(spark, sf):
    texts = spark.createDataFrame([("a", "summary:(thble the erin) thanedble^2"), ("b", "name:la OR was 1")], "query_id string, text string")
    return shown(retrieve(tables_of(spark, sf, *TEXTS), query_texts(texts)))


# Groups inside groups; the SQL says in full what each of them means.
_TREES = {
    "a": "(thble AND erin) OR thanedble",
    "b": "summary:(thble AND (erin OR (thnt AND (der OR anea)^3)^2)) NOT name:was",
    "c": "name:(la AND de)^2 OR summary:(la ANDMAYBE name:der)",
    "d": "summary:(erin REQUIRE thble) ANDNOT (name:la OR name:de)",
    "e": "(thble AND erin",
}
_TREE_WORDS = [("a", 0, None, 1, "thble"), ("a", 1, None, 1, "erin"), ("a", 2, None, 1, "thanedble"), ("b", 0, "summary", 1, "thble"),
               ("b", 1, "summary", 1, "erin"), ("b", 2, "summary", 2, "thnt"), ("b", 3, "summary", 6, "der"), ("b", 4, "summary", 6, "anea"),
               ("b", 5, "name", 40, "was"), ("c", 0, "name", 80, "la"), ("c", 1, "name", 80, "de"), ("c", 2, "summary", 1, "la"),
               ("c", 3, "name", 40, "der"), ("d", 0, "summary", 1, "erin"), ("d", 1, "summary", 1, "thble"), ("d", 2, "name", 40, "la"),
               ("d", 3, "name", 40, "de")]
_TREE_ROWS = [(q, c, "should", f, b, t) for q, c, f, b, t in _TREE_WORDS]


@query(
    "nested_groups",
    f"""WITH {sql_search(TEXTS)}, {sql_words(_TREE_ROWS)}, {TERM_HITS},
p AS (SELECT query_id, source, id, {", ".join(f"sum(score) FILTER (clause = {i}) AS s{i}" for i in range(6))} FROM hit GROUP BY ALL),
g3 AS (SELECT *, CASE WHEN s3 IS NOT NULL OR s4 IS NOT NULL THEN coalesce(s3, 0) + coalesce(s4, 0) END AS v3 FROM p),
g1 AS (SELECT *, CASE WHEN s1 IS NOT NULL OR s2 + v3 IS NOT NULL THEN coalesce(s1, 0) + coalesce(s2 + v3, 0) END AS v1 FROM g3),
v AS (SELECT query_id, source, id, CASE query_id
  WHEN 'a' THEN CASE WHEN s0 + s1 IS NOT NULL OR s2 IS NOT NULL THEN coalesce(s0 + s1, 0) + coalesce(s2, 0) END
  WHEN 'b' THEN CASE WHEN s5 IS NULL THEN s0 + v1 END
  WHEN 'c' THEN CASE WHEN s0 + s1 IS NOT NULL OR s2 IS NOT NULL THEN coalesce(s0 + s1, 0) + coalesce(s2 + coalesce(s3, 0), 0) END
  ELSE CASE WHEN s1 IS NOT NULL AND s2 IS NULL AND s3 IS NULL THEN s0 END END AS score FROM g1)
SELECT query_id, source, id, round(score, 6) AS score FROM v WHERE score IS NOT NULL""",
)
def nested_groups(spark, sf):
    texts = spark.createDataFrame(list(_TREES.items()), "query_id string, text string")
    return shown(retrieve(tables_of(spark, sf, *TEXTS), query_trees(texts)))


_BAD = {1: ('"%s', "a quote has no partner"), 2: ("%s (name:x", "a parenthesis has no partner"), 3: ("date:[2013]", "a range needs two ends"),
        4: ("%s {2005 TO 2010}", "a range stands in braces"), 5: ("date:2016-13 %s", "no year, month or day"), 6: ("name:[a to b]", "only dates have ranges")}


@query(
    "query_text_errors",
    f"""SELECT CAST(item_id AS VARCHAR) AS query_id, CASE item_id % 9 {" ".join(f"WHEN {i} THEN '{e}'" for i, (_, e) in _BAD.items())} END AS error
FROM benchmark WHERE item_id % 9 BETWEEN 1 AND 6""",
)
def query_text_errors(spark, sf):
    items = table(spark, sf, "benchmark").select("item_id", F.regexp_extract("text", "[A-Za-z]+", 0).alias("w"))
    text = F.concat_ws(": ", F.lit("half-life 2"), "w")
    for i, (form, _) in _BAD.items():
        text = F.when(F.col("item_id") % 9 == i, F.replace(F.lit(form), F.lit("%s"), F.col("w"))).otherwise(text)
    return text_errors(items.select(F.col("item_id").alias("query_id"), text.alias("text"))).select("query_id", "error")


# Evaluation from a suite -----------------------------------------------------------------------------------------------

_SUITE_QUERIES = (("de", "der die"), ("en", "attion thanedble anea"), ("es", "el la"), ("fr", "la de"))
_NUMBERS = ", ".join(f"('{lang}', {i})" for i, (lang, _) in enumerate(_SUITE_QUERIES, 1))


@query(
    "evaluate_suite",
    f"""WITH {sql_search(TEXTS)}, {sql_words(_LANG_ROWS)}, {_FUSED}, {_ranked(10)}, {_HITS},
qrels AS (SELECT d.lang AS query_id, 'docs' AS source, CAST(doc_id AS VARCHAR) AS id, 2 * quality + 1 - toxic AS relevance
  FROM labels JOIN documents d USING (doc_id)),
graded AS (SELECT h.query_id, rank, coalesce(first(relevance ORDER BY hit) FILTER (relevance IS NOT NULL), 0) AS grade
  FROM hits h LEFT JOIN qrels q ON q.query_id = h.query_id AND q.source = h.source AND q.id = h.id GROUP BY h.query_id, rank),
{METRICS}, num(query_id, n) AS (VALUES {_NUMBERS}),
every AS (SELECT CAST(n AS VARCHAR) AS query_id, dcg / ideal_dcg AS ndcg, ap_raw, ap_interpolated FROM num JOIN
  (SELECT query_id, sum(CASE WHEN rank = 1 THEN grade ELSE grade / log2(rank) END) AS dcg FROM graded GROUP BY query_id) USING (query_id) JOIN
  (SELECT query_id, sum(CASE WHEN rank = 1 THEN grade ELSE grade / log2(rank) END) AS ideal_dcg FROM ideal GROUP BY query_id) USING (query_id)
  JOIN ap USING (query_id))
SELECT query_id, round(ndcg, 6) AS ndcg, round(ap_raw, 6) AS ap_raw, round(ap_interpolated, 6) AS ap_interpolated FROM every
UNION ALL SELECT 'mean', NULL, round(avg(ap_raw), 6), round(avg(ap_interpolated), 6) FROM every""",
)
def evaluate_from_suite(spark, sf):
    """One suite per language, written as text lines, read, searched in stored tables and judged."""
    number = F.element_at(F.create_map(*[F.lit(x) for i, (lang, _) in enumerate(_SUITE_QUERIES) for x in (lang, i)]), F.col("query_id"))
    entries = qrels_of(spark, sf).select(
        F.concat(F.lit("suite"), number.cast("string")).alias("suite"), F.lit(1).cast("long").alias("block"), F.col("id").cast("long").alias("pos"),
        F.concat_ws(" ", F.col("relevance").cast("string"), "source", "id").alias("line"),
    )
    headers = [(f"suite{i}", 0, 0, f"query {text}  # {lang}") for i, (lang, text) in enumerate(_SUITE_QUERIES)]
    lines = entries.unionByName(spark.createDataFrame(headers, "suite string, block long, pos long, line string"))
    figures = evaluate_suite(stored(spark, sf), *parse_suite(lines))
    rows = figures["ndcg"].join(figures["average"], "query_id").select("query_id", "ndcg", "ap_raw", "ap_interpolated")
    mean = figures["map"].select(
        F.lit("mean").alias("query_id"), F.lit(None).cast("double").alias("ndcg"), F.col("map_raw").alias("ap_raw"), F.col("map_interpolated").alias("ap_interpolated")
    )
    return rows.unionByName(mean).select("query_id", *[F.round(c, 6).alias(c) for c in ("ndcg", "ap_raw", "ap_interpolated")])
