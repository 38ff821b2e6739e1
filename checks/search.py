"""Search tables, predicates and ranked retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.records import catalogue
from checks.registry import DOC_SUM, TERM_HITS, query, sql_analysed, sql_search, sql_top, sql_words
from checks.views import sql_catalogue, table
from confluo.functions.scoring import rounded
from confluo.operators import retrieve as R
from confluo.operators import tables as tb
from confluo.operators.batch import best_documents
from confluo.operators.leaves import any_of, bag_of_words, date_in, date_range, keyword, phrase, query_table, wildcard, words

TEXTS = ["docs", "pages", "conv"]


def tables_of(spark, sf, *names):
    return tb.CatalogueTables(catalogue(spark, sf, *names), list(names))


def hits_of(spark, sf, names, queries):
    return R.retrieve(tables_of(spark, sf, *names), query_table(spark, queries))


def shown(hits):
    return hits.select("query_id", "source", "id", rounded(F.col("score")).alias("score"))


SHOWN = "SELECT query_id, source, id, round(score, 6) AS score FROM doc"


@query(
    "build_postings",
    f"""WITH {sql_search(TEXTS)} SELECT source, field, term, id, CAST(len AS INTEGER) AS len, CAST(tf AS INTEGER) AS tf,
  CAST(first_pos AS INTEGER) AS first_pos, CAST(last_pos AS INTEGER) AS last_pos, CAST(sum_pos AS BIGINT) AS sum_pos FROM post""",
)
def build_postings(spark, sf):
    return tables_of(spark, sf, *TEXTS).postings().select(
        "source",
        "field",
        "term",
        "id",
        "len",
        "tf",
        F.array_min("positions").alias("first_pos"),
        F.array_max("positions").alias("last_pos"),
        F.aggregate("positions", F.lit(0).cast("long"), lambda acc, p: acc + p).alias("sum_pos"),
    )


@query(
    "field_lengths",
    f"WITH {sql_search(TEXTS)} SELECT source, field, n_docs, total_len, round(avg_len, 6) AS avg_len FROM fst",
)
def field_lengths(spark, sf):
    stats = tb.field_stats(tables_of(spark, sf, *TEXTS).stats())
    return stats.withColumn("avg_len", F.round("avg_len", 6))


@query(
    "document_lengths",
    f"WITH {sql_search(TEXTS)} SELECT source, field, id, CAST(len AS INTEGER) AS len FROM tok",
)
def document_lengths(spark, sf):
    return tb.token_rows(catalogue(spark, sf, *TEXTS)).select("source", "field", "id", "len")


@query("term_stats", f"WITH {sql_search(TEXTS)} SELECT source, field, term, df FROM dfs")
def term_stats(spark, sf):
    return tb.term_stats(tables_of(spark, sf, *TEXTS).stats())


@query(
    "fetch_stored",
    f"""WITH {sql_search(TEXTS)}, {sql_words([("q", 0, "should", "name", 1, "thanedble")])}, {TERM_HITS}, {DOC_SUM}
SELECT d.source, d.id, name, array_to_string(genres, ',') AS genres, popularity FROM doc d JOIN cat c ON c.source = d.source AND c.id = d.id""",
)
def fetch_stored(spark, sf):
    hits = hits_of(spark, sf, TEXTS, {"q": [words("thanedble", "name", boost=1 / 40)]})
    rows = tb.fetch_stored(hits.select("source", "id"), catalogue(spark, sf, *TEXTS), ["name", "genres", "popularity"])
    return rows.withColumn("genres", F.array_join("genres", ","))


@query(
    "term_match",
    f"WITH {sql_search(['docs'])} SELECT source, id, field FROM post WHERE term = 'thanedble'",
)
def term_match(spark, sf):
    terms = spark.sql("SELECT f AS field, 'thanedble' AS term FROM VALUES ('name'), ('storyline'), ('summary') AS v(f)")
    postings, _ = tables_of(spark, sf, "docs").lookup(["name", "storyline", "summary"], terms, positions=False)
    return postings.select("source", "id", "field")


_BM25 = [("q", i, "should", "summary", 1, t) for i, t in enumerate("thble erin thnt der thanedble 2".split())]


@query("bm25_top", f"WITH {sql_search(['docs'], ('summary',))}, {sql_words(_BM25)}, {TERM_HITS}, {DOC_SUM} {sql_top(10)}")
def bm25_top(spark, sf):
    hits = hits_of(spark, sf, ["docs"], {"q": [words("thble the erin thnt der thanedble 2", "summary")]})
    return R.top_k(hits, 10).select("query_id", F.col("rank").cast("long").alias("rank"), "source", "id", rounded(F.col("score")).alias("score"))


_OR = [("a", 0, "should", "summary", 1, "thble"), ("a", 1, "should", "summary", 1, "erin"), ("b", 0, "should", "name", 40, "de"),
       ("b", 1, "should", "name", 40, "der")]


@query("or_query", f"WITH {sql_search(TEXTS)}, {sql_words(_OR)}, {TERM_HITS}, {DOC_SUM} {SHOWN}")
def or_query(spark, sf):
    return shown(hits_of(spark, sf, TEXTS, {"a": [words("thble erin", "summary")], "b": [words("de der", "name")]}))


def _boolean(rows: list[tuple], need: dict[str, int], sources=TEXTS, extra_hits: str = "") -> str:
    needs = ", ".join(f"('{q}', {n})" for q, n in need.items())
    return f"""WITH {sql_search(sources)}, {sql_words(rows)}, need(query_id, n) AS (VALUES {needs}),
hit AS (SELECT a.query_id, a.clause, a.role, b.source, b.id, b.entity_id, a.weight * b.bm AS score FROM atom a JOIN bm b USING (field, term)
{extra_hits}),
mem AS (SELECT query_id, source, id, entity_id, sum(CASE WHEN role IN ('should', 'must', 'maybe') THEN score ELSE 0 END) AS score,
  count(DISTINCT CASE WHEN role IN ('must', 'filter') THEN clause END) AS met, bool_or(role = 'must_not') AS ex,
  bool_or(role = 'should') AS want FROM hit GROUP BY query_id, source, id, entity_id),
doc AS (SELECT mem.* FROM mem JOIN need USING (query_id) WHERE met = n AND NOT ex AND (n > 0 OR want)) {SHOWN}"""


@query(
    "and_query",
    _boolean(
        [("a", 0, "must", None, 1, "thble"), ("a", 1, "must", None, 1, "erin"), ("a", 2, "must", None, 1, "thnt"),
         ("b", 0, "must", "name", 40, "la"), ("b", 1, "must", "name", 40, "de")],
        {"a": 3, "b": 2},
    ),
)
def and_query(spark, sf):
    return shown(
        hits_of(spark, sf, TEXTS, {"a": [words("thble the erin thnt", role="must")], "b": [words("la de", "name", role="must")]})
    )


@query(
    "and_of_ors",
    _boolean(
        [("a", 0, "must", "summary", 1, "thble"), ("a", 0, "must", "name", 40, "erin"), ("a", 1, "must", "summary", 1, "thnt"),
         ("a", 1, "must", "summary", 1, "der")],
        {"a": 2},
    ),
)
def and_of_ors(spark, sf):
    clauses = [any_of(words("thble", "summary"), words("erin", "name")), any_of(words("thnt der", "summary"))]
    return shown(hits_of(spark, sf, TEXTS, {"a": clauses}))


@query(
    "and_maybe_query",
    _boolean(
        [("a", 0, "must", "summary", 1, "thble"), ("a", 1, "maybe", "summary", 1, "erin"), ("a", 2, "maybe", "name", 40, "thanedble")],
        {"a": 1},
    ),
)
def and_maybe_query(spark, sf):
    leaves = [words("thble", "summary", role="must"), words("erin", "summary", role="maybe"), words("thanedble", "name", role="maybe")]
    return shown(hits_of(spark, sf, TEXTS, {"a": leaves}))


@query(
    "not_query",
    _boolean([("a", 0, "should", None, 1, "thble"), ("a", 1, "must_not", "summary", 1, "erin")], {"a": 0}),
)
def not_query(spark, sf):
    return shown(hits_of(spark, sf, TEXTS, {"a": [words("thble"), words("erin", "summary", role="must_not")]}))


@query(
    "require_query",
    _boolean([("a", 0, "should", None, 1, "thble"), ("a", 1, "filter", "summary", 1, "erin")], {"a": 1}),
)
def require_query(spark, sf):
    return shown(hits_of(spark, sf, TEXTS, {"a": [words("thble"), words("erin", "summary", role="filter")]}))


_MULTI = [("q", i, "should", None, 1, t) for i, t in enumerate("user thanedble x".split())]


@query("multifield_query", f"WITH {sql_search(TEXTS)}, {sql_words(_MULTI)}, {TERM_HITS}, {DOC_SUM} {SHOWN}")
def multifield_query(spark, sf):
    return shown(hits_of(spark, sf, TEXTS, {"q": [words("user the thanedble x")]}))


_SCOPED = [("a", 0, "should", "name", 40, "attion"), ("a", 1, "should", "name", 40, "la"), ("b", 0, "should", "summary", 1, "anea"),
           ("c", 0, "should", "storyline", 1, "system")]


@query("field_scoped_query", f"WITH {sql_search(TEXTS)}, {sql_words(_SCOPED)}, {TERM_HITS}, {DOC_SUM} {SHOWN}")
def field_scoped_query(spark, sf):
    queries = {"a": [words("attion la", "name")], "b": [words("anea", "summary")], "c": [words("system", "storyline")]}
    return shown(hits_of(spark, sf, TEXTS, queries))


_BOOSTED = [("a", 0, "should", None, 1, "la"), ("a", 1, "should", "name", 40, "attion"), ("a", 2, "should", "name", 80, "de"),
            ("a", 3, "should", "summary", 3, "anea")]


@query("boosted_query", f"WITH {sql_search(TEXTS)}, {sql_words(_BOOSTED)}, {TERM_HITS}, {DOC_SUM} {SHOWN}")
def boosted_query(spark, sf):
    leaves = [words("la"), words("attion", "name"), words("de", "name", boost=2), words("anea", "summary", boost=3)]
    return shown(hits_of(spark, sf, TEXTS, {"a": leaves}))


def _phrase_sql(terms: list[str], slop: int, q: str) -> str:
    joins = "".join(
        f" JOIN occ o{i} ON o{i}.source = o0.source AND o{i}.id = o0.id AND o{i}.field = o0.field AND o{i}.term = '{t}'"
        f" AND o{i}.pos - o{i - 1}.pos BETWEEN 1 AND {slop}"
        for i, t in enumerate(terms)
        if i
    )
    total = " + ".join(f"b{i}.bm" for i in range(len(terms)))
    scores = "".join(
        f" JOIN bm b{i} ON b{i}.source = m.source AND b{i}.id = m.id AND b{i}.field = m.field AND b{i}.term = '{t}'"
        for i, t in enumerate(terms)
    )
    return f"""SELECT '{q}' AS query_id, m.source, m.id, w * ({total}) AS score FROM
  (SELECT DISTINCT o0.source, o0.id, o0.field FROM occ o0{joins} WHERE o0.term = '{terms[0]}') m
  JOIN (VALUES ('name', 6.0), ('storyline', 1.0), ('summary', 1.0)) v(field, w) ON v.field = m.field{scores}"""


def _phrases(*parts: str) -> str:
    union = "\nUNION ALL\n".join(parts)
    return f"WITH {sql_search(TEXTS)}, doc AS (SELECT query_id, source, id, sum(score) AS score FROM ({union}) GROUP BY ALL) {SHOWN}"


@query(
    "phrase_query",
    _phrases(_phrase_sql(["attion", "thanedble", "anea"], 1, "a"), _phrase_sql(["la", "de"], 1, "b"), _phrase_sql(["der", "die", "der"], 1, "c")),
)
def phrase_query(spark, sf):
    queries = {"a": [phrase("attion the thanedble anea")], "b": [phrase("la de")], "c": [phrase("der die der")]}
    return shown(hits_of(spark, sf, TEXTS, queries))


@query("proximity_query", _phrases(_phrase_sql(["attion", "eriner"], 4, "a"), _phrase_sql(["la", "que", "de"], 3, "b")))
def proximity_query(spark, sf):
    return shown(hits_of(spark, sf, TEXTS, {"a": [phrase("attion eriner", slop=4)], "b": [phrase("la que de", slop=3)]}))


@query(
    "wildcard_query",
    f"""WITH {sql_search(["docs", "parts"])},
d AS (SELECT DISTINCT 'a' AS query_id, 0 AS clause, source, id, field FROM post WHERE field IN ('name', 'storyline', 'summary') AND term LIKE 'sma%'
  UNION ALL SELECT DISTINCT 'b', 0, source, id, field FROM post WHERE field = 'name' AND term LIKE '%d%e_'
  UNION ALL SELECT DISTINCT 'c', 0, source, id, field FROM post WHERE term LIKE 'thn_' ),
wc AS (SELECT query_id, source, id, CASE WHEN query_id = 'b' THEN 40 WHEN field = 'name' THEN 6 ELSE 1 END AS score FROM d),
doc AS (SELECT query_id, source, id, CAST(sum(score) AS DOUBLE) AS score FROM wc GROUP BY ALL) {SHOWN}""",
)
def wildcard_query(spark, sf):
    queries = {"a": [wildcard("Sma*")], "b": [wildcard("*d*e?", "name")], "c": [wildcard("thn?")]}
    return shown(hits_of(spark, sf, ["docs", "parts"], queries))


@query(
    "wildcard_infix",
    f"""WITH {sql_search(["docs", "parts"])},
d AS (SELECT DISTINCT 'a' AS query_id, source, id, field FROM post WHERE term LIKE '%ra%e'
  UNION ALL SELECT DISTINCT 'b', source, id, field FROM post WHERE field = 'name' AND term LIKE '_o%n'
  UNION ALL SELECT DISTINCT 'c', source, id, field FROM post WHERE field = 'name' AND term LIKE '__'
  UNION ALL SELECT DISTINCT 'd', source, id, field FROM post WHERE term LIKE '%x%' ),
wc AS (SELECT query_id, source, id, CASE WHEN query_id IN ('b', 'c') THEN 40 WHEN field = 'name' THEN 6 ELSE 1 END AS score FROM d),
doc AS (SELECT query_id, source, id, CAST(sum(score) AS DOUBLE) AS score FROM wc GROUP BY ALL) {SHOWN}""",
)
def wildcard_infix(spark, sf):
    queries = {"a": [wildcard("*ra*e")], "b": [wildcard("?o*n", "name")], "c": [wildcard("??", "name")], "d": [wildcard("*X*")]}
    return shown(hits_of(spark, sf, ["docs", "parts"], queries))


@query(
    "wildcard_and_words",
    _boolean(
        [("a", 1, "must", "name", 40, "ring")],
        {"a": 2},
        ["parts"],
        "UNION ALL SELECT DISTINCT 'a', 0, 'must', source, id, entity_id, CAST(40 AS DOUBLE) FROM post WHERE field = 'name' AND term LIKE 'co%'",
    ),
)
def wildcard_and_words(spark, sf):
    return shown(hits_of(spark, sf, ["parts"], {"a": [wildcard("co*", "name", role="must"), words("ring", "name", role="must")]}))


@query(
    "date_range_query",
    """WITH r(query_id, lo, hi, score) AS (VALUES ('a', TIMESTAMP '1996-01-01', TIMESTAMP '1999-01-01', 40.0),
  ('b', TIMESTAMP '1997-03-01', TIMESTAMP '1997-05-11', 80.0), ('c', TIMESTAMP '1998-06-01', TIMESTAMP '9999-01-01', 40.0),
  ('d', TIMESTAMP '0001-01-01', TIMESTAMP '1995-03-01', 40.0))
SELECT query_id, 'orders' AS source, CAST(o_orderkey AS VARCHAR) AS id, CAST(score AS DOUBLE) AS score
FROM orders JOIN r ON o_orderdate >= lo AND o_orderdate < hi""",
)
def date_range_query(spark, sf):
    queries = {
        "a": [date_range("1996", "1998")],
        "b": [date_range("19970301", "1997-05-10", boost=2)],
        "c": [date_range("199806", None)],
        "d": [date_range(None, "1995-02")],
    }
    return shown(hits_of(spark, sf, ["orders"], queries))


@query(
    "date_year_query",
    _boolean(
        [("a", 0, "should", None, 1, "attion")],
        {"a": 0},
        ["docs"],
        "UNION ALL SELECT 'a', 1, 'should', source, id, entity_id, CAST(40 AS DOUBLE) FROM cat WHERE year(date) = 2016",
    ),
)
def date_year_query(spark, sf):
    return shown(hits_of(spark, sf, ["docs"], {"a": [words("attion"), date_in("2016")]}))


@query(
    "keyword_query",
    f"""WITH cat AS ({sql_catalogue("docs", "parts")})
SELECT 'a' AS query_id, source, id, CAST(40 AS DOUBLE) AS score FROM cat WHERE list_contains(devs, 'Brand#7')
UNION ALL SELECT 'b', source, id, CAST(CASE WHEN lang AND src THEN 120 WHEN src THEN 80 ELSE 40 END AS DOUBLE) FROM
  (SELECT source, id, list_contains(genres, 'fr') AS lang, list_contains(platforms, 'src3') AS src FROM cat) WHERE lang OR src""",
)
def keyword_query(spark, sf):
    queries = {"a": [keyword("Brand#7", "devs")], "b": [keyword("fr", "genres"), keyword("src3", "platforms", boost=2)]}
    return shown(hits_of(spark, sf, ["docs", "parts"], queries))


_RANKED = [("a", 0, "should", None, 1, "la"), ("b", 0, "should", "name", 40, "was"), ("b", 1, "should", "summary", 1, "erin")]


@query(
    "per_source_ranking",
    f"""WITH {sql_search(TEXTS)}, {sql_words(_RANKED)}, {TERM_HITS}, {DOC_SUM}
SELECT query_id, source, id, round(score, 6) AS score,
  row_number() OVER (PARTITION BY query_id, source ORDER BY round(score, 6) DESC, id) AS rank FROM doc""",
)
def per_source_ranking(spark, sf):
    hits = hits_of(spark, sf, TEXTS, {"a": [words("la")], "b": [words("was", "name"), words("erin", "summary")]})
    return R.full_ranking(hits).select("query_id", "source", "id", rounded(F.col("score")).alias("score"), "rank")


# Every passage of the benchmark table is a query of its own.
SQL_BATCH = f"""bq AS (SELECT CAST(item_id AS VARCHAR) AS query_id, unnest({sql_analysed("text", 1)}) AS term,
  generate_subscripts({sql_analysed("text", 1)}, 1) AS clause FROM benchmark),
atom AS (SELECT query_id, clause, 'should' AS role, v.field, v.w AS weight, term FROM bq JOIN
  (VALUES ('name', 6.0::DOUBLE, 1), ('storyline', 1.0::DOUBLE, 2), ('summary', 1.0::DOUBLE, 2)) v(field, w, n) ON length(term) >= n)"""


def passages(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query("batch_search", f"WITH {sql_search(TEXTS)}, {SQL_BATCH}, {TERM_HITS}, {DOC_SUM} {sql_top(10)}")
def batch_search(spark, sf):
    top = best_documents(tables_of(spark, sf, *TEXTS), bag_of_words(passages(spark, sf)), 10)
    return top.select("query_id", F.col("rank").cast("long").alias("rank"), "source", "id", rounded(F.col("score")).alias("score"))
