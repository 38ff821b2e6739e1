"""Sources, normalisation and text analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, sql_analysed
from checks.views import READERS, first_sentence, sql_catalogue, sql_sentence, table
from confluo.functions import values as V
from confluo.functions.dates import MONTHS, date_parts
from confluo.functions.text import clean_query, keep_numbers, snippet, standard, strip_tags
from confluo.operators import normalise as N
from confluo.operators.tables import keyword_rows
from confluo.schemas import RATINGS_API, STORE_DUMP
from confluo.sources import dumps
from confluo.sources.judgements import parse_suite
from confluo.sources.registry import Registry, SourceSpec


def registry(*names: str) -> Registry:
    return Registry(SourceSpec(n, READERS[n]) for n in names)


def catalogue(spark, sf, *names):
    return registry(*names).load(spark, sf)


@query("scan_filter_documents", "SELECT doc_id, lang, n_chars FROM documents WHERE lang IN ('en', 'de') AND n_chars >= 500")
def scan_filter_documents(spark, sf):
    docs = table(spark, sf, "documents").where(F.col("lang").isin("en", "de"))
    return dumps.keep_fields(N.known_only(docs, "n_chars", 500), ["doc_id", "lang", "n_chars"])


@query(
    "incremental_new_keys",
    "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def incremental_new_keys(spark, sf):
    return dumps.new_keys(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


def _replies(spark, sf):
    """Fetch replies: orders of status F come back broken, cheap ones without success, urgent ones under another key."""
    other = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).otherwise(F.col("o_orderkey"))
    good = F.format_string(
        '{"%d": {"success": %s, "data": {"steam_appid": %d, "name": "%s", "type": "game"}}}',
        F.col("o_orderkey"),
        F.when(F.col("o_totalprice") < 50000, "false").otherwise("true"),
        other,
        F.col("o_orderpriority"),
    )
    broken = F.concat(F.lit("<html>"), F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("asked"), F.when(F.col("o_orderstatus") == "F", broken).otherwise(good).alias("payload")
    )


_OUTCOME = """CASE WHEN o_orderstatus = 'F' OR o_totalprice < 50000 THEN 'failed'
  WHEN o_orderpriority = '1-URGENT' AND o_custkey <> o_orderkey THEN 'redirect' ELSE 'ok' END"""


@query(
    "classify_records",
    f"""SELECT o_orderkey AS asked, outcome, CASE WHEN outcome = 'redirect' THEN o_custkey END AS redirect,
  CASE WHEN outcome <> 'failed' THEN o_orderpriority END AS name FROM (SELECT *, {_OUTCOME} AS outcome FROM orders)""",
)
def classify_records(spark, sf):
    return dumps.classify_fetch(_replies(spark, sf)).select("asked", "outcome", "redirect", F.col("record.name").alias("name"))


@query(
    "fetched_rows",
    f"""WITH c AS (SELECT *, {_OUTCOME} AS outcome FROM orders)
SELECT o_orderkey AS steam_appid, o_orderpriority AS name, CAST(NULL AS BOOLEAN) AS failed, CAST(NULL AS BIGINT) AS redirect
  FROM c WHERE outcome = 'ok'
UNION ALL SELECT o_custkey, o_orderpriority, NULL, NULL FROM c
  WHERE outcome = 'redirect' AND o_custkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
UNION ALL SELECT o_orderkey, NULL, true, CASE WHEN outcome = 'redirect' THEN o_custkey END FROM c WHERE outcome <> 'ok'""",
)
def fetched_rows(spark, sf):
    listing = table(spark, sf, "orders").where("o_orderstatus = 'O'").select("o_orderkey")
    rows = dumps.fetched_rows(dumps.classify_fetch(_replies(spark, sf)), listing, "o_orderkey")
    return rows.select("steam_appid", "name", "failed", "redirect")


_CAT = ("docs", "pages", "conv", "parts")


@query(
    "union_sources",
    f"""SELECT source, id, entity_id, name, array_to_string(genres, ',') AS genres, array_to_string(devs, ',') AS devs,
  strftime(date, '%Y-%m-%d') AS date, popularity, md5(coalesce(summary, '')) AS summary_hash FROM ({sql_catalogue(*_CAT)})""",
)
def union_sources(spark, sf):
    return catalogue(spark, sf, *_CAT).select(
        "source",
        "id",
        "entity_id",
        "name",
        V.join_list(F.col("genres")).alias("genres"),
        V.join_list(F.col("devs")).alias("devs"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "popularity",
        F.md5(F.coalesce("summary", F.lit(""))).alias("summary_hash"),
    )


@query("only_one_source", f"SELECT source, id, name FROM ({sql_catalogue('pages')})")
def only_one_source(spark, sf):
    return registry(*_CAT).load(spark, sf, only="pages").select("source", "id", "name")


@query(
    "parse_judgements",
    """SELECT d.lang AS query, CAST(2 * quality + 1 - toxic AS INTEGER) AS relevance, 'docs' AS source, CAST(doc_id AS VARCHAR) AS id
FROM labels JOIN documents d USING (doc_id)""",
)
def parse_judgements(spark, sf):
    """A suite text per language: header, comment and blank lines, then one entry per label."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    grade = (2 * F.col("quality") + 1 - F.col("toxic")).cast("string")
    entries = table(spark, sf, "labels").join(docs, "doc_id").select(
        F.col("lang").alias("suite"),
        F.floor(F.col("doc_id") / 100).alias("block"),
        F.col("doc_id").alias("pos"),
        F.concat(grade, F.lit("  docs "), F.col("doc_id").cast("string"), F.lit("   # label")).alias("line"),
    )
    heads = docs.select("lang").distinct().select(
        F.col("lang").alias("suite"),
        F.lit(-1).cast("long").alias("block"),
        F.posexplode(F.array(F.lit("# suite"), F.lit(""), F.concat(F.lit("Query "), F.col("lang"), F.lit(" # head")))).alias("pos", "line"),
    ).withColumn("pos", F.col("pos").cast("long"))
    _, judgements = parse_suite(heads.unionByName(entries))
    return judgements.select("query", "relevance", "source", "id")


_RELEASES = """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN [] WHEN l_returnflag = 'A' THEN [CAST(NULL AS BIGINT)]
  ELSE [s, NULL, s - CAST(l_quantity AS BIGINT) * 86400] END AS dates
  FROM (SELECT *, CAST(epoch(l_shipdate) AS BIGINT) AS s FROM lineitem)"""


def _releases(spark, sf):
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    day = lambda c: F.struct(c.cast("long").alias("date"))
    none = day(F.lit(None))
    earlier = day(seconds - F.col("l_quantity").cast("long") * 86400)
    dates = (
        F.when(F.col("l_returnflag") == "R", F.array().cast("array<struct<date:bigint>>"))
        .when(F.col("l_returnflag") == "A", F.array(none))
        .otherwise(F.array(day(seconds), none, earlier))
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", dates.alias("release_dates"))


@query("earliest_date", f"SELECT l_orderkey, l_linenumber, list_min(dates) AS release_date FROM ({_RELEASES})")
def earliest_date(spark, sf):
    first = V.earliest_date(F.col("release_dates"))
    return _releases(spark, sf).select("l_orderkey", "l_linenumber", first.alias("release_date"))


def _companies():
    company = lambda name, dev: F.struct(F.struct(name.alias("name")).alias("company"), dev.alias("developer"))
    return F.array(
        company(F.col("p_brand"), F.col("p_size") > 25),
        company(F.col("p_type"), F.col("p_size") <= 40),
        company(F.lit("Publisher"), F.lit(False)),
    )


def _names(*columns):
    return F.array(*[F.struct(F.col(c).alias("name")) for c in columns])


@query(
    "nested_names",
    """SELECT p_partkey, CASE WHEN p_size > 30 THEN '' ELSE p_brand || ',' || p_type END AS genres,
  CASE WHEN p_size > 30 THEN 0 ELSE 2 END AS n FROM part""",
)
def nested_names(spark, sf):
    genres = F.when(F.col("p_size") <= 30, _names("p_brand", "p_type"))
    names = V.nested_names(genres)
    return table(spark, sf, "part").select("p_partkey", V.join_list(names).alias("genres"), F.size(names).alias("n"))


@query(
    "nested_filter",
    """SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size > 25 THEN p_brand END, CASE WHEN p_size <= 40 THEN p_type END],
  lambda x: x IS NOT NULL), ',') AS devs FROM part""",
)
def nested_filter(spark, sf):
    return table(spark, sf, "part").select("p_partkey", V.join_list(V.developer_names(_companies())).alias("devs"))


@query(
    "popularity_filter",
    f"""SELECT source, id, popularity FROM ({sql_catalogue("docs", "pages", "parts")})
WHERE (source = 'docs' AND popularity >= 1000) OR (source = 'pages' AND popularity >= 5000) OR source = 'parts'""",
)
def popularity_filter(spark, sf):
    rows = catalogue(spark, sf, "docs", "pages", "parts")
    return N.known_only_by_source(rows, {"docs": 1000, "pages": 5000}).select("source", "id", "popularity")


def _store_records(spark, sf):
    """Documents as store pages: missing names and types, failed rows, repeated keys, dates in several spellings."""
    key = F.col("doc_id")
    day = F.date_add(F.lit("2010-01-01").cast("date"), (key * 37 % 3650).cast("int"))
    date = (
        F.when(key % 5 == 0, F.date_format(day, "d MMM, yyyy"))
        .when(key % 5 == 1, F.date_format(day, "MMM d, yyyy"))
        .when(key % 5 == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 3, F.lit("soon"))
        .otherwise(F.lit(""))
    )
    record = {
        "steam_appid": F.floor(key / 2),
        "type": F.when(key % 11 == 0, F.lit(None)).when(key % 7 == 0, "demo").when(key % 3 == 0, "dlc").otherwise("game"),
        "name": F.when(key % 13 == 0, "").otherwise(first_sentence("text")),
        "about_the_game": F.concat(F.lit("<p class=x>"), F.col("text"), F.lit("</p>")),
        "detailed_description": F.concat(F.lit("<b>"), F.col("lang"), F.lit("</b>")),
        "developers": F.when(key % 4 > 0, F.array("source")),
        "genres": F.when(key % 4 > 1, F.array(F.struct(F.lit(None).cast("string").alias("id"), F.col("lang").alias("description")))),
        "platforms": F.create_map(F.lit("windows"), F.lit(True), F.lit("mac"), key % 2 == 0),
        "recommendations": F.when(key % 9 > 0, F.struct(F.col("n_chars").alias("total"))),
        "release_date": F.struct((key % 17 == 0).alias("coming_soon"), date.alias("date")),
        "failed": F.when(key % 19 == 0, F.lit(True)),
    }
    columns = [record.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STORE_DUMP.fields]
    return table(spark, sf, "documents").select(key.alias("line"), *columns)


_STORE = f"""SELECT doc_id AS line, doc_id // 2 AS appid,
  CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'demo' WHEN doc_id % 3 = 0 THEN 'dlc' ELSE 'game' END AS type,
  CASE WHEN doc_id % 13 = 0 THEN '' ELSE {sql_sentence("text")} END AS name, doc_id % 19 = 0 AS failed,
  CASE WHEN doc_id % 9 > 0 THEN n_chars ELSE 0 END AS total, text, lang, source,
  CASE WHEN doc_id % 17 = 0 OR doc_id % 5 > 2 THEN NULL ELSE CAST(DATE '2010-01-01' + CAST(doc_id * 37 % 3650 AS INTEGER) AS DATE) END AS day,
  doc_id FROM documents"""
_STORE_OK = f"SELECT * FROM ({_STORE}) WHERE name <> '' AND NOT failed AND coalesce(type, 'unknown') IN ('game', 'dlc')"


@query("valid_records", f"SELECT line, appid AS steam_appid, type FROM ({_STORE_OK})")
def valid_records(spark, sf):
    return N.valid_records(_store_records(spark, sf)).select("line", "steam_appid", "type")


@query(
    "dedup_first",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
WHERE n = 1""",
)
def dedup_first(spark, sf):
    return N.first_wins(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(
    "strip_html",
    """SELECT page_id, md5(regexp_replace(html, '<([^\\n]*?)>', '', 'g')) AS text_hash,
  CAST(length(regexp_replace(html, '<([^\\n]*?)>', '', 'g')) AS INTEGER) AS n FROM pages""",
)
def strip_html(spark, sf):
    text = strip_tags(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.md5(text).alias("text_hash"), F.length(text).alias("n"))


@query(
    "parse_dates",
    f"""SELECT line, strftime(day, '%Y-%m-%d') AS date, (doc_id % 17 <> 0 AND doc_id % 5 = 3) AS unreadable FROM ({_STORE})""",
)
def parse_dates(spark, sf):
    text, soon = F.col("release_date.date"), F.col("release_date.coming_soon")
    return _store_records(spark, sf).select(
        "line", F.date_format(V.parse_date(text, soon), "yyyy-MM-dd").alias("date"), V.unreadable_date(text, soon).alias("unreadable")
    )


# The same day written in many ways, by the language of the document; the SQL knows the day itself.
_DAY = "DATE '2010-01-01' + CAST((doc_id * 37) % 3650 AS INTEGER)"
_WRITTEN = {0: "dd.MM.yyyy", 1: "yyyy/MM/dd", 2: "'Q'q yyyy", 3: None, 4: "MMM d, yyyy", 5: "yyyyMMdd", 6: "MM/yyyy", 7: "yyyy", 8: "dd/MM/yyyy", 9: "d.M.yyyy"}


@query(
    "parse_dates_by_parts",
    f"""SELECT doc_id, CASE WHEN k = 10 THEN NULL ELSE strftime(CASE k WHEN 2 THEN date_trunc('quarter', day) WHEN 6 THEN date_trunc('month', day)
  WHEN 7 THEN date_trunc('year', day) ELSE day END, '%Y-%m-%d') END AS date,
  CASE k WHEN 10 THEN NULL WHEN 2 THEN 'quarter' WHEN 6 THEN 'month' WHEN 7 THEN 'year' ELSE 'day' END AS precision,
  CASE WHEN k = 10 THEN NULL ELSE k = 8 AND day(day) <= 12 AND day(day) <> month(day) END AS ambiguous
FROM (SELECT doc_id, doc_id % 11 AS k, {_DAY} AS day FROM documents)""",
)
def parse_dates_by_parts(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", "lang", "doc_id % 11 AS k", "date_add(DATE '2010-01-01', cast(doc_id * 37 % 3650 AS int)) AS day")
    names = F.create_map(*[x for lang, months in MONTHS.items() for x in (F.lit(lang), F.array(*[F.lit(m) for m in months]))])
    named = F.concat_ws(" ", F.dayofmonth("day"), F.element_at(F.element_at(names, F.col("lang")), F.month("day")), F.year("day"))
    text = F.lit("on its way")
    for k, form in _WRITTEN.items():
        text = F.when(F.col("k") == k, named if form is None else F.date_format("day", form)).otherwise(text)
    parts = docs.withColumn("text", text).select("doc_id", date_parts("text").alias("p"))
    return parts.select("doc_id", F.date_format("p.date", "yyyy-MM-dd").alias("date"), "p.precision", "p.ambiguous")


@query(
    "epoch_to_ts",
    """SELECT event_id, strftime(make_timestamp(CAST((s - 1500) * 1000000 * 40000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS ts
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 3000 END AS s FROM events)""",
)
def epoch_to_ts(spark, sf):
    seconds = F.when(F.col("event_type") != "error", (F.col("event_id") % 3000 - 1500) * 40000)
    return table(spark, sf, "events").select(
        "event_id", F.date_format(V.epoch_to_timestamp(seconds), "yyyy-MM-dd HH:mm:ss").alias("ts")
    )


@query("join_lists", "SELECT doc_id, lang || ',' || source AS joined FROM documents")
def join_lists(spark, sf):
    return table(spark, sf, "documents").select("doc_id", V.join_list(F.array("lang", "source")).alias("joined"))


@query("map_key_list", "SELECT event_id, array_to_string(json_keys(props), ',') AS keys FROM events")
def map_key_list(spark, sf):
    flags = F.transform_values(F.from_json("props", "map<string,string>"), lambda k, v: F.lit(True))
    return table(spark, sf, "events").select("event_id", V.join_list(V.map_key_list(flags)).alias("keys"))


_RATINGS = f"""SELECT 'ratings' AS source, CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(NULL AS VARCHAR) AS storyline, p_type AS summary,
  CASE WHEN p_size > 30 THEN '' ELSE p_brand || ',' || p_type END AS genres, '' AS platforms,
  array_to_string(list_filter([CASE WHEN p_size > 25 THEN p_brand END, CASE WHEN p_size <= 40 THEN p_type END],
  lambda x: x IS NOT NULL), ',') AS devs,
  strftime(make_timestamp(CAST(p_partkey * 86400 AS BIGINT) * 1000000 - 3000000000000), '%Y-%m-%d') AS date,
  CAST(p_size AS BIGINT) AS popularity FROM part WHERE p_size >= 5"""
_STORED = f"""SELECT 'store' AS source, CAST(appid AS VARCHAR) AS id, name, '<b>' || lang || '</b>' AS storyline,
  regexp_replace('<p class=x>' || text || '</p>', '<([^\\n]*?)>', '', 'g') AS summary, CASE WHEN doc_id % 4 > 1 THEN lang ELSE '' END AS genres, 'windows,mac' AS platforms,
  CASE WHEN doc_id % 4 > 0 THEN source ELSE '' END AS devs, strftime(day, '%Y-%m-%d') AS date, total AS popularity
  FROM (SELECT *, row_number() OVER (PARTITION BY appid ORDER BY line) AS n FROM ({_STORE_OK}) WHERE total >= 1000) WHERE n = 1"""


@query(
    "normalise_catalogue",
    f"""SELECT source, id, name, storyline, md5(summary) AS summary_hash, genres, platforms, devs, date, popularity
FROM (({_RATINGS}) UNION ALL ({_STORED}))""",
)
def normalise_catalogue(spark, sf):
    """Both raw formats through their mappings into one catalogue."""

    def ratings(session, path):
        raw = {
            "id": F.col("p_partkey"),
            "name": F.col("p_name"),
            "summary": F.col("p_type"),
            "genres": F.when(F.col("p_size") <= 30, _names("p_brand", "p_type")),
            "involved_companies": _companies(),
            "release_dates": F.array(
                F.struct(F.lit(None).cast("long").alias("date")), F.struct((F.col("p_partkey") * 86400 - 3000000).alias("date"))
            ),
            "total_rating_count": F.col("p_size"),
        }
        columns = [raw.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RATINGS_API.fields]
        return N.ratings_catalogue(N.ratings_dump_rows(table(session, path, "part").select(*columns)))

    def store(session, path):
        return N.store_catalogue(_store_records(session, path), ["line"])

    rows = Registry([SourceSpec("ratings", ratings), SourceSpec("store", store)]).load(spark, sf)
    lists = [V.join_list(F.col(c)).alias(c) for c in ("genres", "platforms", "devs")]
    return rows.select(
        "source", "id", "name", "storyline", F.md5("summary").alias("summary_hash"), *lists,
        F.date_format("date", "yyyy-MM-dd").alias("date"), "popularity",
    )


def _term_counts(df, tokens):
    rows = df.select(tokens.alias("tokens"))
    return (
        rows.select(F.explode("tokens").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "tokenize_keep_numbers",
    f"SELECT term, count(*) AS n FROM (SELECT unnest({sql_analysed('text', 1)}) AS term FROM documents) GROUP BY term",
)
def tokenize_keep_numbers(spark, sf):
    return _term_counts(table(spark, sf, "documents"), keep_numbers("text"))


@query(
    "tokenize_standard",
    f"SELECT term, count(*) AS n FROM (SELECT unnest({sql_analysed('html', 2)}) AS term FROM pages) GROUP BY term",
)
def tokenize_standard(spark, sf):
    return _term_counts(table(spark, sf, "pages"), standard("html"))


@query(
    "keyword_terms",
    f"""WITH cat AS ({sql_catalogue(*_CAT)}) SELECT source, field, term, count(*) AS n FROM (
SELECT DISTINCT source, id, 'genres' AS field, unnest(genres) AS term FROM cat
UNION ALL SELECT DISTINCT source, id, 'platforms', unnest(platforms) FROM cat
UNION ALL SELECT DISTINCT source, id, 'devs', unnest(devs) FROM cat) GROUP BY ALL""",
)
def keyword_terms(spark, sf):
    return keyword_rows(catalogue(spark, sf, *_CAT)).groupBy("source", "field", "term").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clean_query_text",
    r"""SELECT item_id, regexp_replace(regexp_replace(raw, '^\s+|\s+$', '', 'g'), '\s+[1I]$', '') AS text FROM (
SELECT item_id, '  ' || text || CASE item_id % 4 WHEN 0 THEN ' 1' WHEN 1 THEN ' I ' WHEN 2 THEN ' 2' ELSE '' END AS raw FROM benchmark)""",
)
def clean_query_text(spark, sf):
    kind = F.col("item_id") % 4
    tail = F.when(kind == 0, " 1").when(kind == 1, " I ").when(kind == 2, " 2").otherwise("")
    raw = F.concat(F.lit("  "), F.col("text"), tail)
    return table(spark, sf, "benchmark").select("item_id", clean_query(raw).alias("text"))


@query(
    "snippet",
    "SELECT doc_id, CASE WHEN length(text) > 150 THEN substring(text, 1, 150) || '...' ELSE text END AS snippet FROM documents",
)
def snippets(spark, sf):
    return table(spark, sf, "documents").select("doc_id", snippet(F.col("text")).alias("snippet"))


