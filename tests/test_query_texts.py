"""Query texts, leaf tables, date bounds and validation."""

from __future__ import annotations

import pytest

from confluo.operators import retrieve as R
from confluo.operators.leaves import bag_of_words, date_in, date_range, keyword, leaf_table, phrase, query_table, words
from confluo.operators.retrieve import retrieve
from confluo.operators.tables import CatalogueTables
from confluo.operators.texts import query_texts, text_leaves
from confluo.plans.search import evaluate_suite, search
from confluo.sources.judgements import read_judgements
from tests.helpers import catalogue, doc
from tests.test_search import DOCS

# The headers of a suite as users write them, and the leaves they stand for.
HEADERS = {
    "portal 2": [("should", "words", None, "portal"), ("should", "words", None, "2")],
    "pokemon legends arceus": [("should", "words", None, w) for w in ("pokemon", "legends", "arceus")],
    "half life vr": [("should", "words", None, w) for w in ("half", "life", "vr")],
    "summary:(multiplayer first person shooter) devs:Valve": [
        *[("should", "words", "summary", w) for w in ("multiplayer", "first", "person", "shooter")], ("should", "keyword", "devs", "Valve"),
    ],
    "left for dead 2": [("should", "words", None, w) for w in ("left", "for", "dead", "2")],
    "portal sequel": [("should", "words", None, w) for w in ("portal", "sequel")],
    "the banner saga date:2016": [*[("should", "words", None, w) for w in ("the", "banner", "saga")], ("should", "date", "date", ("2016", "2016"))],
    'summary:"philosophical puzzle"~4': [("should", "phrase", "summary", ("philosophical puzzle", 4))],
    "devs:Valve date:[20130101 TO 20160510]^2": [("should", "keyword", "devs", "Valve"), ("should", "date", "date", ("20130101", "20160510", 2.0))],
    "name:(ke* space program)": [("should", "wildcard", "name", "ke*"), ("should", "words", "name", "space"), ("should", "words", "name", "program")],
    "portal AND NOT stories OR moon": [("must", "words", None, "portal"), ("must_not", "words", None, "stories"), ("should", "words", None, "moon")],
    "[2013 TO ] x": [("should", "date", "date", ("2013", None)), ("should", "words", None, "x")],
}


def texts(spark, *given):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(given)], "query_id string, text string")


def test_headers(spark):
    rows = text_leaves(texts(spark, *HEADERS)).collect()
    for i, (text, expected) in enumerate(HEADERS.items()):
        got = []
        for r in sorted((r for r in rows if r.query_id == str(i)), key=lambda r: r.clause):
            value = r.value
            if r.op == "date":
                value = (r.lo, r.hi) + ((r.boost,) if r.boost != 1 else ())
            elif r.op == "phrase":
                value = (r.value, r.slop)
            got.append((r.role, r.op, r.field, value))
        assert sorted(got, key=repr) == sorted(expected, key=repr), text


@pytest.mark.parametrize("text", ["a (b", 'say "x', "x^y", "name: portal", "(a AND b)", "date:[2013]", "a ~ b", "[1 TO 2 TO 3]"])
def test_unreadable_texts_fail(spark, text):
    with pytest.raises(Exception, match="unreadable|two ends"):
        text_leaves(texts(spark, text)).collect()


@pytest.mark.parametrize("text", ["platform:pc", "devs:\"a b\"^2 foo:x", "date:soon", "date:[2013 TO 1996-13]"])
def test_unknown_fields_and_periods_fail(spark, text):
    tables = CatalogueTables(catalogue(spark, DOCS), ["s", "t"])
    with pytest.raises(Exception, match="cannot look into|no year, month or day"):
        retrieve(tables, query_texts(texts(spark, text))).collect()


def test_search_by_text_equals_leaves(spark):
    tables = CatalogueTables(catalogue(spark, DOCS), ["s", "t"])
    given = texts(spark, 'summary:"philosophical puzzle"~4', "devs:Valve date:[20130101 TO 20160510]^2", "name:(ke* space program)", "portal AND (2 stories)")
    leaves = {
        "0": [phrase("philosophical puzzle", "summary", slop=4)],
        "1": [keyword("Valve", "devs"), date_range("20130101", "20160510", boost=2)],
        "2": [{**words("x", "name"), "op": "wildcard", "value": "ke*"}, words("space program", "name")],
        "3": [words("portal", role="must"), [words("2", role="must"), words("stories", role="must")]],
    }
    got = {(r.query_id, r.source, r.id): round(r.score, 9) for r in retrieve(tables, query_texts(given)).collect()}
    expected = {(r.query_id, r.source, r.id): round(r.score, 9) for r in retrieve(tables, query_table(spark, leaves)).collect()}
    assert got == expected and {q for q, *_ in got} == set(leaves)


def test_leaf_table_defaults_and_errors(spark):
    rows = spark.createDataFrame([("a", 0, "words", "portal"), ("a", 1, "keyword", "Valve")], "query_id string, clause int, op string, value string")
    with pytest.raises(ValueError, match="keyword cannot look into None"):
        leaf_table(rows)
    with pytest.raises(ValueError, match="unknown operator"):
        leaf_table(rows.selectExpr("query_id", "clause", "'near' AS op", "value"))
    with pytest.raises(ValueError, match="no query"):
        leaf_table(rows.limit(0))
    assert leaf_table(rows.where("op = 'words'")).ops == {"words"}


def test_bad_leaves():
    for bad in (lambda: phrase("a b", slop=0), lambda: words("a", "genre"), lambda: words("a", boost=-1), lambda: keyword("a", "name")):
        with pytest.raises(ValueError):
            bad()
    for bound in ("2016-5-32", "1996-13", "20161350", "soon", "", "16", "2016/05"):
        with pytest.raises(ValueError, match="no year, month or day"):
            date_range(bound, None)
        with pytest.raises(ValueError, match="no year, month or day"):
            date_in(bound)


def test_no_query(spark):
    with pytest.raises(ValueError, match="no query"):
        query_table(spark, {})


@pytest.mark.parametrize(("lo", "hi", "n"), [("2016-5-10", "2016-5-12", 1), ("2016-5", "2016-6", 2), ("201605", None, 3), (None, "2016", 3), (None, None, 4)])
def test_date_bounds(spark, lo, hi, n):
    rows = [doc("s", i, "x", date=d) for i, d in enumerate(["2016-01-01", "2016-05-11", "2016-06-30", "2017-01-01"])]
    tables = CatalogueTables(catalogue(spark, rows), ["s"])
    assert retrieve(tables, query_table(spark, {"q": [date_range(lo, hi)]})).count() == n


def test_documents_without_entity_are_found(spark):
    rows = catalogue(spark, DOCS).selectExpr("* EXCEPT (entity_id)", "CAST(NULL AS string) AS entity_id").select(*catalogue(spark, DOCS).columns)
    tables = CatalogueTables(rows, ["s", "t"])
    assert search(tables, query_table(spark, {"q": [words("portal", "name")]})).count() == 3


def test_long_query_texts_are_not_broadcast(spark):
    tables = CatalogueTables(catalogue(spark, DOCS), ["s", "t"])
    long = query_table(spark, {"q": [words("portal " * 400_000)]})
    short = query_table(spark, {"q": [words("portal 2")]})
    assert not R.fits(long, 2) and R.fits(short, 2)
    assert R.fits(bag_of_words(texts(spark, "portal 2")), 2)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        # The terms of a long text stay a join; the one broadcast left holds the field statistics.
        plan = retrieve(tables, long)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastExchange") <= 1
        lookup = {(r.id, r.source): r.score for r in retrieve(tables, query_table(spark, {"q": [words("portal " * 60_000)]})).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    one = {(r.id, r.source): r.score for r in retrieve(tables, query_table(spark, {"q": [words("portal")]})).collect()}
    assert {k: round(v / 60_000, 6) for k, v in lookup.items()} == {k: round(v, 6) for k, v in one.items()}


def test_several_suites_are_judged_apart(spark, tmp_path):
    (tmp_path / "a").write_text("query name:portal\n3 s 1\n0 s 2\n2 s 2\n")
    (tmp_path / "b").write_text("query moon\n1 s 1\nquery summary:space\n3 s 3\n")
    queries, judged = read_judgements(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted((r.query_id, r.query) for r in queries.collect()) == [(1, "name:portal"), (2, "moon"), (3, "summary:space")]
    tables = CatalogueTables(catalogue(spark, DOCS), ["s", "t"])
    figures = evaluate_suite(tables, queries, judged)
    ndcg = {r.query_id: r.ndcg for r in figures["ndcg"].collect()}
    assert set(ndcg) == {"1", "2", "3"} and ndcg["3"] == 1 and ndcg["2"] == 0
    # The last grade of a document counts: both judged documents are relevant and on top.
    assert {r.query_id: r.ap_raw for r in figures["average"].collect()}["1"] == pytest.approx(1.0)


def test_dates_of_a_catalogue_without_any(spark):
    tables = CatalogueTables(catalogue(spark, [doc("s", 1, "x")]), ["s"])
    assert retrieve(tables, query_table(spark, {"q": [date_range(None, None)], "r": [date_in("2016")]})).count() == 0
