from __future__ import annotations

import math

import pytest

from confluo.operators.leaves import any_of, bag_of_words, date_in, date_range, keyword, phrase, query_table, wildcard, words
from confluo.operators.retrieve import full_ranking, retrieve, top_k
from confluo.operators.tables import CatalogueTables
from confluo.plans.search import build, search
from confluo.sources.registry import Registry, SourceSpec
from confluo.sources.store import StoredTables, is_stored, materialise
from tests.helpers import catalogue, doc

DOCS = [
    doc("s", 1, "Portal", summary="a philosophical first-person puzzle game", devs=["Valve"], date="2007-10-10"),
    doc("s", 2, "Portal 2", summary="puzzle again and again", devs=["Valve", "Other"], genres=["Puzzle"], date="2011-04-19"),
    doc("s", 3, "Kerbal Space Program", summary="space", storyline="portal to the moon", date="2015-04-27"),
    doc("s", 4, "Kepler space", devs=["Valve Corp"], date="2016-12-31"),
    doc("s", 5, "Space ship", summary="puzzle philosophical", date="2017-01-01"),
    doc("t", 1, "Portal stories", summary="mod"),
]


@pytest.fixture(scope="module")
def tables(spark):
    return CatalogueTables(catalogue(spark, DOCS).persist(), ["s", "t"])


def ids(spark, tables, *clauses):
    rows = retrieve(tables, query_table(spark, {"q": clauses})).collect()
    return {f"{r.source}{r.id}": r.score for r in rows}


def test_bm25_by_hand(spark, tables):
    got = ids(spark, tables, words("portal 2", "name", boost=1 / 40))
    idf = lambda df: math.log(1 + (5 - df + 0.5) / (df + 0.5))
    tf = lambda n: 2.2 / (1 + 1.2 * (0.25 + 0.75 * n / 2))
    assert got["s1"] == pytest.approx(idf(2) * tf(1)) and got["s2"] == pytest.approx((idf(2) + idf(1)) * tf(2))
    assert sorted(got) == ["s1", "s2", "t1"]


def test_weights_and_boosts(spark, tables):
    unscoped, scoped = ids(spark, tables, words("stories")), ids(spark, tables, words("stories", "name"))
    assert scoped["t1"] == pytest.approx(unscoped["t1"] * 40 / 6)
    assert ids(spark, tables, words("stories", "name", boost=2))["t1"] == pytest.approx(2 * scoped["t1"])
    assert ids(spark, tables, words("mod", "summary"))["t1"] == pytest.approx(ids(spark, tables, words("mod"))["t1"])


def test_roles(spark, tables):
    assert sorted(ids(spark, tables, words("portal puzzle", role="must"))) == ["s1", "s2"]
    assert sorted(ids(spark, tables, words("portal"), words("puzzle", role="must_not"))) == ["s3", "t1"]
    maybe = ids(spark, tables, words("portal", "name", role="must"), words("puzzle", role="maybe"))
    assert sorted(maybe) == ["s1", "s2", "t1"]
    plain = ids(spark, tables, words("portal", "name", role="must"))
    required = ids(spark, tables, words("portal", "name", role="must"), words("puzzle", role="filter"))
    assert sorted(required) == ["s1", "s2"] and required["s1"] == pytest.approx(plain["s1"]) and maybe["s1"] > plain["s1"]
    either = ids(spark, tables, any_of(words("portal", "name"), words("space", "name")), words("puzzle", role="must"))
    assert sorted(either) == ["s1", "s2", "s5"]
    assert ids(spark, tables, words("absent", role="must"), words("portal")) == {}
    # Stop words form no clause, and one met clause in two fields does not stand for two.
    assert sorted(ids(spark, tables, words("the portal of a puzzle", role="must"))) == ["s1", "s2"]
    assert ids(spark, tables, words("space kerbal mod", role="must")) == {}


def test_phrases(spark, tables):
    assert sorted(ids(spark, tables, phrase("philosophical puzzle", "summary", slop=4))) == ["s1"]
    assert ids(spark, tables, phrase("philosophical puzzle", "summary")) == {}
    assert sorted(ids(spark, tables, phrase("puzzle philosophical"))) == ["s5"]
    assert sorted(ids(spark, tables, phrase("again again"))) == ["s2"]
    assert ids(spark, tables, phrase("again again again")) == {}
    assert sorted(ids(spark, tables, phrase("Portal 2", "name"))) == ["s2"]
    # Each field analyses the phrase its own way: the storyline keeps no "2".
    assert sorted(ids(spark, tables, phrase("Portal 2"))) == ["s2", "s3"]


def test_wildcards(spark, tables):
    assert sorted(ids(spark, tables, wildcard("ke*", "name", role="must"), words("space program", "name", role="must"))) == ["s3"]
    assert ids(spark, tables, wildcard("KE*", "name")) == {"s3": 40.0, "s4": 40.0}
    assert sorted(ids(spark, tables, wildcard("p?rtal"))) == ["s1", "s2", "s3", "t1"]
    assert sorted(ids(spark, tables, wildcard("*gram", "name"))) == ["s3"]
    assert ids(spark, tables, wildcard("100%*")) == {}


def test_keywords_and_dates(spark, tables):
    assert ids(spark, tables, keyword("Valve", "devs")) == {"s1": 40.0, "s2": 40.0}
    assert sorted(ids(spark, tables, date_in("2016"))) == ["s4"]
    assert sorted(ids(spark, tables, date_range("2011-04-19", "201504"))) == ["s2", "s3"]
    assert sorted(ids(spark, tables, date_range(None, "20111231"))) == ["s1", "s2"]
    assert sorted(ids(spark, tables, date_range("20161231", None, boost=2)).items()) == [("s4", 80.0), ("s5", 80.0)]
    both = ids(spark, tables, keyword("Valve", "devs"), date_range("20110101", "20160510", boost=2))
    assert both == {"s1": 40.0, "s2": 120.0, "s3": 80.0}


def test_batch_equals_single(spark, tables):
    texts = {"a": "portal 1", "b": "space puzzle", "c": "the of", "d": "portal portal"}
    rows = spark.createDataFrame(list(texts.items()), "query_id string, text string")
    got = {(r.query_id, r.source, r.id): r.score for r in retrieve(tables, bag_of_words(rows)).collect()}
    for q, text in {**texts, "a": "portal"}.items():
        for key, score in ids(spark, tables, words(text)).items():
            assert got.pop((q, key[0], key[1])) == pytest.approx(score)
    assert got == {}


def test_full_ranking_matches_sorting(spark):
    """One query holds most hits and nearly all scores are equal."""
    rows = [("hot", "s", f"{i:05d}", float(i % 3)) for i in range(5000)] + [(f"q{i}", "s", "1", 1.0) for i in range(50)]
    hits = spark.createDataFrame(rows, "query_id string, source string, id string, score double")
    got = {(r.query_id, r.id): r["rank"] for r in full_ranking(hits).collect()}
    hot = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-r[3], r[2]))
    assert len(got) == 5050 and all(got[("hot", r[2])] == n for n, r in enumerate(hot, 1))
    assert all(got[(f"q{i}", "1")] == 1 for i in range(50))


def test_top_k_is_limited_before_the_shuffle(spark, tables):
    plan = top_k(retrieve(tables, query_table(spark, {"q": [words("portal")]})), 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_stored_tables_answer_alike(spark, tables, tmp_path):
    root = str(tmp_path / "store")
    rows = catalogue(spark, DOCS)
    assert not materialise(rows, root, "s", only_if_present=True) and not is_stored(spark, root, "s")
    assert all(materialise(rows, root, s) for s in ("s", "t"))
    stored = StoredTables(spark, root, ["s", "t"])
    queries = query_table(
        spark,
        {
            "a": [words("portal puzzle")],
            "b": [phrase("philosophical puzzle", slop=4), wildcard("ke*")],
            "c": [keyword("Valve", "devs", role="must"), date_in("2011", role="maybe")],
        },
    )
    here = sorted(map(str, search(tables, queries).collect()))
    assert here == sorted(map(str, search(stored, queries).collect())) and len(here) > 5
    plan = stored.postings(terms=spark.sql("SELECT 'name' AS field, 'portal' AS term"))._jdf.queryExecution().toString()
    assert "In(term" in plan or "EqualTo(term" in plan
    # Stored tables stay until forced.
    changed = catalogue(spark, [doc("s", 9, "New")])
    assert materialise(changed, root, "s") and stored.catalogue.where("source = 's'").count() == 5
    assert materialise(changed, root, "s", force=True)
    after = StoredTables(spark, root, ["s", "t"])
    assert sorted(r.id for r in after.catalogue.collect()) == ["1", "9"]
    assert {r.term for r in after.postings().collect()} == {"new", "portal", "stories", "mod"}


def test_build_resolves_in_order_and_reuses(spark, tmp_path):
    first = [doc("a", 1, "Half-Life", devs=["Valve"]), doc("a", 2, "Portal", devs=["Valve"])]
    second = [doc("b", 7, "Portal", devs=["Valve"]), doc("b", 8, "Portal 2")]
    registry = Registry(
        [SourceSpec("a", lambda s, p: catalogue(s, first)), SourceSpec("b", lambda s, p: catalogue(s, second))]
    )
    root = str(tmp_path / "store")
    report = build(spark, registry, "", root)
    assert report == {"a": {"reused": 0, "generated": 2}, "b": {"reused": 1, "generated": 1}}
    rows = {(r.source, r.id): r.entity_id for r in StoredTables(spark, root, ["a", "b"]).catalogue.collect()}
    assert rows[("b", "7")] == rows[("a", "2")] and len(set(rows.values())) == 3
    assert build(spark, registry, "", root) == {"a": None, "b": None}


def test_registry(spark):
    registry = Registry([SourceSpec("a", lambda s, p: s.sql("SELECT '1' AS id, 'x' AS name"))])
    with pytest.raises(ValueError):
        registry.add(SourceSpec("a", None))
    with pytest.raises(KeyError):
        registry.load(spark, "", only="b")
    row = registry.load(spark, "", only="a").first()
    assert (row.source, row.id, row.name, row.devs) == ("a", "1", "x", None)
