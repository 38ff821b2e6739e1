"""Nested query texts: leaves, errors, and results against a direct evaluation of the tree."""

from __future__ import annotations

import random

import pytest

from confluo.operators.leaves import any_of, date_range, phrase, query_table, wildcard, words
from confluo.operators.retrieve import retrieve
from confluo.operators.tables import CatalogueTables
from confluo.operators.trees import query_trees, text_errors, tree_leaves
from confluo.plans.search import search_texts
from tests.helpers import catalogue, doc
from tests.test_search import DOCS


def texts(spark, *given):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(given)], "query_id string, text string")


@pytest.fixture(scope="module")
def tables(spark):
    return CatalogueTables(catalogue(spark, DOCS).persist(), ["s", "t"])


def scores(tables, table):
    return {(r.query_id, r.source, r.id): round(r.score, 9) for r in retrieve(tables, table).collect()}


# The forms users are told about, and the leaves they stand for: (groups around, role, operator, field, value or bounds, boost).
FORMS = {
    "portal": [("", "should", "words", None, "portal", 1.0)],
    "portal OR half": [("", "should", "words", None, "portal", 1.0), ("", "should", "words", None, "half", 1.0)],
    "name:(portal AND 2)": [("0:should", "must", "words", "name", "portal", 1.0), ("0:should", "must", "words", "name", "2", 1.0)],
    "(a AND b) OR c": [("0:should", "must", "words", None, "a", 1.0), ("0:should", "must", "words", None, "b", 1.0), ("", "should", "words", None, "c", 1.0)],
    "name:(x (y NOT z)^2)^3": [("0:should", "should", "words", "name", "x", 3.0), ("0:should/1:should", "should", "words", "name", "y", 6.0),
                               ("0:should/1:should", "must_not", "words", "name", "z", 6.0)],
    "devs:Valve date:2016": [("", "should", "keyword", "devs", "Valve", 1.0), ("", "should", "date", "date", ("2016", "2016"), 1.0)],
    "portal^2.5": [("", "should", "words", None, "portal", 2.5)],
    '"space program"~3^2': [("", "should", "phrase", None, "space program", 2.0)],
    "date:[2005 to 2010]": [("", "should", "date", "date", ("2005", "2010"), 1.0)],
    "[2013 TO 20160510]^2": [("", "should", "date", "date", ("2013", "20160510"), 2.0)],
    "a ANDNOT b": [("", "must", "words", None, "a", 1.0), ("", "must_not", "words", None, "b", 1.0)],
    "a ANDMAYBE (b c)": [("", "must", "words", None, "a", 1.0), ("2:maybe", "should", "words", None, "b", 1.0), ("2:maybe", "should", "words", None, "c", 1.0)],
    "a REQUIRE b": [("", "must", "words", None, "a", 1.0), ("", "filter", "words", None, "b", 1.0)],
    "name:ke* pro?ram": [("", "should", "wildcard", "name", "ke*", 1.0), ("", "should", "wildcard", None, "pro?ram", 1.0)],
    "half-life 2: episode": [("", "should", "words", None, w, 1.0) for w in ("half-life", "2:", "episode")],
    "C&C: x^y name: ~": [("", "should", "words", None, w, 1.0) for w in ("C&C:", "x^y", "name:", "~")],
    "name:(a summary:b)": [("0:should", "should", "words", "name", "a", 1.0), ("0:should", "should", "words", "summary", "b", 1.0)],
    "": [],
    "()": [],
}


def test_forms(spark):
    rows = tree_leaves(texts(spark, *FORMS)).collect()
    for i, (text, expected) in enumerate(FORMS.items()):
        got = [(r["at"], r.role, r.op, r.field, (r.lo, r.hi) if r.op == "date" else r.value, r.boost) for r in rows if r.query_id == str(i)]
        assert sorted(got, key=repr) == sorted(expected, key=repr), text


BAD = {
    "a (b": "a parenthesis has no partner", "a) (b": "a parenthesis has no partner", 'say "x': "a quote has no partner", "{2005 TO 2010}": "a range stands in braces",
    "date:[2013]": "a range needs two ends", "[1 TO 2 TO 3]": "a range needs two ends", "date:soon": "no year, month or day", "date:(2016 soon)": "no year, month or day",
    "date:[2013 TO 1996-13]": "no year, month or day", "name:[a TO b]": "only dates have ranges",
}


def test_a_bad_text_does_not_stop_the_others(spark, tables):
    given = texts(spark, *BAD, "portal AND puzzle")
    assert {r.text: r.error for r in text_errors(given).collect()} == BAD
    assert {r.query_id for r in retrieve(tables, query_trees(given)).collect()} == {str(len(BAD))}
    with pytest.raises(Exception, match="unreadable query text"):
        tree_leaves(given, "fail").collect()
    plain = scores(tables, query_trees(texts(spark, "portal (puzzle"), "words"))
    assert plain == scores(tables, query_table(spark, {"0": [words("portal puzzle")]})) and plain
    with pytest.raises(ValueError):
        tree_leaves(given, "drop")


def test_flat_texts_equal_leaves(spark, tables):
    given = texts(spark, 'summary:"philosophical puzzle"~4', "date:[20130101 to 20160510]^2 portal", "name:(ke* space program)", "portal AND (2 OR stories)")
    leaves = {
        "0": [phrase("philosophical puzzle", "summary", slop=4)],
        "1": [date_range("20130101", "20160510", boost=2), words("portal")],
        "2": [wildcard("ke*", "name"), words("space program", "name")],
        "3": [words("portal", role="must"), any_of(words("2"), words("stories"))],
    }
    assert scores(tables, query_trees(given)) == scores(tables, query_table(spark, leaves))


def test_boosts_reach_into_groups(spark, tables):
    got = scores(tables, query_trees(texts(spark, "name:(stories)", "(stories)^2 x", "name:((stories)^2)^3")))
    one, two, six = (got[(q, "t", "1")] for q in "012")
    assert six == pytest.approx(6 * one) and two == pytest.approx(2 * one * 6 / 40)


def test_groups_of_exclusions_match_nothing(spark, tables):
    assert scores(tables, query_trees(texts(spark, "portal AND (NOT puzzle)", "(NOT puzzle)"))) == {}
    # Stop words form no clause, inside groups either.
    assert scores(tables, query_trees(texts(spark, "portal AND (the of) AND (the puzzle)"))).keys() == {("0", "s", "1"), ("0", "s", "2")}


def test_unresolved_search_by_text(spark, tables):
    rows = search_texts(tables, texts(spark, "name:(portal AND (2 OR stories))", '"bad')).collect()
    assert {r.query_id for r in rows} == {"0"} and len(rows) == 2


# Random trees against a direct evaluation ------------------------------------------------------------------------------

WORDS = [f"w{i}" for i in range(8)]


def random_tree(rng, depth):
    """A group as a list of (joint before, child); children are words or groups."""
    out = []
    for i in range(rng.randint(1, 4)):
        joint = rng.choice(["", "", "AND", "NOT", "OR", "ANDNOT", "ANDMAYBE", "REQUIRE", "AND NOT"]) if i else rng.choice(["", "", "NOT"])
        child = random_tree(rng, depth - 1) if depth and rng.random() < 0.5 else rng.choice(WORDS)
        out.append((joint, child))
    return out


def text_of(tree):
    parts = []
    for joint, child in tree:
        parts += joint.split()
        parts.append(child if isinstance(child, str) else f"({text_of(child)})")
    return " ".join(parts)


def evaluate(tree, part):
    """Score of a document, None if it does not match; ``part`` scores a word or gives None."""
    roles = []
    for i, (joint, _) in enumerate(tree):
        last, following = joint.split()[-1] if joint else "", tree[i + 1][0].split()[0] if i + 1 < len(tree) and tree[i + 1][0] else ""
        role = {"NOT": "must_not", "ANDNOT": "must_not", "ANDMAYBE": "maybe", "REQUIRE": "filter", "AND": "must"}.get(last)
        roles.append(role or ("must" if following in ("AND", "ANDNOT", "ANDMAYBE", "REQUIRE") else "should"))
    found = [part(c) if isinstance(c, str) else evaluate(c, part) for _, c in tree]
    if any(r == "must_not" and f is not None for r, f in zip(roles, found, strict=True)):
        return None
    required = [f for r, f in zip(roles, found, strict=True) if r in ("must", "filter")]
    if None in required or not (required or any(r == "should" and f is not None for r, f in zip(roles, found, strict=True))):
        return None
    return sum(f for r, f in zip(roles, found, strict=True) if f is not None and r in ("should", "must", "maybe"))


def test_random_trees_equal_direct_evaluation(spark):
    rng = random.Random(11)
    docs = [doc("s", i, "x", summary=" ".join(rng.sample(WORDS, rng.randint(1, 6)))) for i in range(60)]
    own = CatalogueTables(catalogue(spark, docs).persist(), ["s"])
    trees = {str(i): random_tree(rng, 4) for i in range(60)}
    single = scores(own, query_table(spark, {w: [words(w, "summary")] for w in WORDS}))
    expected = {}
    for q, tree in trees.items():
        for d in docs:
            score = evaluate(tree, lambda w, d=d: single.get((w, "s", d[1])))
            if score is not None:
                expected[(q, "s", d[1])] = pytest.approx(score)
    given = spark.createDataFrame([(q, f"summary:({text_of(t)})") for q, t in trees.items()], "query_id string, text string")
    got = scores(own, query_trees(given))
    assert got == expected and len(got) > 300 and query_trees(given).depth >= 4
