"""Posting blocks, folders of terms, grams, and the search that reads only what can matter."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from confluo.functions.scoring import tf_part
from confluo.operators import fuse
from confluo.operators import tables as tb
from confluo.operators.bounded import bounded_top_k
from confluo.operators.leaves import bag_of_words, date_in, date_range, query_table, wildcard, words
from confluo.operators.retrieve import retrieve
from confluo.sources import store as S
from confluo.sources.store import StoredTables, materialise
from tests.helpers import catalogue, doc


def corpus(n=1500, seed=1):
    """Every text holds the word "common"; other words get rarer; entities lie in one or two sources."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tail = " ".join(f"w{min(int(rng.expovariate(0.05)), 400)}" for _ in range(rng.randint(3, 40)))
        rows.append(doc("s" if i % 3 else "t", i, f"n{i % 7} common", entity=f"e{i // 2}", summary="common " * rng.randint(1, 4) + tail))
    return rows + [doc("s", n, "needle", entity="e0x", summary="needle common"), doc("t", n + 1, "needle here", entity=None, summary="x")]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root, rows = str(tmp_path_factory.mktemp("store")), catalogue(spark, corpus()).persist()
    for source in ("s", "t"):
        materialise(rows, root, source, bucket_postings=500)
    return StoredTables(spark, root, ["s", "t"])


def plain_tables(stored):
    return tb.CatalogueTables(stored.catalogue, stored.sources)


def test_blocks_hold_the_postings(spark, stored):
    shape = ["source", "field", "term", "id", "entity_id", "len", "tf", "positions"]
    ours, theirs = (sorted(map(repr, t.postings().select(*shape).collect())) for t in (stored, plain_tables(stored)))
    assert ours == theirs
    sizes = stored.blocks().select("term", "n_blocks", "block", F.size("ids").alias("n")).collect()
    assert max(r.n for r in sizes) < 2 * S.BLOCK and any(r.term == "common" and r.n_blocks >= 4 for r in sizes) and all(r.block < r.n_blocks for r in sizes)


def test_statistics_equal_those_of_texts(spark, stored):
    columns = ["source", "field", "term", "df", "total_len"]
    ours, theirs = (sorted(map(repr, t.stats().select(*columns).collect())) for t in (stored, plain_tables(stored)))
    assert ours == theirs


def test_tops_bound_every_posting(spark, stored):
    lengths = tb.field_stats(stored.stats()).select("source", "field", "avg_len")
    opened = S.open_blocks(stored.blocks().where("source = 's'"), keep=["top"]).join(lengths, ["source", "field"])
    parts = opened.select("top", tf_part(F.col("tf"), F.col("len"), F.col("avg_len")).alias("part"))
    assert parts.where("part > top + 1e-12").count() == 0


def test_only_folders_of_asked_terms_are_read(spark, stored):
    assert all(n > 8 for n in stored.buckets.values())
    asked = spark.sql("SELECT 'summary' AS field, 'needle' AS term UNION ALL SELECT 'name', 'n3'")
    found = stored.blocks(terms=asked)
    folders = {r.f.rsplit("/", 1)[0] for r in found.select(F.input_file_name().alias("f")).distinct().collect()}
    assert 1 <= len(folders) <= 2 * 2 and {r.term for r in found.select("term").collect()} == {"needle", "n3"}
    plan = found._jdf.queryExecution().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0] and "In(term" in plan


def test_many_terms_meet_by_a_join_and_answer_alike(spark, stored, monkeypatch):
    asked = query_table(spark, {"a": [words("w1 w2 w3 needle")], "b": [words("common", "name")]})
    named = sorted(map(repr, retrieve(stored, asked).collect()))
    monkeypatch.setattr(S, "NAMED_TERMS", 2)
    assert sorted(map(repr, retrieve(stored, asked).collect())) == named
    plan = stored.blocks(terms=spark.range(5).selectExpr("'name' AS field", "concat('n', id) AS term"))._jdf.queryExecution().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_no_terms_read_nothing(spark, stored):
    assert stored.blocks(terms=spark.range(0).selectExpr("'name' AS field", "cast(id AS string) AS term")).count() == 0
    assert retrieve(stored, query_table(spark, {"a": [words("the of")]})).count() == 0


# Ranked search with bounds --------------------------------------------------------------------------------------------

QUERIES = {"rare": "common needle", "frequent": "common", "several": "w1 w300 common w17 w17", "rarest": "w390 w391 w392", "none": "absent", "empty": "the"}


def complete(tables, table, k):
    top = fuse.fused_top_k(retrieve(tables, table), tables.entities(), tables.sources, k)
    return sorted((r.query_id, r["rank"], r.entity_id, round(r.total_score, 6), r.n_sources) for r in top.collect())


@pytest.mark.parametrize("k", [1, 5, 3000])
def test_bounded_search_equals_the_complete_one(spark, stored, k):
    table = query_table(spark, {q: [words(t)] for q, t in QUERIES.items()})
    got = bounded_top_k(stored, table, k).top.collect()
    assert sorted((r.query_id, r["rank"], r.entity_id, round(r.total_score, 6), r.n_sources) for r in got) == complete(stored, table, k)


def test_bounded_search_with_fields_and_batches(spark, stored):
    rng = random.Random(4)
    rows = [(str(i), " ".join(f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(rng.randint(1, 6))) + " common") for i in range(40)]
    for table in (bag_of_words(spark.createDataFrame(rows, "query_id string, text string")), query_table(spark, {"a": [words("n3 common", "name"), words("w9", "summary", boost=3)]})):
        got = bounded_top_k(stored, table, 4).top.collect()
        assert sorted((r.query_id, r["rank"], r.entity_id, round(r.total_score, 6), r.n_sources) for r in got) == complete(stored, table, 4)


def test_few_blocks_of_a_frequent_word_are_read_beside_a_rare_one(spark, tmp_path):
    rows = [doc("s", i, "x", summary="common " + ("needle " if i < 3 else "") + f"t{i}") for i in range(20_000)]
    materialise(catalogue(spark, rows), str(tmp_path), "s")
    tables = StoredTables(spark, str(tmp_path), ["s"])
    table = query_table(spark, {"q": [words("common needle", "summary")]})
    result = bounded_top_k(tables, table, 3)
    assert {r.entity_id for r in result.top.collect()} == {"s-0", "s-1", "s-2"}
    blocks = {name: {tuple(r) for r in getattr(result, name).collect()} for name in ("asked", "seeds", "candidates", "scored")}
    assert len(blocks["asked"]) > 64
    common = {b for name in ("seeds", "candidates", "scored") for b in blocks[name] if b[2] == "common"}
    assert len(common) <= 16 and ("s", "summary", "needle", 0) in blocks["scored"]


def test_bounds_need_plain_words(spark, stored):
    for query in ([wildcard("a*")], [words("a", role="must")]):
        with pytest.raises(ValueError, match="words without roles"):
            bounded_top_k(stored, query_table(spark, {"q": query}), 5)


# Dates by year --------------------------------------------------------------------------------------------------------


def test_only_years_that_ranges_meet_are_read(spark, tmp_path):
    rows = catalogue(spark, [doc("s", i, "x", date=f"{2000 + i % 12}-0{1 + i % 9}-15") for i in range(200)] + [doc("s", 500, "x")])
    materialise(rows, str(tmp_path), "s")
    tables = StoredTables(spark, str(tmp_path), ["s"])
    assert tables.date_years() == list(range(2000, 2012))
    queries = query_table(spark, {"a": [date_range("2003-05", "2004")], "b": [date_in("2009")], "c": [date_in("1990")]})
    hits = retrieve(tables, queries)
    ours = sorted((r.query_id, r.id, r.score) for r in hits.collect())
    assert ours == sorted((r.query_id, r.id, r.score) for r in retrieve(tb.CatalogueTables(rows, ["s"]), queries).collect()) and len(ours) > 30
    plan = hits._jdf.queryExecution().toString()
    assert "2003" in plan and "2009" in plan and "2008" not in plan.split("PartitionFilters")[1].split("]")[0]
    open_ends = query_table(spark, {"a": [date_range(None, "2001")], "b": [date_range("2010", None)], "c": [date_range(None, None)]})
    counts = {q: sum(r.query_id == q for r in retrieve(tables, open_ends).collect()) for q in "abc"}
    assert counts == {q: sum(r.query_id == q for r in retrieve(tb.CatalogueTables(rows, ["s"]), open_ends).collect()) for q in "abc"} and counts["c"] == 200
    undated = catalogue(spark, [doc("s", 1, "x")])
    materialise(undated, str(tmp_path / "none"), "s")
    assert retrieve(StoredTables(spark, str(tmp_path / "none"), ["s"]), open_ends).count() == 0


# Wildcards by grams ---------------------------------------------------------------------------------------------------

PATTERNS = ["*ee*", "n?", "?", "??*", "*", "w*7", "*1*2*", "*.5", "a_b*", "_*", "*_", "w3?9", "absent*", "100%", "*\\*", "x.y"]


def test_patterns_find_what_like_finds(spark, tmp_path):
    names = ["needle", "n1", "n", "w17", "w1227", "v1.5", "a_b", "axb", "_", "x_", "w379", "100", "éé", "x.y"]
    rows = catalogue(spark, [doc("s", i, n) for i, n in enumerate(names)])
    materialise(rows, str(tmp_path), "s")
    expected = {}
    for i, pattern in enumerate(PATTERNS):
        import fnmatch
        import re

        regex = re.compile(fnmatch.translate(pattern.replace("[", "[[]")), re.S)
        expected[str(i)] = {n for n in names if regex.match(n)}
    table = query_table(spark, {str(i): [wildcard(p, "name")] for i, p in enumerate(PATTERNS)})
    for tables in (tb.CatalogueTables(rows, ["s"]), StoredTables(spark, str(tmp_path), ["s"])):
        got = {q: set() for q in expected}
        for r in retrieve(tables, table).collect():
            got[r.query_id].add(names[int(r.id)])
        assert got == expected


def test_stored_wildcards_read_folders_of_their_terms(spark, stored):
    asked = query_table(spark, {"q": [wildcard("*eedl*", "name")]})
    hits = retrieve(stored, asked)
    assert {r.id for r in hits.collect()} == {"1500", "1501"}
    plan = hits._jdf.queryExecution().toString()
    assert "In(term" in plan or "EqualTo(term" in plan
