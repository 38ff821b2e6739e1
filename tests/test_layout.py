"""How much a store build, a ranked batch and a dump move: postings are shuffled once, shared words are read once, large dumps are many files."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from confluo.operators import fuse
from confluo.operators import tables as tb
from confluo.operators.leaves import bag_of_words, query_table, words
from confluo.operators.retrieve import retrieve
from confluo.plans import search as P
from confluo.sources import store as S
from confluo.sources.dumps import in_files
from confluo.sources.store import StoredTables, materialise
from tests.helpers import catalogue, doc


def documents(n=700):
    return [doc("a", i, f"w{i % 3} all", entity=f"e{i:04}", summary=f"all all w{i % 7} only{i}") for i in range(n)]


def test_postings_are_shuffled_once(spark):
    own = catalogue(spark, documents(50))
    tokens = tb.token_rows(own)
    plan = S.layout_blocks(tb.build_postings(tokens), tb.build_stats(tokens), 3, 1 << 20, small=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "RebalancePartitions" not in plan
    physical = S.layout_blocks(tb.build_postings(tokens), tb.build_stats(tokens), 3, 1 << 20, small=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(folder" in physical and "ENSURE_REQUIREMENTS, hashpartitioning(folder" not in physical
    assert not [line for line in physical.splitlines() if "Exchange hashpartitioning" in line and "at#" in line]


@pytest.mark.parametrize("sent", [0, 1 << 18])
def test_a_frequent_term_is_dealt_to_several_tasks(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(S, "BLOCK", 4)
    monkeypatch.setattr(S, "CHUNK_BLOCKS", 16)
    monkeypatch.setattr(S, "TASK_POSTINGS", 200)
    monkeypatch.setattr(S, "GRAM_TERMS", 100)
    monkeypatch.setattr(S, "SENT_TERMS", sent)
    own, root = catalogue(spark, documents()), str(tmp_path)
    materialise(own, root, "a", bucket_postings=500)
    stored, direct = StoredTables(spark, root, ["a"]), tb.CatalogueTables(own, ["a"])
    columns = ["source", "field", "term", "id", "entity_id", "len", "tf", "positions"]
    assert sorted(map(str, stored.postings().select(*columns).collect())) == sorted(map(str, direct.postings().select(*columns).collect()))
    blocks = stored._read("postings").where("term = 'all'")
    assert blocks.select("field", "block").distinct().count() == blocks.count() > 32
    assert blocks.select(F.input_file_name()).distinct().count() > 2
    assert sorted(map(str, stored.grams().collect())) == sorted(map(str, direct.grams().distinct().collect()))
    asked = spark.createDataFrame([("name", "w1"), ("summary", "only5")], "field string, term string")
    found = stored.blocks(terms=asked, small=True)
    assert {r.term for r in S.open_blocks(found).collect()} == {"w1", "only5"}
    assert len(found.inputFiles()) < len(stored._read("postings").inputFiles())
    nothing = spark.createDataFrame([("name", "nowhere")], "field string, term string")
    assert stored.blocks(terms=nothing, small=True).count() == 0


def test_a_batch_that_shares_its_words_is_scored_together(spark, tmp_path, monkeypatch):
    materialise(catalogue(spark, documents(300)), str(tmp_path), "a")
    tables = StoredTables(spark, str(tmp_path), ["a"])
    shared = bag_of_words(spark.createDataFrame([(i, f"all w{i % 3} w{i % 5}") for i in range(12)], "query_id long, text string"))
    apart = query_table(spark, {"x": [words("only5")], "y": [words("w1")]})
    assert P._share_words(tables, shared) and not P._share_words(tables, apart)
    monkeypatch.setattr(P, "bounded_top_k", None)
    columns = ["query_id", "rank", "entity_id"]
    complete = fuse.fused_top_k(retrieve(tables, shared), tables.entities(), ["a"], 5)
    assert sorted(P.search_ranked(tables, shared).select(*columns).collect()) == sorted(complete.select(*columns).collect())


def test_files_of_a_dump_hold_a_bounded_number_of_records(spark):
    rows = spark.range(95).selectExpr("cast(id AS string) AS id")
    assert in_files(rows, "id", records=10, least=4).rdd.getNumPartitions() == 10
    assert in_files(rows, "id", least=4).rdd.getNumPartitions() == 4
    assert in_files(rows.limit(0), "id").rdd.getNumPartitions() == 1


def test_postings_of_a_batch_are_made_together(monkeypatch):
    """Rows of one batch in groups of any size: every document and term once, places in order; empty and missing rows have none."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    rows = [("s", "name", f"d{i}", None if i % 4 else f"e{i}", [rng.choice(words) for _ in range(rng.choice([0, 1, 5, 300]))]) for i in range(60)]
    rows += [("s", "summary", "d1", "e1", None), ("t", "name", None, "x", ["a", "b", "a"]), ("t", "name", None, "x", ["a", "b", "a"])]
    expected = sorted(
        (str(r[:4]), len(r[4]), t, r[4].count(t), [p for p, x in enumerate(r[4]) if x == t]) for r in rows if r[4] for t in set(r[4])
    )
    columns = [pa.array(c, pa.string()) for c in list(zip(*rows, strict=True))[:4]]
    columns += [pa.array([len(r[4] or []) for r in rows], pa.int32()), pa.array([r[4] for r in rows], pa.list_(pa.string()))]
    batch = pa.RecordBatch.from_arrays(columns, names=["source", "field", "id", "entity_id", "len", "tokens"])
    for tokens in (1, 100, 1 << 20):
        monkeypatch.setattr(tb, "POSTING_TOKENS", tokens)
        got = [r for out in tb._postings(iter([batch.slice(0, 7), batch.slice(7)])) for r in out.to_pylist()]
        assert sorted((str((r["source"], r["field"], r["id"], r["entity_id"])), r["len"], r["term"], r["tf"], r["positions"]) for r in got) == expected
