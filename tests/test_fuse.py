from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from confluo.operators import fuse
from confluo.operators.tables import entity_directory
from tests.helpers import catalogue, doc


def setup(spark, scores, sources, absent=()):
    """``scores[source][entity]``; zero means present and not matched."""
    docs, hits = [], []
    for s in sources:
        for e, score in scores[s].items():
            docs.append(doc(s, f"{s}.{e}", e, entity=e))
            if score:
                hits.append(("q", s, f"{s}.{e}", e, float(score)))
    hits = spark.createDataFrame(hits, "query_id string, source string, id string, entity_id string, score double")
    return hits, entity_directory(catalogue(spark, docs), sources)


GOLDEN = {"A": {"portal": 10, "pokemon": 8, "gta": 4}, "B": {"stardew": 8, "portal": 4, "gta": 4}}


def test_worked_example(spark):
    hits, directory = setup(spark, GOLDEN, ["A", "B"])
    rows = {r.entity_id: r.total_score for r in fuse.average(fuse.fuse_sources(hits, ["A", "B"]), directory, ["A", "B"]).collect()}
    assert rows == {"portal": 7, "stardew": 8, "pokemon": 8, "gta": 4}
    top = fuse.fused_top_k(hits, directory, ["A", "B"], 2).orderBy("rank").collect()
    assert [(r.entity_id, r.total_score) for r in top] == [("pokemon", 8), ("stardew", 8)]
    one = fuse.top_k_one_query(hits, directory, ["A", "B"], 2).collect()
    assert [r.entity_id for r in one] == ["pokemon", "stardew"]


def test_mean_over_sources_that_hold_the_entity(spark):
    hits, directory = setup(spark, {"A": {"x": 3}, "B": {"x": 6, "y": 5}, "C": {"x": 0, "y": 1, "z": 0}}, ["A", "B", "C"])
    rows = {r.entity_id: r.total_score for r in fuse.fused_top_k(hits, directory, ["A", "B", "C"], 5).collect()}
    assert rows == {"x": 3, "y": 3}


def test_hits_lead_with_the_discovering_source(spark):
    hits, directory = setup(spark, {"A": {"x": 5, "y": 6, "z": 0}, "B": {"x": 9, "y": 1, "z": 2}}, ["A", "B"])
    top = fuse.fused_top_k(hits, directory, ["A", "B"], 5)
    rows = {r.entity_id: [(h.source, h.score) for h in r.hits] for r in fuse.with_hits(top, hits, ["A", "B"]).collect()}
    assert rows == {"x": [("B", 9), ("A", 5)], "y": [("A", 6), ("B", 1)], "z": [("B", 2), ("A", 0)]}


@pytest.mark.parametrize("seed", [0, 2])
def test_pruning_and_means_match_brute_force(spark, seed):
    rng = random.Random(seed)
    sources = ["A", "B", "C", "D"][: 2 + seed]
    scores = {s: {f"e{i:03d}": rng.choice([0, 0, 1, 2, 3, rng.random() * 5]) for i in range(200) if rng.random() < 0.6} for s in sources}
    hits, directory = setup(spark, scores, sources)
    expected = {}
    for e in {e for s in sources for e in scores[s]}:
        mine = [scores[s][e] for s in sources if e in scores[s]]
        if any(mine):
            expected[e] = sum(mine) / len(mine)
    best = sorted(expected.items(), key=lambda x: (-round(x[1], 6), x[0]))
    for k in (1, 5, 1000):
        kept = fuse.prune(fuse.fuse_sources(hits, sources), sources, k)
        pruned = fuse.average(kept, directory, sources).collect()
        again = sorted(((r.entity_id, r.total_score) for r in pruned), key=lambda x: (-round(x[1], 6), x[0]))[:k]
        plain = [(r.entity_id, r.total_score) for r in fuse.fused_top_k(hits, directory, sources, k).orderBy("rank").collect()]
        assert [e for e, _ in plain] == [e for e, _ in best[:k]] == [e for e, _ in again]
        assert [x for _, x in plain] == pytest.approx([x for _, x in best[:k]])


def test_hot_entity_and_hot_query(spark):
    """Many documents of one source under one entity: the best counts, once."""
    docs = [doc("A", i, "n", entity="hot" if i % 3 else f"e{i}") for i in range(600)]
    hits = spark.createDataFrame(
        [("q", "A", str(i), "hot" if i % 3 else f"e{i}", float(i)) for i in range(600)],
        "query_id string, source string, id string, entity_id string, score double",
    )
    top = fuse.fused_top_k(hits, entity_directory(catalogue(spark, docs), ["A"]), ["A"], 2).orderBy("rank").collect()
    assert [(r.entity_id, r.total_score) for r in top] == [("hot", 599.0), ("e597", 597.0)]


def test_places_are_counted_without_a_shuffle_of_hits(spark):
    """Thresholds go to the tasks, so hits meet them where they are and nothing is dealt by query and source alone."""
    hits = spark.range(2000).selectExpr("'q' AS query_id", "IF(id % 2 = 0, 'A', 'B') AS source", "cast(id AS string) AS id", "concat('e', id div 2) AS entity_id", "cast(id % 7 AS double) AS score")
    directory = hits.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("source", "id"))).alias("docs")).withColumn("n_sources", F.size("docs"))
    top = fuse.fused_top_k(hits, directory, ["A", "B"], 5)
    plain, sent = (fuse.with_hits(top, hits, ["A", "B"], small=small) for small in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, sent.collect()))
    hints = ["strategy=broadcast" in fuse._places(top, hits, ["A", "B"], small)._jdf.queryExecution().optimizedPlan().toString() for small in (False, True)]
    assert hints == [False, True]
