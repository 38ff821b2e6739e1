from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from confluo.llm.sharding import Leaf, grow, layout, place, shard_documents
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_every_row_has_a_gapless_slot(spark):
    out = shard_documents(crowded(odd_docs(spark)))
    assert out.columns == COLUMNS
    got = out.collect()
    assert len(got) == len(odd_rows())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows())
    assert texts == Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    assert len({r.shard for r in got if r.doc_id == 9}) == 1


def test_growth_moves_rows_into_the_new_shard_only(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = shard_documents(docs).collect()
    assert {r.shard for r in got} == set(range(40))
    assert all(r.grown_shard in (r.shard, 40) for r in got)
    moved = sum(r.grown_shard == 40 for r in got) / len(got)
    assert 0.018 < moved < 0.031
    sizes = Counter(r.shard for r in got)
    assert 0.7 * 500 < min(sizes.values()) and max(sizes.values()) < 1.3 * 500


def test_weights_confine_movement(spark):
    docs = spark.range(20_000).toDF("doc_id")
    before = layout(8, per_rack=2, racks_per_region=2)
    after = tuple(Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 0 else 1.0) for x in before)
    rows = place(place(docs, "doc_id", before, "a"), "doc_id", after, "b").collect()
    region = {x.shard: x.region for x in before}
    rack = {x.shard: x.rack for x in before}
    # Into the region that grew, or inside it; never between other subtrees.
    assert all(r.a == r.b or region[r.b] == 0 for r in rows)
    assert all(r.a == r.b or rack[r.b] == 0 for r in rows if region[r.a] == 0)
    share = sum(r.b == 0 for r in rows) / len(rows)
    assert 0.27 < share < 0.33


def test_empty_and_bad_weights(spark):
    assert shard_documents(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        place(spark.range(1), "id", (Leaf(0, 0, 0, 0.0),), "s")
    assert grow(layout(40))[-1] == Leaf(5, 10, 40)
