from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from confluo.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def vectors(n, width, seed):
    rng = random.Random(seed)
    half = [(i, [rng.gauss(0, 1) * rng.choice([0.1, 1, 3]) for _ in range(width)], 0) for i in range(n)]
    half = [(i, [float(__import__("struct").unpack("f", __import__("struct").pack("f", x))[0]) for x in v], l) for i, v, l in half]  # noqa: E741
    return half


def test_equals_brute_force(spark):
    rows = vectors(700, 16, 1)
    rows += [(1000 + i, rows[3][1], 1) for i in range(40)]  # many equal vectors, so many ties
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for block in (4096, 7):
        got = topk.top_k(df, F.col("vec_id") % 20 == 0, block=block)
        assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_pruning_skips_most_pairs():
    import numpy as np

    rng = np.random.default_rng(0)
    vectors_ = np.floor(rng.normal(0, 100, (4000, 32)) * rng.exponential(1, (4000, 1)) * np.linspace(3, 0.1, 32))
    basis = np.linalg.eigh(vectors_.T @ vectors_)[1][:, ::-1].copy()
    block = topk.QueryBlock(np.arange(50), vectors_[:50], basis)
    best = topk.BestScores(50, 5)
    scored = topk.search_block(block, np.arange(4000), vectors_, best)
    exact = vectors_[:50] @ vectors_.T
    exact[np.arange(50), np.arange(50)] = -np.inf
    assert np.array_equal(best.scores, -np.sort(-exact, axis=1)[:, :5]) and scored < 0.3 * 50 * 4000


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (50, [0.25, -0.5], None), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [1.0, 1.0], 1),
        (5, [1.0, 1.0], 1), (0, [2.0, 2.0], 1), (None, [1.0, 1.0], 1), (6, [0.001, -0.001], 1), (-50, [0.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "2 AS score", "3 AS rank", "4 AS query_id")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0)
    # Both rows with id 0 are queries, each with results of its own.
    assert sorted(map(tuple, got.collect())) == brute(rows, 50)
    ok = {0, 50, 5, 6, -50}
    assert {r.vec_id for r in got.collect()} <= ok and {r.query_id for r in got.collect()} == {0, 50, -50}
    empty = topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0
    assert topk.top_k(spark.createDataFrame(rows[:1], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_mixed_dimensions(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-4, 4) for _ in range(rng.choice([0, 0, 0, 1, 2, 2, 3, 7, 40]))], 0) for i in range(300)]
    df = spark.createDataFrame([(i, [math.floor(256 * x) / 256 for x in v], n) for i, v, n in rows], SCHEMA).repartition(4)
    exact = [(i, [math.floor(256 * x) / 256 for x in v], n) for i, v, n in rows]
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0).collect())) == brute(exact, 20)
    small = [(0, [1.0, 2.0, 3.0, 4.0], 0), (1, [1.0, 2.0, 3.0, 4.0], 0), (2, [1.0, 2.0], 0), (3, [1.0, 1.0], 0), (4, [9.0, 0.0], 0), (5, [], 0)]
    assert sorted(map(tuple, topk.top_k(spark.createDataFrame(small, SCHEMA), F.col("vec_id") == 0).collect())) == [r for r in brute(small, 1) if r[0] == 0]


def test_scores_beyond_double_precision(spark):
    base = float(1 << 30)
    rows = [(i, [base, base, base + 4 * (i % 5), 1.0 * i, 3.0], 0) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, scale=1)
    ints, expected = {i: [math.floor(x) for x in v] for i, v, _ in rows}, []
    for q in range(0, 80, 10):
        best = sorted((-sum(x * y for x, y in zip(ints[q], c, strict=True)), i) for i, c in ints.items() if i != q)[:5]
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(expected) and max(r[3] for r in expected) > 1 << 60


def test_beyond_a_long(spark):
    rows = [(i, [1e30, -1e30 if i == 3 else 1e30], 0) for i in range(4)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])][:2] == [(1, topk.MOST), (2, topk.MOST)]


def test_many_blocks_and_repeated_queries(spark):
    rows = vectors(200, 8, 3)
    rows += [(i, v, 1) for i, v, _ in vectors(200, 8, 4) if i % 20 == 0] + [(40, rows[40][1], 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for block in (4096, 3):
        assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0, block=block).collect())) == brute(rows, 20)


def test_dense_and_sparse_products_agree(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    given = np.floor(rng.normal(0, 100, (900, 12))).astype(np.int64)
    basis = np.linalg.eigh((given.T @ given).astype(float))[1][:, ::-1].copy()
    found = []
    for share in (0.0, 2.0):
        monkeypatch.setattr(topk, "DENSE", share)
        best = topk.BestScores(40, 5)
        topk.search_block(topk.QueryBlock(np.arange(40), given[:40], basis), np.arange(900), given, best)
        found.append((best.scores.tolist(), best.ids.tolist()))
    assert found[0] == found[1]
