from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from confluo.llm import lexical as L
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows, rows_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 75 + (75 * c.total() * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, docs=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)] + ["É", "x9", "漢字"]
    word = lambda: vocabulary[min(int(rng.expovariate(0.08)), len(vocabulary) - 1)]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(word() if rng.random() < 0.9 else word().upper() for _ in range(n))
    rows = [(i, text(rng.choice([0, 1, 5, 30, 30, 200]))) for i in range(docs)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [(7, text(20)), (7, text(20)), (None, rows[3][1]), (900, None)]
    items = [(i, text(rng.choice([1, 4, 15]))) for i in range(25)] + [(3, rows[3][1]), (3, "w1 w1 w2"), (None, "w5"), (50, "absent"), (51, ""), (52, None)]
    return rows, items


@pytest.mark.parametrize(("block", "buckets"), [(L.BLOCK_ITEMS, L.BUCKETS), (4, 8)])
def test_equals_brute_force(spark, monkeypatch, block, buckets):
    """Few buckets make poor bounds and must change nothing."""
    rows, items = corpus(block)
    monkeypatch.setattr(L.query_blocks, "__defaults__", (block, L.BLOCK_BYTES))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(L.rank_documents(crowded(df), crowded(it), buckets=buckets), "*") == brute(rows, items)


def test_bounds_hold_and_prune():
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(3000)]
    docs = [Counter(w.encode() for w in rng.choices(vocabulary, k=rng.randint(20, 120))) for _ in range(600)]
    queries = L.build_queries(0, [(i, " ".join([*rng.choices(vocabulary, k=10), *list(docs[i])[0].decode().split()]).encode()) for i in range(20)])
    df = Counter(t for d in docs for t in d)
    statistics = L.Statistics(len(docs), sum(d.total() for d in docs), L.np.array([df[t] for t in queries.vocabulary], L.np.int64))
    plan = L.build_plan(queries, statistics, L.BUCKETS, 10)
    impacts = L.Impacts(plan, docs)
    bounds = (impacts.sketch @ plan.columns) * (1 + L.SLACK)
    exact = L.np.stack([impacts.exact[:, t] @ (plan.weights[t] * n) for t, n in zip(queries.terms, queries.times, strict=True)], axis=1)
    assert (bounds >= exact).all()
    best = L.Best(plan)
    best.offer(list(range(len(docs))), impacts)
    assert best.scored < 0.35 * exact.size
    for q, found in enumerate(best.rows):
        assert [-s for s, _, _ in found] == sorted(exact[:, q][exact[:, q] > 0].tolist(), reverse=True)[:10]


def test_long_texts_and_items(spark):
    docs = [(1, "common " * 50_000 + "rare"), (2, "common"), (3, "other"), (4, "rare rare")]
    items = [(1, "rare " * 20_000), (2, "common other")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(L.rank_documents(df, spark.createDataFrame(items, "item_id long, text string")), "*") == brute(docs, items)


def test_odd_rows(spark):
    docs = [(r[0], r[1]) for r in odd_rows()]
    items = [(i, t) for i, (_, t) in enumerate(docs)]
    it = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(L.rank_documents(crowded(odd_docs(spark)), it), "*") == brute(docs, items)
    for frame, given in ((empty_docs(spark), it), (odd_docs(spark), it.limit(0))):
        got = L.rank_documents(frame, given)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    got = L.rank_documents(df, spark.createDataFrame([("i", "y")], "item_id string, text string")).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == [("i", 1, "a"), ("i", 2, "b"), ("i", 3, None)]
