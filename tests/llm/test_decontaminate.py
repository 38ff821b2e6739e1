from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from confluo.llm import decontaminate as D
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    """A missing id counts as one item that the digest does not show."""
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, body in items:
            b = words(body)
            n = min(len(b), 13)
            for i in range(max(1, len(b) - 12) if b else 0):
                window = b[i : i + n]
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == window:
                        hit.update(range(j, j + n))
                        ids.add(item)
        out.append((doc_id, len(w), len(hit), len(ids), D.item_digest([i for i in ids if i is not None]), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["é", "Ä", "X9"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 13, 14, 30]))) for i in range(6)] + [(99, None), (None, "w1 w2")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(25)]
    docs += [(100 + i, (text(rng.randint(0, 20)) + " " + b + " " + text(rng.randint(0, 300))).upper()) for i, (_, b) in enumerate(items[:6])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_equals_brute_force(spark, block_bytes):
    docs, items = random_case(block_bytes)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    assert rows_of(D.contamination(d, b, block_bytes=block_bytes), "*") == expected
    kept = D.decontaminate(d, b, block_bytes=block_bytes)
    assert rows_of(kept, "doc_id") == [(r[0],) for r in expected if not r[5]]


def test_short_shards_change_nothing():
    docs, items = random_case(4)
    block = D.build_block([(i, b.encode()) for i, b in items if i is not None and b])
    texts = [t.encode() for _, t in docs]
    one = [(m.n_words, m.hits.tolist()) for m in D.scan(texts, block, 1 << 20)]
    assert one == [(m.n_words, m.hits.tolist()) for m in D.scan(texts, block, 50)]


def test_longest_matches(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(1, f"a b {passage} c"), (2, " ".join(passage.split()[5:25])), (3, "a b c")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(7, passage), (8, "z")], "item_id long, text string")
    assert rows_of(D.longest_matches(d, b), "*") == [(1, 2, 7, 0, 30), (2, 0, 7, 5, 20)]


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, odd_rows()[8][1]), (2, "end")], "item_id long, text string")
    docs = crowded(odd_docs(spark))
    expected = brute([(r[0], r[1]) for r in odd_rows()], [(1, odd_rows()[8][1]), (2, "end")])
    assert rows_of(D.contamination(docs, items), "*") == expected
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(expected) - sum(r[5] for r in expected)
    none = items.limit(0)
    assert D.decontaminate(docs, none).count() == docs.count()
    assert D.contamination(empty_docs(spark), items).count() == 0
    assert D.longest_matches(docs, none).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_items_without_id_hit(spark, block_bytes, tmp_path):
    import corpus_pipeline
    from confluo.llm.queries import QUERIES

    docs, items = random_case(block_bytes)
    items.append((None, "w3 w4"))
    schema = "doc_id long, text string"
    d = spark.createDataFrame(docs, schema)
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    assert expected != brute(docs, [x for x in items if x[0] is not None])
    assert rows_of(D.contamination(d, b, block_bytes=block_bytes), "*") == sorted(expected, key=repr)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    b.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert rows_of(QUERIES["op3_decontamination"](spark, str(tmp_path)), "*") == sorted(expected, key=repr)
    kept = corpus_pipeline.drop_contaminated(spark, d, str(tmp_path))
    assert rows_of(kept, "doc_id") == sorted([(r[0],) for r in expected if not r[5]], key=repr)
    assert {r.item_id for r in D.longest_matches(d, b).collect()} >= {None}


def test_text_ids(spark):
    docs, items = random_case(7)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    named = [(None if i is None else f"item {i}", t) for i, t in items]
    b = spark.createDataFrame(named, "item_id string, text string")
    for block_bytes in (1 << 20, 60):
        assert rows_of(D.contamination(d, b, block_bytes=block_bytes), "*") == brute(docs, named)
    assert {r.item_id for r in D.longest_matches(d, b).collect()} <= {n for n, _ in named}


def test_groups_count_all_columns_and_keep_every_batch(monkeypatch):
    wide = pa.RecordBatch.from_pydict({"text": ["a"] * 3, "extra": ["x" * (6 << 20)] * 3})
    assert [b.num_rows for b in D._grouped(iter([wide] * 3))] == [3, 3, 3]
    # Chunks that stay apart, as beyond 2 GB.
    small = pa.RecordBatch.from_pydict({"text": ["a", "b"]})

    class Apart:
        from_batches = staticmethod(lambda held: Apart())
        combine_chunks = lambda self: self
        to_batches = lambda self: [small, small]

    monkeypatch.setattr(D.pa, "Table", Apart)
    assert sum(b.num_rows for b in D._grouped(iter([small, small]))) == 4
