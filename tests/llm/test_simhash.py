from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from confluo.llm import simhash as S
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows, prose, rows_of


def fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_roots(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    for seed in range(40):
        text = prose(seed, seed) + random.Random(seed).choice(["", " Ünï", "\x1c\x85 a", "\tA\rB\n"])
        assert int.from_bytes(S.fingerprint(text.encode())) == fingerprint(text)
    assert S.fingerprint(b" \n") == bytes(8)


@pytest.mark.parametrize("crowd", [0, 2, 32])
def test_components_of_fingerprints_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(S, "CROWD", crowd)
    rng = random.Random(crowd)
    prints = set()
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            prints.add(x)
            x ^= rng.choice([1 << rng.randrange(64), (1 << rng.randrange(64)) | (1 << rng.randrange(64)), 1 << 63])
            if rng.random() < 0.3:
                x ^= 0b111 << rng.randrange(60)
    center = rng.getrandbits(64)
    prints |= {center ^ 1 << i for i in range(64)} | {0, (1 << 64) - 1}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = S.links(frame)
    assert all(a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2 for a, b in links.collect())
    found = dict(S.components(links).collect())
    roots = component_roots([x & ((1 << 64) - 1) for x in signed])
    assert [found.get(x, x) for x in signed] == [signed[r] for r in roots]


def test_long_chain(spark):
    nodes = list(range(0, 400))
    random.Random(0).shuffle(nodes)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:], strict=False)), "a long, b long")
    assert {r.root for r in S.components(edges).collect()} == {0}
    assert S.components(edges.limit(0)).count() == 0


def test_documents(spark):
    docs = crowded(odd_docs(spark))
    got = S.near_duplicates(docs).collect()
    rows = odd_rows()
    assert len(got) == len(rows)
    prints = [fingerprint(r[1]) for r in rows]
    assert sorted((r.doc_id, r.fingerprint) for r in got if r.doc_id) == sorted((r[0], f"{p:016x}") for r, p in zip(rows, prints, strict=True) if r[0])
    least = {}
    for r, root in zip(rows, component_roots(prints), strict=True):
        least[root] = min(x for x in (least.get(root), r[0]) if x is not None) if (least.get(root), r[0]) != (None, None) else None
    expected = sorted(((r[0], least[root]) for r, root in zip(rows, component_roots(prints), strict=True)), key=repr)
    assert rows_of(S.near_duplicates(docs), "doc_id", "component_id") == expected
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == sorted({(c,) for _, c in expected if c is not None} | {(None,)}, key=repr)
    assert S.near_duplicates(empty_docs(spark)).count() == 0 and S.deduplicate(empty_docs(spark)).count() == 0


def test_large_group_of_copies_keeps_the_index_small(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(prose(1, 30)).alias("text"))
    assert {r.component_id for r in S.near_duplicates(docs).collect()} == {0}


def test_clashing_and_missing_ids(spark):
    a, b, c, d, e = (prose(50 + i, 40) for i in range(5))
    rows = [(3, a, "x"), (7, a, "x"), (7, b, "x"), (8, b, "x"), (9, c, "x"), (9, d, "x"), (None, e, "x"), (None, e, "x"), (None, e, "x"), (None, a, "x"), (2, d, "x")]
    docs = crowded(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4))
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == sorted([(3, a), (7, b), (9, c), (2, d), (None, e)], key=repr)


def test_rows_of_one_id_and_fingerprint(spark):
    text = prose(60, 40)
    rows = [(1, text, "x"), (1, text.upper(), "y"), (1, text, "z")]
    one = [S.deduplicate(spark.createDataFrame(r, "doc_id long, text string, source string").repartition(n)).collect() for n, r in ((1, rows), (3, rows[::-1]))]
    assert one[0] == one[1] and len(one[0]) == 1
