from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from confluo.llm import spelling as S
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows, rows_of

UPPER = {i: i + 32 for i in range(65, 91)}


def near(a, b):
    """One inserted, deleted or replaced letter, by trying all of them."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def brute(docs):
    counts = brute_counts(docs)
    near_ = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, vs in near_.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near_[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def corpus(seed, letters="abcé", words=60, docs=40):
    """Short alphabets make many near words, letter swaps and repeated letters."""
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(words)]
    out = []
    for i in range(docs):
        body = []
        for _ in range(120):
            w = base[min(int(rng.expovariate(0.15)), words - 1)]
            if rng.random() < 0.1:
                j = rng.randrange(len(w))
                w = w[:j] + rng.choice(["", rng.choice(letters)]) + w[j + rng.randint(0, 1) :]
            body.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i % 30, rng.choice([" ", ", ", "-", "1"]).join(body)))
    return out


@pytest.mark.parametrize("chunk", [S.CHUNK_WORDS, 3])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK_WORDS", chunk)
    docs = corpus(chunk) + [(None, "wordlike wordlike wordlik"), (5, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows_of(S.spelling_variants(df), "*") == brute(docs)


def test_ways_of_forms(spark):
    """A chain of forms: every word is ten times as frequent as the one before."""
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb"]
    words = spark.createDataFrame([(w, 3 * 10**i) for i, w in enumerate(chain)], "word string, n long")
    near_ = {r.word: (r.n_near, r.best) for r in S.near_words(words).collect()}
    assert near_ == {chain[0]: (1, chain[1]), chain[1]: (2, chain[2]), chain[2]: (2, chain[3]), chain[3]: (1, chain[2])}
    docs = [(0, " ".join(w for i, w in enumerate(chain[:3]) for _ in range(3 * 10**i)))]
    got = rows_of(S.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")), "*")
    assert got == brute(docs) and any(r[1] and r[1] != r[2] for r in got)


def test_blocks_meet_all_near_words():
    """Every edit leads into the same block or one beside it, in exactly one direction."""
    rng = random.Random(3)
    for _ in range(300):
        word = bytes(rng.choice(b"abcdefg\xe9\xfc") for _ in range(rng.randint(1, 9)))
        i, letter = rng.randrange(len(word)), bytes([rng.choice(b"abcdefg\xe9\xfc")])
        for other in (word[:i] + word[i + 1 :], word[:i] + letter + word[i + 1 :], word[:i] + letter + word[i:]):
            a, b = S.block_key(word), S.block_key(other)
            assert (a == b) + (a in S.lower_neighbours(b)) + (b in S.lower_neighbours(a)) == 1


def test_product_and_verification():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) for _ in range(150)})
    a, b = words[::2], words[1::2]
    chunks = [S.Chunk("\n".join(w).encode(), np.ones(len(w), np.int64).tobytes()) for w in (a, b)]
    rows, columns = S.close_pairs(*chunks, False)
    squares = lambda x, y: sum((x.count(c) - y.count(c)) ** 2 for c in "abc")
    assert set(zip(rows, columns, strict=True)) == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if squares(x, y) <= 2}
    keep = S.one_edit(chunks[0], rows, chunks[1], columns)
    assert set(zip(rows[keep], columns[keep], strict=True)) == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if near(x, y)}


def test_very_long_words(spark):
    long = "ab" * 30_000
    docs = [(1, f"{long} {long} {long}c {long}c {long[1:]}d {long[1:]}d")]
    got = rows_of(S.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")), "*")
    counts = brute_counts(docs)
    assert {r[0] for r in got} == set(counts) and {r[0]: r[4] for r in got} == {w: sum(near(w, v) for v in counts) for w in counts}


def test_odd_rows(spark):
    docs = [(r[0], r[1]) for r in odd_rows()]
    assert rows_of(S.spelling_variants(crowded(odd_docs(spark))), "*") == brute(docs)
    empty = S.spelling_variants(empty_docs(spark))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0
    once = spark.createDataFrame([(1, "nothing repeated")], "doc_id long, text string")
    assert S.spelling_variants(once).count() == 0


def test_a_crowded_block_is_many_chunks(spark, monkeypatch):
    """All words have the same letters, so all are in one block."""
    monkeypatch.setattr(S, "CHUNK_WORDS", 16)
    words = spark.range(5000).select(F.format_string("%s", F.translate(F.lpad(F.conv(F.col("id").cast("string"), 10, 4), 7, "0"), "0123", "agms")).alias("word"), F.lit(2).cast("long").alias("n"))
    assert words.select("word").distinct().count() == 5000
    chunks = S.cut_chunks(words)
    assert chunks.select("key").distinct().count() == 1 and chunks.count() > 300
    got = {r.word: r.n_near for r in S.near_words(words).collect()}
    known = {r.word for r in words.collect()}
    for w in sorted(known)[::500]:
        assert got.get(w, 0) == sum(w[:i] + c + w[i + 1 :] in known for i in range(7) for c in "agms" if c != w[i])
