from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from confluo.llm import packing, tokens
from confluo.llm.bpe import PieceEncoder
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows, prose, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "the", " ", " ", "  ", "\n", "\n\n", "'re", "'r", "'ll", "'s", "é", "ß", "中文", "١٢", "12", "!!", "<|endoftext|>", "\t", "\xa0", " ", "x.y", "Ω",
    "\U0001f600", "ˈ", "\x1c", "\x85", "<|end", "don't",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(library):
    own = packing.Encoder(PATH)
    texts = odd_texts(1500) + [prose(i, 50) for i in range(40)]
    for warm in (False, True):
        if warm:
            own.pieces.warm([p for t in texts for p in own.vocabulary.cut(t)[::2]])
        for t in texts:
            assert np.frombuffer(own.encode(t), "<u4").tolist() == ids_of(library, t), t


def test_texts_encoded_together_equal_the_library(library, monkeypatch):
    """Groups of texts, and odd texts among plain ones, change nothing."""
    plain, odd = [prose(i, 50) for i in range(60)], odd_texts(600, 5)
    texts = [x for pair in zip(odd, plain * 10, strict=True) for x in pair] + ["", "a", "\n", "a\nb", " a", "a  b"]
    own = packing.Encoder(PATH)
    for chars in (1 << 20, 300):
        monkeypatch.setattr(packing, "GROUP_CHARS", chars)
        for some in (texts, texts[::-1], plain, odd, [], [""]):
            got = [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(some)]
            assert got == [ids_of(library, t) for t in some]


def test_a_small_store_changes_nothing(library):
    own = packing.Encoder(PATH)
    own.pieces = PieceEncoder(own._pieces, room=5)
    for t in [prose(i, 50) for i in range(30)]:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == ids_of(library, t)
    few = tokens.PrefixCounter(PATH, room=7)
    for t in [prose(i, 50) for i in range(30)]:
        few.pieces.warm([t])
        assert few.count(t) == len(ids_of(library, t))


def test_every_prefix_count_equals_the_library(library):
    own = tokens.PrefixCounter(PATH)
    for t in odd_texts(500, 9) + [prose(1, 40)]:
        counts = own.prefix_counts(t)
        assert counts == [len(ids_of(library, t[:i])) for i in range(len(t) + 1)], t
        assert own.count(t) == counts[-1]


def test_compatible_pairs_equal_the_rules():
    own, rng = tokens.PrefixCounter(PATH), random.Random(4)
    names, ranks = list(own.ages), own.vocabulary.ids

    def merge(data):
        parts = [data[i : i + 1] for i in range(len(data))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not found:
                return parts
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    for _ in range(4000):
        a, b = rng.choice(names), rng.choice(names[:3000])
        assert own.compatible(own.ages[a], own.ages[b]) == (merge(a + b) == [a, b]), (a, b)


def test_counts_and_budgets(spark, library):
    docs = crowded(odd_docs(spark))
    got = rows_of(tokens.token_counts(docs), "*")
    n = lambda t: len(ids_of(library, t))
    assert got == sorted([(r[0], len((r[1] or "").encode()), n(r[1]), n(r[1]) > 1024) for r in odd_rows()], key=repr)
    tables = tokens.prefix_tables(docs)
    for r in tokens.fit_budget(tables, 10).where("doc_id IN (1, 5, 7)").collect():
        text = next(t for i, t, *_ in odd_rows() if i == r.doc_id) or ""
        fitting = [i for i in range(len(text) + 1) if n(text[:i]) <= 10]
        assert r.cut == max(fitting) and r.n_tokens == n(text)
        assert tokens.PrefixCounter(PATH).truncate(text, 10) == max(fitting)
    assert tokens.token_counts(empty_docs(spark)).count() == 0


def check_packing(pieces, expected, size):
    """Every id in exactly one piece, sequences gapless and, but for the last, full."""
    by_row, sequences = {}, {}
    for p in pieces:
        by_row.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length > 0
    assert set(by_row) == set(expected)
    for key, parts in by_row.items():
        runs = b"".join(p.ids for p in sorted(parts, key=lambda p: (p.sequence_id, p.offset)))
        assert runs == b"".join(expected[key])
        assert {p.doc_tokens for p in parts} == {len(x) // 4 for x in expected[key]}
    assert sorted(sequences) == list(range(len(sequences)))
    for number, parts in sequences.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == size or number == len(sequences) - 1


@pytest.mark.parametrize("size", [2048, 64])
def test_pack(spark, library, size):
    docs = crowded(odd_docs(spark)).repartition(3)
    expected = {}
    for r in odd_rows():
        expected.setdefault(r[0], []).append(np.array(ids_of(library, r[1]) + [1], "<u4").tobytes())
    check_packing(packing.pack(docs, size=size).collect(), expected, size)


def test_pack_empty(spark):
    out = packing.pack(empty_docs(spark), keep_ids=False)
    assert out.count() == 0
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
