from __future__ import annotations

import random
import zlib

from confluo.llm import language
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows

PARTS = {
    "en": "the of and tion ing er ed wh th ou ly re st ha".split(),
    "de": "der und sch ung ein keit ich zu ver ge heit ß ü".split(),
    "fr": "le la eau eux ment que oi ai tre é è ç des".split(),
}


def corpus(n=300):
    rng, rows = random.Random(2), []
    for i in range(n):
        lang = rng.choice(list(PARTS))
        text = " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60)))
        rows.append((i, text, lang if i % 10 else None, "s", 0))
    return rows


def test_held_out_accuracy(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in language.identify(docs, language.train(docs)).collect()}
    held = [(i, lang) for i, _, lang, *_ in corpus() if zlib.crc32(str(i).encode()) % 4 == 2 and lang]
    assert all(found[i].held_out for i, _ in held)
    assert sum(found[i].lang_pred == lang for i, lang in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.createDataFrame(corpus(60), "doc_id long, text string, lang string, source string, n_chars long")
    held = "crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2"
    changed = docs.selectExpr("doc_id", f"IF({held}, 'zzz', text) AS text", f"IF({held}, 'xx', lang) AS lang")
    assert language.train(docs) == language.train(changed)


def test_sampling_keeps_every_language(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    assert set(language.train(docs, per_language=3)) == set(PARTS)


def test_odd_rows(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    learned = language.train(docs)
    got = language.identify(crowded(odd_docs(spark)), learned).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        if r.doc_id in (4, 5, 6, 12):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in PARTS
    assert language.identify(empty_docs(spark), learned).count() == 0
    assert language.train(empty_docs(spark)) == {}
    assert {r.lang_pred for r in language.identify(odd_docs(spark), {}).collect()} == {"und"}


def test_mixed_up_labels_are_left_out():
    rng = random.Random(3)
    text = lambda lang: " ".join("".join(rng.choice(PARTS[lang]) for _ in range(2)) for _ in range(40))
    sample = [("en", text("en")) for _ in range(60)] + [("de", text("de")) for _ in range(60)]
    mixed = [("de", text("en")) for _ in range(4)]
    assert language.build(sample + mixed)["de"].decode().split().count("the") <= language._join(sample + mixed)["de"].decode().split().count("the")
    assert not any(t.encode() in language.build(sample + mixed)["de"] for _, t in mixed)


def test_blocks_of_languages_equal_one_pass(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    whole = language.train(docs)
    expected = sorted(map(tuple, language.identify(docs, whole).collect()))
    monkeypatch.setattr(language, "LANGUAGES", 2)
    learned = language.train(docs)
    assert learned == whole and set(learned) == set(PARTS)
    assert sorted(map(tuple, language.identify(docs, learned).collect())) == expected


def test_texts_without_a_letter(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    texts = ["½ ²", "①", "Ⅷ", "١٢", "\u0301", "12 _ 3", "\U0001f600", "a", "ß 12", "e\u0301"]
    got = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), language.train(docs)).collect()
    assert [r.lang_pred == "und" for r in sorted(got)] == [True] * 7 + [False] * 3


def test_equals_plain_compression(spark):
    """The whole rule again with the compression library alone."""
    import math

    import regex
    import zstandard

    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    learned = language.train(docs)
    coders = {x: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=1), level=6, write_checksum=False, write_content_size=False) for x, d in learned.items()}
    found = {r.doc_id: r for r in language.identify(docs, learned).collect()}
    for i, text, *_ in corpus():
        data = (" " + " ".join(regex.findall(r"[\p{L}\p{M}]+", text.lower())) + " ").encode()
        sizes = sorted((sum(len(c.compress(data[k : k + 2048])) for k in range(0, len(data), 2048)), x) for x, c in coders.items())
        margin = 1 - sizes[0][0] / sizes[1][0]
        assert (found[i].lang_pred, found[i].rejected) == (sizes[0][1], margin < 0.02) and abs(found[i].score - (1 - math.exp(-10 * margin))) < 1e-12


def test_languages_of_copies_are_not_lost(spark):
    rows = [(1, "the one text of this language", "xx")] * 3000 + [(i, f"other text number {i} of another", "yy") for i in range(3000)]
    learned = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=2)
    assert set(learned) == {"xx", "yy"}
