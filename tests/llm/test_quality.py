from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from confluo.llm import quality
from confluo.llm.trees import fit_boosted, fit_lasso
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows, prose, rows_of


@pytest.fixture(scope="module")
def corpus(spark):
    rng, rows, labels = random.Random(5), [], []
    for i in range(600):
        good = rng.random() < 0.6
        text = prose(i, rng.randint(20, 80))
        rows.append((i, text if good else " ".join(w + rng.choice(["***", "$$$"]) for w in text.split()), "en", "s", 0))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    model = quality.train(docs, labels)
    assert model.rules
    got = quality.score(docs, model).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.97


def test_column_equals_numpy(corpus):
    docs, labels = corpus
    model = quality.train(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    rows = docs.collect()
    expected = model.predict(np.array([quality.statistics(r.text.encode()) for r in rows]))
    assert max(abs(got[r.doc_id] - e) for r, e in zip(rows, expected, strict=True)) < 1e-9


def test_held_out_labels_do_not_matter(corpus):
    docs, labels = corpus
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, labels) == quality.train(docs, flipped)


def test_odd_rows(spark, corpus):
    model = quality.train(*corpus)
    out = quality.score(crowded(odd_docs(spark)), model)
    got = out.collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (4, 5)}) == 1
    assert quality.score(empty_docs(spark), model).count() == 0
    kept = quality.keep_good(crowded(odd_docs(spark)), model)
    assert kept.columns == crowded(odd_docs(spark)).columns
    assert rows_of(kept, "doc_id") == sorted([(r.doc_id,) for r in got if r.predicted], key=repr)


def test_without_labels(spark):
    none = spark.createDataFrame([(None, None), (1, None), (2, 7)], "doc_id long, quality int")
    model = quality.train(odd_docs(spark), none)
    assert {r.score for r in quality.score(odd_docs(spark), model).collect()} == {0.5}
    one = quality.train(odd_docs(spark), spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, quality int"))
    assert {r.score > 0.9 for r in quality.score(odd_docs(spark), one).collect()} == {True}


def test_lasso_drops_noise():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (400, 20)).astype(float)
    y = (x[:, 3] > 0).astype(float)
    _, w = fit_lasso(x, y, 0.02)
    assert w[3] > 1 and np.abs(np.delete(w, 3)).max() < 0.1
    assert (fit_boosted(x, y).predict(x) > 0.5).astype(float).tolist() == y.tolist()


def test_samples_go_by_rows(spark):
    """One id on 3,000 rows: no more rows than the sample learn, and some do."""
    docs = [(7, prose(i, 10 + i % 9)) for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    both = spark.createDataFrame([(7, 1)] * 20 + [(7, 0), (8, 1), (None, 1)], "doc_id long, quality int")
    assert quality.train(frame, both, sample=5).bias is not None
    for sample in (5, 50):
        seen = []
        original = quality.fit_rules
        try:
            quality.fit_rules = lambda x, y, *a: seen.append((len(x), set(y.tolist()))) or original(x, y, *a)
            quality.train(frame, both, sample=sample)
        finally:
            quality.fit_rules = original
        assert seen and 0 < seen[0][0] <= sample
    # Labels of documents that are not there take no place in the sample.
    absent = spark.createDataFrame([(i, 1) for i in range(100, 5000)] + [(7, 1)], "doc_id long, quality int")
    assert quality.score(frame.limit(3), quality.train(frame, absent, sample=3)).where("score > 0.9").count() == 3


def plain_statistics(text):
    """The statistics again, character by character."""
    data = text.encode()
    words = [w for w in "".join(c if c not in " \t\n\r\x0b\x0c" else " " for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    low = sum(c.islower() and c.isascii() for c in text) + sum(len(c.encode()) for c in text if not c.isascii())
    up, digits, spaces = (sum(c.isascii() and f(c) for c in text) for f in (str.isupper, str.isdigit, str.isspace))
    ends, bars, marks = sum(c in ".,;:?" for c in text), text.count("|"), text.count("!")
    other = len(data) - low - up - digits - spaces - ends - bars - marks
    n, w = max(len(data), 1), max(len(words), 1)
    return [
        np.log1p(len(data)), np.log1p(len(words)), (len(data) - spaces) / w, up / n, digits / n, other / w, ends / w, bars / w, marks / w, np.log1p(len(lines)),
        len(words) / max(len(lines), 1), len(set(words)) / w, len(set(lines)) / max(len(lines), 1), (low + up) / n,
    ]


def test_scores_equal_rules_over_plain_statistics(spark, corpus):
    """Every score again from the model's rules and statistics taken another way."""
    model = quality.train(*corpus)
    texts = [r[1] or "" for r in odd_rows()] + ["A|b!! 1,2\n\n x\ty\n x", "É\u00a0x", "\x1c \x7f", "same\nsame\nsame"]
    got = {r.doc_id: r.score for r in quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        x = plain_statistics(text)
        assert np.allclose(x, quality.statistics(text.encode())), text
        total = model.bias + sum(w for w, rule in model.rules if all(x[f] <= t if at_most else x[f] > t for f, at_most, t in rule))
        assert abs(got[i] - 1 / (1 + np.exp(-total))) < 1e-9
