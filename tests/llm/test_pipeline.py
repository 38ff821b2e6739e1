from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from confluo.llm import packing, pii, quality
from tests.llm.cases import prose
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_simhash import component_roots, fingerprint
from tests.llm.test_tokens_and_packing import check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root, rng = tmp_path_factory.mktemp("tables"), random.Random(3)
    items = [(i, prose(9000 + i, 25)) for i in range(5)]
    rows = []
    for i in range(300):
        text = prose(i, rng.randint(15, 60))
        kind = i % 6
        if kind == 0:
            text = " ".join(w + "###" for w in text.split())
        elif kind == 1 and i > 6:
            text = rows[i - 6][1]
        elif kind == 2:
            text = f"{text} {items[i % 5][1]}"
        elif kind == 3:
            text = f"{text} joe.{i}@mail.example.com and 10.0.0.{i % 250} done"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    labels = [(i, int(i % 6 != 0), 0) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    stages = dict(P.STAGES)

    def step(name, frame):
        out = stages[name](spark, frame, sf_dir)
        assert out.columns == COLUMNS
        return spark.createDataFrame(out.collect(), frame.schema)

    kept = step("quality", docs)
    scores = model.predict(np.array([quality.statistics((r[1] or "").encode()) for r in rows]))
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= quality.THRESHOLD]
    assert sorted(map(tuple, kept.collect())) == sorted(rows) and not any("###" in (r[1] or "") for r in rows)

    kept = step("near_duplicates", kept)
    rows = sorted(rows)
    roots = component_roots([fingerprint(r[1]) for r in rows])
    rows = [r for i, r in enumerate(rows) if roots[i] == i]
    assert sorted(map(tuple, kept.collect())) == rows

    kept = step("decontamination", kept)
    bad = {r[0] for r in contaminated([(r[0], r[1]) for r in rows], items) if r[5]}
    assert bad
    rows = [r for r in rows if r[0] not in bad]
    assert sorted(map(tuple, kept.collect())) == rows

    finder = pii.train(kept)
    masked = step("personal_data", kept)
    texts = {r[0]: r[1] for r in masked.collect()}
    assert texts == {r[0]: r[1] and pii.redact_text(r[1], finder.spans(r[1])[1]) for r in rows}
    assert any("[EMAIL]" in (t or "") for t in texts.values()) and not any("@" in (t or "") for t in texts.values())

    library = Tokenizer.from_file(packing.default_vocabulary())
    expected = {i: [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] for i, t in texts.items()}
    check_packing(stages["packing"](spark, masked, sf_dir).collect(), expected, packing.SEQUENCE)
    check_packing(P.run(spark, sf_dir).collect(), expected, packing.SEQUENCE)


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
