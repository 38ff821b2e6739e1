"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees are boosted on statistics of a bounded sample of labelled texts; every path from a root is a conjunctive rule (Friedman and
Popescu 2008). A lasso logistic regression weighs the rules and drops most. What is left is compiled into one Spark column
expression, so scoring is part of the plan: statistics of the whole text come from one pass over its bytes, the rules are comparisons.

The sample holds at most ``SAMPLE`` labelled rows outside the held-out fold: those of the ids with the smallest hash, and of these, where ids
are repeated, the rows with the smallest hash. Labels, language, source and id are no inputs.

Defined results: a NULL text scores like the empty text; equal label rows count once, documents with both labels once with each; rows with equal ids are scored
one by one; without labels of both kinds every document scores the share of label 1, or 0.5 without any; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import Batches, byte_texts, fresh, in_fold, pick, sample_distinct, small_batches, with_columns
from confluo.llm.trees import Condition, fit_boosted, fit_lasso, sigmoid

FOLDS, HELD_OUT = 5, 0
SAMPLE = 20_000
THRESHOLD = 0.3
PENALTY = 0.002

STATISTICS = (
    "chars", "words", "word_length", "upper", "digits", "symbols", "ends", "bars", "marks", "lines", "line_words", "new_words", "new_lines",
    "letters",
)

# Kinds of bytes: 0 lower-case or non-ASCII, 1 upper-case, 2 digit, 3 white space, 4 sentence end or comma, 5 bar, 6 exclamation, 7 other.
_KIND = np.zeros(256, np.uint8)
for _b in range(128):
    _c = chr(_b)
    _KIND[_b] = (
        0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c.isspace() else 4 if _c in ".,;:?" else 5 if _c == "|" else 6 if _c == "!" else 7
    )


def statistics(text: bytes) -> list[float]:
    """Statistics of a whole UTF-8 text, in the order of ``STATISTICS``."""
    n = len(text)
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=8)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    some, w = max(n, 1), max(len(words), 1)
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        (n - int(kinds[3])) / w,
        kinds[1] / some,
        kinds[2] / some,
        kinds[7] / w,
        kinds[4] / w,
        kinds[5] / w,
        kinds[6] / w,
        float(np.log1p(len(lines))),
        len(words) / max(len(lines), 1),
        len(set(words)) / w,
        len(set(lines)) / max(len(lines), 1),
        (kinds[0] + kinds[1]) / some,
    ]


def with_statistics(docs: DataFrame, text: str = "text", drop_text: bool = True) -> tuple[DataFrame, str]:
    """The frame with an array column of statistics; returns its name too."""
    small_batches(docs.sparkSession)
    (name,) = fresh(docs, "statistics")
    fields = [f for f in docs.schema if not (drop_text and f.name == text)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{name}` array<double>"])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = [statistics(t) for t in byte_texts(batch.column(batch.schema.get_field_index(text)))]
            yield with_columns(batch, [text] if drop_text else [], **{name: pa.array(rows, pa.list_(pa.float64()))})

    return docs.mapInArrow(run, schema), name


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def column(self, stats: Column) -> Column:
        """The score as a column expression over the array of statistics."""
        total = F.lit(self.bias)
        for weight, rule in self.rules:
            test = None
            for feature, at_most, threshold in rule:
                one = stats[feature] <= threshold if at_most else stats[feature] > threshold
                test = one if test is None else test & one
            total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.bias)
        for weight, rule in self.rules:
            raw += weight * holds(rule, x)
        return sigmoid(raw)


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for feature, at_most, threshold in rule:
        out &= x[:, feature] <= threshold if at_most else x[:, feature] > threshold
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, rounds: int = 30, depth: int = 3, penalty: float = PENALTY) -> RuleModel:
    """Rules from boosted trees, weighed by the lasso."""
    if not len(y):
        return RuleModel(0.0, ())
    model = fit_boosted(x, y, rounds, depth)
    seen: dict[bytes, tuple[Condition, ...]] = {}
    for tree in model.trees:
        for path in tree.paths():
            inside = holds(path, x)
            if 0.005 < inside.mean() < 0.995:
                seen.setdefault(inside.tobytes(), path)
    if not seen:
        return RuleModel(model.base, ())
    rules = list(seen.values())
    bias, weights = fit_lasso(np.stack([holds(r, x) for r in rules], axis=1).astype(float), y, penalty)
    return RuleModel(float(bias), tuple((float(w), r) for w, r in zip(weights, rules, strict=True) if w))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """Fit on at most ``sample`` labelled documents outside the held-out fold."""
    marks = pick(labels, doc_id, label).toDF("id_", "label").where("id_ IS NOT NULL AND label IS NOT NULL AND label IN (0, 1)")
    given = pick(docs, doc_id, text).toDF("doc_id", "text")
    known = marks.where(~in_fold(F.col("id_"), FOLDS, HELD_OUT)).join(given.select(F.col("doc_id").alias("id_")), "id_", "left_semi").distinct()
    chosen = known.withColumn("h", F.xxhash64("id_")).join(F.broadcast(sample_distinct(known, F.col("id_"), sample)), "h", "left_semi")
    # At most ``sample`` ids with two labels each.
    rows = given.join(F.broadcast(chosen.select("id_", "label")), F.col("doc_id") == F.col("id_"))
    stats, name = with_statistics(rows.select("doc_id", "text", "label", F.xxhash64("doc_id", "label", "text").alias("h")))
    # Rows of numbers; ids may be repeated, so they are counted here.
    got = stats.select("doc_id", "label", "h", name).orderBy("h").limit(sample).toPandas().sort_values(["doc_id", "label", "h"])
    if got.empty:
        return RuleModel(0.0, ())
    return fit_rules(np.stack(got[name].to_numpy()), got["label"].to_numpy(float))


def score(docs: DataFrame, model: RuleModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    stats, name = with_statistics(pick(docs, doc_id, text).toDF("doc_id", "text"))
    scored = stats.select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), model.column(F.col(name)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """The documents the model does not reject, with the columns they came with."""
    stats, name = with_statistics(docs, text, drop_text=False)
    return stats.where(model.column(F.col(f"`{name}`")) >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
