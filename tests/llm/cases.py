"""Small inputs every operator has to stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHES = ["row", "h", "shard", "slot", "score", "statistics", "hits", "items", "N_Words", "redacted", "fp", "part", "place", "ids", "label", "id_"]

SYLLABLES = "an er the on re in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty, blank and long texts, copies, and a row repeated whole."""
    copy = prose(1, 60)
    return [
        (1, copy, "en", "a", len(copy)),
        (2, copy, "en", "a", len(copy)),
        (3, copy + " end", None, "a", None),
        (4, "", "en", None, 0),
        (5, None, None, None, None),
        (6, " \n\t ", "de", "b", 4),
        (7, "Ünïcödé 漢字 \U0001f600 |!?", "fr", "b", 20),
        (8, prose(2, 6000), "es", "b", 1),
        (9, prose(3, 40), "de", "b", 1),
        (9, prose(3, 40), "de", "b", 1),
        (None, prose(4, 30), "en", "c", 1),
        (10, "mail a.b@c.example.org or 10.0.0.1, +1 (555) 555-0100 4111111111111111", "en", "c", 1),
        (11, "x", "en", "c", 1),
        (12, "12 34", "en", "c", 5),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def crowded(df):
    """The same with columns whose names an operator may want."""
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES])


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
