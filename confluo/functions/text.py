"""Column functions for text: analysers, query clean-up, tag removal, snippets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words joined by inner dots ("v1.2"). Possessive, so that a token of very many dotted parts needs no deep recursion.
TOKEN_PATTERN = r"[\p{L}\p{N}_]++(?:\.[\p{L}\p{N}_]++)*+"

# A short English stop list, alphabetical.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "for", "from", "have", "if", "in", "is", "it", "may",
    "not", "of", "on", "or", "tbd", "that", "the", "this", "to", "us", "we", "when", "will", "with", "yet", "you",
    "your",
)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _tokens_sql(column: str) -> str:
    return f"regexp_extract_all(lower(coalesce({column}, '')), {_literal(TOKEN_PATTERN)}, 0)"


def raw_tokens(column: str) -> Column:
    """Lower-cased tokens of a text column in text order, nothing dropped; null text has none."""
    return F.expr(_tokens_sql(column))


def analyse(column: str, min_length: int = 1, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Tokens of at least ``min_length`` characters that are no stop words. One expression, parsed once."""
    tests = [f"length(t) >= {min_length}"] if min_length > 1 else []
    if stop_words:
        tests.append(f"t NOT IN ({', '.join(_literal(w) for w in stop_words)})")
    tokens = _tokens_sql(column)
    return F.expr(f"filter({tokens}, t -> {' AND '.join(tests)})" if tests else tokens)


def keep_numbers(column: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Analyser of names: single characters survive, so the "2" of a sequel can be searched."""
    return analyse(column, 1, stop_words)


def standard(column: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Analyser of long texts: tokens of one character are dropped."""
    return analyse(column, 2, stop_words)


# Shortest token each text field keeps.
MIN_LENGTH = {"name": 1, "storyline": 2, "summary": 2}


def analyser_of(field: str):
    return keep_numbers if MIN_LENGTH.get(field, 2) == 1 else standard


def clean_query(text: Column) -> Column:
    """Trim, then drop a trailing first-part number: first parts are catalogued without one."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.regexp_replace(trimmed, r"\s+[1I]$", "")


def strip_tags(html: Column) -> Column:
    """Delete everything between angle brackets on one line."""
    return F.regexp_replace(html, r"<([^\n]*?)>", "")


def snippet(text: Column, length: int = 150) -> Column:
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)
