"""Query texts as users write them, turned into leaf rows by column expressions.

A text is a row of items between blanks: a word, a pattern with ``*`` or ``?``, a phrase in quotes (``"a b"~4`` for the reach), a range in
brackets (``[2013 TO 20160510]``) or a group in parentheses. ``field:`` before an item says where to look, ``^2`` after it weighs it.
``AND`` makes the items on both its sides required, ``NOT`` excludes the item after it, ``OR`` is what blanks mean anyway. Items of a
group take the group's field and weight; a required group is met by any one of them.

Any number of texts is one job: items are cut out with regular expressions and looked at one by one. A text with anything
else in it fails, as do ``AND``, ``OR`` and ``NOT`` inside groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.functions.text import clean_query
from confluo.operators.leaves import QueryTable, leaf_table
from confluo.schemas import KEYWORD_FIELDS

_FIELD = r"(?:([A-Za-z_]+):)?"
_WORD = r"[^\s()\"\[\]:^~]+"
_PHRASE = r"\"[^\"]*\"(?:~\d+)?"
_RANGE = r"\[[^\[\]]*\]"
_GROUP = r"\([^()]*\)"
_WEIGHT = r"(?:\^(\d+(?:\.\d+)?))?"
_ITEM = rf"{_FIELD}({_PHRASE}|{_RANGE}|{_GROUP}|{_WORD}){_WEIGHT}(?=\s|$)"
_INNER = rf"({_PHRASE}|{_WORD}){_WEIGHT}(?=\s|$)"
_JOINTS = ("AND", "OR", "NOT")


def _fail(test: Column, message: str, text: Column, otherwise: Column) -> Column:
    """``otherwise``, or an error that shows the text where the test holds."""
    error = F.raise_error(F.concat(F.lit(message + ": "), F.coalesce(text, F.lit("")))).cast("string")
    return F.when(test, error).otherwise(otherwise)


def _items(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _left_over(text: Column, pattern: str) -> Column:
    """True where something besides items and blanks stands in the text."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, pattern, " "), r"\s+", " ")) != ""


def text_leaves(queries: DataFrame) -> DataFrame:
    """``queries(query_id, text)`` as leaf rows: ``query_id, clause, grouped, role, op, field, value, lo, hi, slop, boost``."""
    text = clean_query(F.col("text"))
    rows = queries.select(F.col("query_id").cast("string").alias("query_id"), text.alias("text"))
    rows = rows.withColumn("text", _fail(_left_over(F.col("text"), _ITEM), "unreadable query text", F.col("text"), F.col("text")))
    cut = rows.select("query_id", "text", _items(F.col("text"), _ITEM).alias("items"))
    # Each item with its neighbours; joints only say how the others count.
    cut = cut.select("query_id", "text", "items", F.posexplode("items").alias("clause", "item")).where(~F.col("item").isin(*_JOINTS))
    before = F.when(F.col("clause") > 0, F.get("items", F.col("clause") - 1))
    after = F.get("items", F.col("clause") + 1)
    role = F.when(before == "NOT", "must_not").when((before == "AND") | (after == "AND"), "must").otherwise("should")
    item = cut.select(
        "query_id",
        "text",
        "clause",
        F.coalesce(role, F.lit("should")).alias("role"),
        F.nullif(F.regexp_extract("item", _ITEM, 1), F.lit("")).alias("field"),
        F.regexp_extract("item", _ITEM, 2).alias("body"),
        F.coalesce(F.nullif(F.regexp_extract("item", _ITEM, 3), F.lit("")).cast("double"), F.lit(1.0)).alias("weight"),
    )
    is_group = F.col("body").startswith("(")
    inside = F.substring("body", F.lit(2), F.length("body") - 2)
    inner = _items(F.when(is_group, inside).otherwise(""), _INNER)
    bad = is_group & (_left_over(inside, _INNER) | F.arrays_overlap(inner, F.array(*[F.lit(j) for j in _JOINTS])))
    parts = item.withColumn("body", _fail(bad, "unreadable group", F.col("text"), F.col("body"))).withColumn(
        "part", F.explode(F.when(is_group, inner).otherwise(F.array("body")))
    )
    own_weight = F.when(is_group, F.nullif(F.regexp_extract("part", _INNER, 2), F.lit("")).cast("double"))
    parts = parts.withColumn("boost", F.col("weight") * F.coalesce(own_weight, F.lit(1.0))).withColumn(
        "part", F.when(is_group, F.regexp_extract("part", _INNER, 1)).otherwise(F.col("part"))
    )
    quoted, ranged = F.col("part").startswith('"'), F.col("part").startswith("[")
    ends = F.split(F.substring("part", F.lit(2), F.length("part") - 2), r"(?i)\s+TO\s+")
    op = (
        F.when(ranged | (F.col("field") == "date"), "date")
        .when(F.col("field").isin(*KEYWORD_FIELDS), "keyword")
        .when(quoted, "phrase")
        .when(F.col("part").rlike(r"[*?]"), "wildcard")
        .otherwise("words")
    )
    phrase = F.regexp_extract("part", r'^"([^"]*)"', 1)
    bound = lambda i: F.when(ranged, F.nullif(F.trim(F.get(ends, F.lit(i))), F.lit(""))).when(F.col("field") == "date", F.col("part"))
    malformed = ranged & (F.size(ends) != 2)
    return parts.select(
        "query_id",
        "clause",
        (is_group & F.col("role").isin("must", "must_not")).alias("grouped"),
        "role",
        _fail(malformed, "a range needs two ends", F.col("text"), op).alias("op"),
        F.when(ranged & F.col("field").isNull(), "date").otherwise(F.col("field")).alias("field"),
        F.when(ranged | (F.col("field") == "date"), None).when(quoted, phrase).otherwise(F.col("part")).alias("value"),
        bound(0).alias("lo"),
        bound(1).alias("hi"),
        F.coalesce(F.nullif(F.regexp_extract("part", r'~(\d+)$', 1), F.lit("")).cast("int"), F.lit(1)).alias("slop"),
        "boost",
    )


def query_texts(queries: DataFrame) -> QueryTable:
    """A query table from texts of any number."""
    return leaf_table(text_leaves(queries))
