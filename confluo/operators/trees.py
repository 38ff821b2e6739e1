"""Query texts with groups inside groups, turned into leaf rows by column expressions.

The items of :mod:`confluo.operators.texts`, with groups to any depth: ``(a AND b) OR c``, ``name:(portal AND 2)``, ``summary:(x (y AND z)^2)``. Inside a
group, as outside, ``AND`` makes the items on both its sides required, ``NOT`` excludes the item after it and ``OR`` is what blanks mean; ``a ANDNOT b``
requires a and excludes b, ``a ANDMAYBE b`` requires a and lets b add score, ``a REQUIRE b`` requires both and takes the score of a. A group is met as
a whole or not at all, and only then adds its score. An item looks into its own field, else into that of the innermost group that names one;
weights of all groups around it multiply. A group of nothing but exclusions matches nothing.

A word before a colon that names no field is a word like others, and so are stray signs: ``half-life 2: episode one`` is four words. What cannot be
read is a parenthesis or quote without its partner, a range without two ends or in braces, and a period that does not exist. Such a text
does not stop the others: it has no leaves (or, if asked, those of its plain words), and :func:`text_errors` names it.

A text is cut into tokens by one regular expression; a fold over the tokens gives each its group and place, and everything else follows from
arrays inside the row, so any number of texts is one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.functions.text import clean_query
from confluo.operators.leaves import QueryTable, leaf_table, possible_period
from confluo.schemas import DATE_FIELD, KEYWORD_FIELDS, TEXT_FIELDS
from confluo.session import store_step

_FIELD = rf"(?:({'|'.join([*TEXT_FIELDS, *KEYWORD_FIELDS, DATE_FIELD])}):)?"
_WEIGHT = r"(?:\^(\d+(?:\.\d+)?)(?=[\s()]|$))?"
_PHRASE = rf"{_FIELD}\"([^\"]*)\"(?:~(\d+))?{_WEIGHT}"
_RANGE = rf"{_FIELD}([\[{{][^\[\]{{}}]*[\]}}]){_WEIGHT}"
_OPEN = rf"{_FIELD}\("
_CLOSE = rf"\){_WEIGHT}"
_WORD = rf"{_FIELD}([^\s()\"]+?){_WEIGHT}(?=[\s()\"]|$)"
# A quote that opens no phrase is a token of its own; a colon with nothing behind it is left to the word before it.
_TOKEN = "|".join((_PHRASE, _RANGE, _OPEN, _CLOSE, _WORD, "\""))
_JOINTS = ("AND", "OR", "NOT", "ANDNOT", "ANDMAYBE", "REQUIRE")

_KIND = rf"""CASE WHEN tok IN ({", ".join(f"'{j}'" for j in _JOINTS)}) THEN 'joint' WHEN tok = '"' THEN 'stray' WHEN tok LIKE '%(' AND tok NOT LIKE '%"%' THEN 'open'
  WHEN tok LIKE ')%' THEN 'close' ELSE 'item' END"""

# The fold: ``path`` holds the places of the groups that are open, ``next`` the next free place in each of them and in the whole text.
_PLACED = "array<struct<tok: string, kind: string, path: array<int>, n: int>>"
_STATE = f"struct<path: array<int>, next: array<int>, placed: {_PLACED}, bad: boolean>"
_START = f"cast(named_struct('path', array(), 'next', array(0), 'placed', array(), 'bad', false) AS {_STATE})"
_ADDED = "concat(s.placed, array(named_struct('tok', t.tok, 'kind', t.kind, 'path', %s, 'n', %s)))"
_HERE = "element_at(s.next, -1)"
_STEP = f"""CASE WHEN t.kind = 'open' THEN named_struct('path', concat(s.path, array({_HERE})),
    'next', concat(slice(s.next, 1, size(s.next) - 1), array({_HERE} + 1, 0)), 'placed', {_ADDED % ('s.path', _HERE)}, 'bad', s.bad)
  WHEN t.kind = 'close' AND size(s.path) = 0 THEN named_struct('path', s.path, 'next', s.next, 'placed', s.placed, 'bad', true)
  WHEN t.kind = 'close' THEN named_struct('path', slice(s.path, 1, size(s.path) - 1), 'next', slice(s.next, 1, size(s.next) - 1),
    'placed', {_ADDED % ('s.path', '-1')}, 'bad', s.bad)
  ELSE named_struct('path', s.path, 'next', concat(slice(s.next, 1, size(s.next) - 1), array({_HERE} + 1)), 'placed', {_ADDED % ('s.path', _HERE)}, 'bad', s.bad) END"""


def _fold() -> Column:
    tokens = f"transform(tokens, tok -> named_struct('tok', tok, 'kind', {_KIND}))"
    return F.expr(f"aggregate({tokens}, {_START}, (s, t) -> cast({_STEP} AS {_STATE}))")


def _role(path: str, n: str) -> str:
    """Role of the item or group at a place, from the words before and after it."""
    near = f"element_at(filter(placed, o -> o.path = {path} AND o.n = {n} %s 1 AND o.kind = 'joint').tok, 1)"
    before, after = f"coalesce(try_{near % '-'}, '')", f"coalesce(try_{near % '+'}, '')"
    return f"""CASE WHEN {before} IN ('NOT', 'ANDNOT') THEN 'must_not' WHEN {before} = 'ANDMAYBE' THEN 'maybe' WHEN {before} = 'REQUIRE' THEN 'filter'
  WHEN {before} = 'AND' OR {after} IN ('AND', 'ANDNOT', 'ANDMAYBE', 'REQUIRE') THEN 'must' ELSE 'should' END"""


def _part(pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract("tok", f"^(?:{pattern})$", group), F.lit(""))


def _parsed(queries: DataFrame) -> DataFrame:
    """``query_id, text, error`` and the placed tokens of every text."""
    rows = queries.select(F.col("query_id").cast("string").alias("query_id"), clean_query(F.coalesce(F.col("text"), F.lit(""))).alias("text"))
    cut = rows.withColumn("tokens", F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0)))
    folded = cut.select("query_id", "text", _fold().alias("s")).select("query_id", "text", "s.*")
    items = "filter(placed, o -> o.kind = 'item')"
    own = "regexp_extract(x.tok, '^([a-z]+):', 1)"
    dated = f"{own} = 'date' OR ({own} = '' AND {_group_field('x.path')} = 'date')"
    found = folded.withColumn("ranges", F.expr(f"transform(filter({items}, x -> x.tok RLIKE '^([a-z]+:)?[\\\\[{{]'), x -> x.tok)")).withColumn(
        "periods", F.expr(f"transform(filter({items}, x -> ({dated}) AND x.tok NOT RLIKE '^([a-z]+:)?[\\\\[{{]'), x -> regexp_extract(x.tok, '^(?:date:)?\"?([^\"^]*)', 1))")
    )
    ends = lambda r, i: F.nullif(F.regexp_extract(r, _ENDS, i), F.lit(""))
    periods = F.concat("periods", F.transform("ranges", lambda r: ends(r, 1)), F.transform("ranges", lambda r: ends(r, 2)))
    error = (
        F.when(F.exists("placed", lambda o: o["kind"] == "stray"), "a quote has no partner")
        .when(F.col("bad") | (F.size("path") > 0), "a parenthesis has no partner")
        .when(F.exists("ranges", lambda r: ~r.rlike(r"^(date:)?[\[{]")), "only dates have ranges")
        .when(F.exists("ranges", lambda r: r.rlike(r"[{}]")), "a range stands in braces")
        .when(F.exists("ranges", lambda r: ~r.rlike(_ENDS)), "a range needs two ends")
        .when(F.exists(periods, lambda p: ~possible_period(p)), "no year, month or day")
    )
    return found.select("query_id", "text", error.alias("error"), "placed")


def _group_field(path: str) -> str:
    """The field of the innermost group around a place that names one; empty if none does."""
    named = f"filter(placed, o -> o.kind = 'open' AND o.tok LIKE '%:(' AND slice({path}, 1, size(o.path) + 1) = concat(o.path, array(o.n)))"
    return f"coalesce(regexp_extract(try_element_at({named}, -1).tok, '^([a-z]+):', 1), '')"


# Both ends of a range; one of them may be left out.
_ENDS = r"^(?:[a-z]+:)?\[\s*(\S*?)\s*\b(?i:to)\b\s*(\S*?)\s*\](?:\^[0-9.]+)?$"


def text_errors(queries: DataFrame) -> DataFrame:
    """``query_id, text, error`` of the texts that cannot be read."""
    return _parsed(queries).where(F.col("error").isNotNull()).select("query_id", "text", "error")


def tree_leaves(queries: DataFrame, unreadable: str = "skip") -> DataFrame:
    """``queries(query_id, text)`` as leaf rows ``query_id, at, clause, role, op, field, value, lo, hi, slop, boost``.

    ``unreadable`` texts: ``skip`` leaves them out, ``words`` takes their plain words, ``fail`` raises.
    """
    if unreadable not in ("skip", "words", "fail"):
        raise ValueError(f"unreadable texts can be left out, read as words or fail, not {unreadable!r}")
    parsed = _parsed(queries)
    if unreadable == "fail":
        shown = F.raise_error(F.concat(F.lit("unreadable query text ("), F.col("error"), F.lit("): "), F.col("text"))).cast("string")
        parsed = parsed.withColumn("error", F.when(F.col("error").isNotNull(), shown))
    leaves = _leaves(parsed.where(F.col("error").isNull()))
    if unreadable != "words":
        return leaves
    # The analyser drops whatever is no letter or digit.
    plain = parsed.where(F.col("error").isNotNull()).withColumnRenamed("text", "value")
    fixed = {"at": "''", "clause": "0", "role": "'should'", "op": "'words'", "field": "cast(NULL AS string)", "lo": "cast(NULL AS string)", "hi": "cast(NULL AS string)"}
    rest = {**fixed, "slop": "1", "boost": "1D"}
    return leaves.unionByName(plain.selectExpr("query_id", "value", *[f"{v} AS {c}" for c, v in rest.items()]))


def _leaves(parsed: DataFrame) -> DataFrame:
    items = parsed.select("query_id", "placed", F.explode(F.expr("filter(placed, o -> o.kind = 'item')")).alias("x")).select(
        "query_id", "placed", F.col("x.tok").alias("tok"), F.col("x.path").alias("path"), F.col("x.n").alias("n")
    )
    around = "filter(placed, o -> o.kind = 'open' AND slice(path, 1, size(o.path) + 1) = concat(o.path, array(o.n)))"
    weights = "filter(placed, o -> o.kind = 'close' AND o.tok LIKE '%^%' AND slice(path, 1, size(o.path)) = o.path)"
    steps = f"transform({around}, g -> concat(g.n, ':', {_role('g.path', 'g.n')}))"
    placed = items.select(
        "query_id",
        "tok",
        F.expr(f"array_join({steps}, '/')").alias("at"),
        F.col("n").alias("clause"),
        F.expr(_role("path", "n")).alias("role"),
        F.nullif(F.expr(_group_field("path")), F.lit("")).alias("group_field"),
        F.expr(f"aggregate({weights}, 1D, (w, o) -> w * cast(regexp_extract(o.tok, '\\\\^([0-9.]+)$', 1) AS double))").alias("group_weight"),
    )
    quoted, ranged = F.col("tok").rlike(f"^(?:{_PHRASE})$"), F.col("tok").rlike(f"^(?:{_RANGE})$")

    def pick(phrase: int, range_: int, word: int) -> Column:
        return F.when(quoted, _part(_PHRASE, phrase)).when(ranged, _part(_RANGE, range_)).otherwise(_part(_WORD, word))

    read = placed.select(
        "query_id", "at", "clause", "role",
        F.coalesce(pick(1, 1, 1), F.col("group_field")).alias("field"),
        F.coalesce(pick(2, 2, 2), F.lit("")).alias("body"),
        F.when(quoted, _part(_PHRASE, 3)).try_cast("int").alias("reach"),
        (F.coalesce(pick(4, 3, 3).cast("double"), F.lit(1.0)) * F.col("group_weight")).alias("boost"),
        quoted.alias("quoted"), ranged.alias("ranged"),
    )
    dated = F.col("ranged") | F.coalesce(F.col("field") == DATE_FIELD, F.lit(False))
    end = lambda i: F.when(F.col("ranged"), F.nullif(F.regexp_extract("body", _ENDS, i), F.lit(""))).when(dated, F.col("body"))
    op = (
        F.when(dated, "date")
        .when(F.col("field").isin(*KEYWORD_FIELDS), "keyword")
        .when(F.col("quoted"), "phrase")
        .when(F.col("body").rlike(r"[*?]"), "wildcard")
        .otherwise("words")
    )
    return read.select(
        "query_id", "at", "clause", "role", op.alias("op"), F.when(dated, DATE_FIELD).otherwise(F.col("field")).alias("field"),
        F.when(~dated, F.col("body")).alias("value"), end(1).alias("lo"), end(2).alias("hi"), F.greatest(F.coalesce("reach", F.lit(1)), F.lit(1)).alias("slop"), "boost",
    )


def query_trees(queries: DataFrame, unreadable: str = "skip") -> QueryTable:
    """A query table from texts of any number, with nested groups; the leaves are stored, as every operator reads them."""
    return leaf_table(store_step(tree_leaves(queries, unreadable), "leaves"))
