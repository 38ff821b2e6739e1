"""Query tables: one row per leaf, so that any number of queries runs as one job.

A query is a set of clauses; a clause is an OR of leaves and has a role:

* ``should``    adds score; decides membership only when nothing is required
* ``must``      required, adds score
* ``filter``    required, adds no score
* ``must_not``  excludes
* ``maybe``     adds score, never decides membership
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.functions.text import MIN_LENGTH, STOP_WORDS, analyse, clean_query, keep_numbers
from confluo.schemas import KEYWORD_FIELDS, TEXT_FIELDS

# Weights of unscoped words per field, and the extra weight of fields the user names.
FIELD_WEIGHTS = {"name": 6.0, "storyline": 1.0, "summary": 1.0}
SCOPE_BOOSTS = {"name": 40.0, "devs": 40.0, "date": 40.0, "genres": 40.0, "platforms": 40.0}

LEAF_CHARS = 64

ROLES = ("should", "must", "filter", "must_not", "maybe")
OPS = ("words", "phrase", "wildcard", "keyword", "date")

_ARROW = pa.schema(
    [
        ("query_id", pa.string()),
        ("clause", pa.int32()),
        ("grouped", pa.bool_()),
        ("role", pa.string()),
        ("op", pa.string()),
        ("field", pa.string()),
        ("value", pa.string()),
        ("lo", pa.string()),
        ("hi", pa.string()),
        ("slop", pa.int32()),
        ("boost", pa.float64()),
    ]
)


@dataclass(frozen=True)
class QueryTable:
    leaves: DataFrame
    ops: frozenset[str]
    boolean: bool
    scopes: frozenset[str | None]
    # Characters of all leaves where they are known without a job.
    known_chars: int | None = None
    # Levels of groups inside groups; leaves then have a column ``at``: ``<clause>:<role>`` of every group around them, from the outermost
    # on, with slashes between.
    depth: int = 0

    @cached_property
    def chars(self) -> int:
        """Characters of all leaves, a fixed share per leaf included: a count of the rows themselves, not an estimate."""
        if self.known_chars is not None:
            return self.known_chars
        row = self.leaves.agg(F.sum(F.length(F.coalesce("value", F.lit(""))) + LEAF_CHARS)).first()
        return int(row[0] or 0)

    def text_fields(self, weights: Mapping[str, float]) -> list[str]:
        """Text fields any leaf can look into; the others are not read."""
        named = set(self.scopes) | (set(weights) if None in self.scopes else set())
        return [f for f in TEXT_FIELDS if f in named]


def _leaf(op: str, value: str | None, field: str | None, boost: float, role: str, **more) -> dict:
    if role not in ROLES:
        raise ValueError(f"unknown role {role!r}")
    known = {"keyword": KEYWORD_FIELDS, "date": ("date",)}.get(op, (None, *TEXT_FIELDS))
    if field not in known:
        raise ValueError(f"{op} cannot look into {field!r}; fields are {', '.join(str(f) for f in known if f)}")
    if boost < 0:
        raise ValueError("a boost must not be negative")
    if more.get("slop", 1) < 1:
        raise ValueError("slop counts positions to the next word and is 1 at least")
    base = {"op": op, "value": value, "field": field, "boost": float(boost), "role": role, "lo": None, "hi": None, "slop": 1}
    return {**base, **more}


def words(text: str, field: str | None = None, boost: float = 1.0, role: str = "should") -> dict:
    """Every word of the text is a clause of its own."""
    return _leaf("words", text, field, boost, role)


def phrase(text: str, field: str | None = None, slop: int = 1, boost: float = 1.0, role: str = "should") -> dict:
    """Words in order, each at most ``slop`` positions after the one before."""
    return _leaf("phrase", text, field, boost, role, slop=slop)


def wildcard(pattern: str, field: str | None = None, boost: float = 1.0, role: str = "should") -> dict:
    """``*`` stands for any run of characters, ``?`` for one."""
    return _leaf("wildcard", pattern, field, boost, role)


def keyword(value: str, field: str, boost: float = 1.0, role: str = "should") -> dict:
    return _leaf("keyword", value, field, boost, role)


def date_range(lo: str | None, hi: str | None, field: str = "date", boost: float = 1.0, role: str = "should") -> dict:
    """Inclusive; a bound is a year, a month or a day (``2016``, ``201605``, ``2016-5``, ``2016-05-10``), ``None`` is open."""
    for bound in (lo, hi):
        if bound is not None:
            check_period(bound)
    return _leaf("date", None, field, boost, role, lo=lo, hi=hi)


def date_in(period: str, field: str = "date", boost: float = 1.0, role: str = "should") -> dict:
    """The whole period."""
    return date_range(period, period, field, boost, role)


def any_of(*leaves: dict, role: str = "must") -> list[dict]:
    """One clause made of several alternatives."""
    return [{**leaf, "role": role} for leaf in leaves]


def query_table(spark: SparkSession, queries: Mapping[str, Sequence[dict | list[dict]]]) -> QueryTable:
    """Literal queries as a local relation, whose exact size lets Catalyst choose the join."""
    if not queries:
        raise ValueError("there is no query")
    rows = []
    for query_id, clauses in queries.items():
        for number, clause in enumerate(clauses):
            grouped = isinstance(clause, list)
            for leaf in clause if grouped else [clause]:
                rows.append({"query_id": query_id, "clause": number, "grouped": grouped, **leaf})
    leaves = spark.createDataFrame(pa.Table.from_pylist(rows, schema=_ARROW))
    return QueryTable(
        leaves,
        frozenset(r["op"] for r in rows),
        any(r["role"] != "should" for r in rows),
        frozenset(r["field"] for r in rows),
        sum(len(r["value"] or "") + LEAF_CHARS for r in rows),
    )


def leaf_table(leaves: DataFrame) -> QueryTable:
    """Batch form for leaves of every kind: a table of any size with the columns of a leaf.

    Needed are ``query_id, clause, op, value``; missing columns take the defaults of the leaf functions. Operators, roles
    and fields are looked up in one job; wrong ones fail.
    """
    defaults = {"at": "''", "clause": "0", "grouped": "false", "role": "'should'", "field": "NULL", "lo": "NULL", "hi": "NULL", "slop": "1", "boost": "1.0"}
    kinds = {"clause": "int", "grouped": "boolean", "slop": "int", "boost": "double"}
    known = set(leaves.columns)
    nested = "at" in known
    columns = [(f"`{c}`" if c in known else defaults.get(c, "NULL"), kinds.get(c, "string"), c) for c in (*_ARROW.names, *(["at"] if nested else []))]
    rows = leaves.selectExpr(*[f"coalesce(cast({x} AS {kind}), cast({defaults.get(c, 'NULL')} AS {kind})) AS {c}" for x, kind, c in columns])
    # One row per kind of leaf, whatever the number of leaves.
    depth = F.max(F.when(F.col("at") == "", 0).otherwise(F.size(F.split("at", "/")))) if nested else F.lit(0)
    seen = rows.groupBy("op", "role", "field").agg(F.min("boost").alias("boost"), F.min("slop").alias("slop"), depth.alias("depth")).collect()
    if not seen:
        raise ValueError("there is no query")
    for r in seen:
        if r["op"] not in OPS:
            raise ValueError(f"unknown operator {r['op']!r}")
        _leaf(r["op"], None, r["field"], r["boost"], r["role"], slop=r["slop"])
    deepest = max(r["depth"] for r in seen)
    return QueryTable(
        rows if deepest else rows.drop("at"),
        frozenset(r["op"] for r in seen),
        deepest > 0 or any(r["role"] != "should" for r in seen),
        frozenset(r["field"] for r in seen),
        depth=deepest,
    )


def bag_of_words(queries: DataFrame, role: str = "should", field: str | None = None, boost: float = 1.0) -> QueryTable:
    """Batch form: ``queries(query_id, text)`` of any size, every text cleaned and searched word by word."""
    leaves = queries.select(
        F.col("query_id").cast("string").alias("query_id"),
        F.lit(0).alias("clause"),
        F.lit(False).alias("grouped"),
        F.lit(role).alias("role"),
        F.lit("words").alias("op"),
        F.lit(field).cast("string").alias("field"),
        clean_query(F.col("text")).alias("value"),
        F.lit(None).cast("string").alias("lo"),
        F.lit(None).cast("string").alias("hi"),
        F.lit(1).alias("slop"),
        F.lit(float(boost)).alias("boost"),
    )
    return QueryTable(leaves, frozenset(["words"]), role != "should", frozenset([field]))


def _lookup(weights: Mapping[str, float], key: Column, default: float) -> Column:
    result = F.lit(float(default))
    for name, weight in weights.items():
        result = F.when(key == name, F.lit(float(weight))).otherwise(result)
    return result


def scope_boost(leaves: DataFrame, boosts: Mapping[str, float] = SCOPE_BOOSTS) -> DataFrame:
    """A field the user names weighs more; words left unscoped keep their boost."""
    factor = F.when(F.col("field").isNull(), F.lit(1.0)).otherwise(_lookup(boosts, F.col("field"), 1.0))
    return leaves.withColumn("boost", F.col("boost") * factor)


def expand_fields(leaves: DataFrame, weights: Mapping[str, float] = FIELD_WEIGHTS) -> DataFrame:
    """Unscoped leaves look into every weighted field; a clause still counts once."""
    default = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(float(w)).alias("weight")) for f, w in weights.items()])
    own = F.array(F.struct(F.col("field").alias("field"), F.lit(1.0).alias("weight")))
    return (
        leaves.withColumn("target", F.explode(F.when(F.col("field").isNull(), default).otherwise(own)))
        .withColumn("field", F.col("target.field"))
        .withColumn("weight", F.col("boost") * F.col("target.weight"))
        .drop("target", "boost")
    )


def _analysed(value: str, field: Column, stop_words: Sequence[str]) -> Column:
    lengths = sorted(set(MIN_LENGTH.values()))
    result = analyse(value, lengths[-1], stop_words)
    for length in lengths[:-1]:
        named = [f for f, n in MIN_LENGTH.items() if n == length]
        result = F.when(field.isin(*named), analyse(value, length, stop_words)).otherwise(result)
    return result


def _like_pattern(pattern: Column) -> Column:
    escaped = F.regexp_replace(F.lower(pattern), r"([\\%_])", r"\\$1")
    return F.replace(F.replace(escaped, F.lit("*"), F.lit("%")), F.lit("?"), F.lit("_"))


# A period by its parts: year, year and month, or a day; with dashes, months and days may have one digit.
_PERIOD = r"^\s*(\d{4})(?:(\d\d)(\d\d)?|-(\d{1,2})(?:-(\d{1,2}))?)?\s*$"


def check_period(text: str) -> str:
    """The text itself if it names a year, a month or a day that exists; an error otherwise."""
    found = re.match(_PERIOD, text)
    try:
        year, month, day = (int(found[1]), int(found[2] or found[4] or 1), int(found[3] or found[5] or 1)) if found else (0, 0, 0)
        date(year, month, day)
    except ValueError:
        raise ValueError(f"no year, month or day: {text!r}") from None
    return text


def _period_part(text: Column, *groups: int) -> Column:
    parts = [F.nullif(F.regexp_extract(text, _PERIOD, g), F.lit("")) for g in groups]
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def _day_of(text: Column) -> Column:
    """First day of the period, NULL if it names none that exists."""
    month, day = (F.lpad(F.coalesce(_period_part(text, *g), F.lit("01")), 2, "0") for g in ((2, 4), (3, 5)))
    return F.try_to_timestamp(F.concat_ws("-", _period_part(text, 1), month, day), F.lit("yyyy-MM-dd"))


def period_start(text: Column) -> Column:
    """First instant of the period; NULL only for NULL. Anything that is no period fails."""
    start = _day_of(text)
    bad = F.raise_error(F.concat(F.lit("no year, month or day: "), text)).cast("timestamp")
    return F.when(text.isNull(), F.lit(None).cast("timestamp")).when(start.isNull(), bad).otherwise(start)


def possible_period(text: Column) -> Column:
    """True for NULL and for a year, month or day that exists."""
    return text.isNull() | _day_of(text).isNotNull()


def period_end(text: Column) -> Column:
    """First instant after the period."""
    start = period_start(text)
    return (
        F.when(_period_part(text, 3, 5).isNotNull(), start + F.expr("INTERVAL 1 DAY"))
        .when(_period_part(text, 2, 4).isNotNull(), start + F.expr("INTERVAL 1 MONTH"))
        .otherwise(start + F.expr("INTERVAL 1 YEAR"))
    )


_ATOM = ["query_id", "clause", "sub", "role", "field", "weight", "term", "idx", "n_terms", "slop", "lo", "hi"]


def _atom_columns(rows: DataFrame, **own: Column) -> DataFrame:
    fixed = {
        "sub": F.lit(0),
        "idx": F.lit(0),
        "n_terms": F.lit(1),
        "lo": F.lit(None).cast("timestamp"),
        "hi": F.lit(None).cast("timestamp"),
    }
    return rows.withColumns({**fixed, **own}).select(*_ATOM, *(["at"] if "at" in rows.columns else []))


def atoms(
    table: QueryTable,
    weights: Mapping[str, float] = FIELD_WEIGHTS,
    boosts: Mapping[str, float] = SCOPE_BOOSTS,
    stop_words: Sequence[str] = STOP_WORDS,
) -> dict[str, DataFrame]:
    """Leaves after boosting, field expansion and analysis: per operator, one row per term to look up."""
    boosted = scope_boost(table.leaves, boosts)

    def leaves_of(op: str) -> DataFrame:
        return boosted.where(F.col("op") == op)

    result = {}
    if "words" in table.ops:
        # Clauses are numbered before fields are expanded: a word is one clause in all its fields.
        tokens = leaves_of("words").select(
            "*", F.posexplode(keep_numbers("value", stop_words)).alias("word", "term")
        )
        rows = expand_fields(tokens, weights).where(F.length("term") >= _lookup(MIN_LENGTH, F.col("field"), 2.0))
        result["words"] = _atom_columns(rows, sub=F.when(F.col("grouped"), F.lit(0)).otherwise(F.col("word")))
    if "phrase" in table.ops:
        rows = expand_fields(leaves_of("phrase"), weights)
        rows = rows.withColumn("tokens", _analysed("value", F.col("field"), stop_words))
        rows = rows.select("*", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "term"))
        result["phrase"] = _atom_columns(rows, idx=F.col("place"), n_terms=F.col("size"))
    if "wildcard" in table.ops:
        rows = expand_fields(leaves_of("wildcard"), weights)
        result["wildcard"] = _atom_columns(rows, term=_like_pattern(F.col("value")))
    if "keyword" in table.ops:
        rows = expand_fields(leaves_of("keyword"), weights)
        result["keyword"] = _atom_columns(rows, term=F.col("value"))
    if "date" in table.ops:
        rows = expand_fields(leaves_of("date"), weights)
        result["date"] = _atom_columns(
            rows, term=F.lit(None).cast("string"), lo=period_start(F.col("lo")), hi=period_end(F.col("hi"))
        )
    return result


def required_clauses(rows: Mapping[str, DataFrame]) -> DataFrame:
    """Per query, and per group where groups nest, the number of clauses a hit has to meet, counted after analysis (stop words form no clause)."""
    nested = "at" in next(iter(rows.values())).columns
    group = ["query_id", "at"] if nested else ["query_id"]
    needed = F.col("role").isin("must", "filter")
    every = None
    for r in rows.values():
        keyed = [r.where(needed).select(*group, "clause", "sub")]
        if nested:
            keyed.append(_groups_around(r).where(needed).select(*group, "clause", "sub"))
        for part in keyed:
            every = part if every is None else every.union(part)
    return every.distinct().groupBy(*group).agg(F.count(F.lit(1)).alias("n_required"))


def _groups_around(rows: DataFrame) -> DataFrame:
    """Every group around a leaf as a clause of the group around that."""
    steps = F.split("at", "/")
    outer = rows.where(F.col("at") != "").select("query_id", steps.alias("steps"), F.posexplode(steps).alias("level", "step"))
    return outer.select(
        "query_id",
        F.array_join(F.slice("steps", F.lit(1), F.col("level")), "/").alias("at"),
        F.split_part("step", F.lit(":"), F.lit(1)).cast("int").alias("clause"),
        F.lit(0).alias("sub"),
        F.split_part("step", F.lit(":"), F.lit(2)).alias("role"),
    )
