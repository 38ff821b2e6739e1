"""Ranked retrieval: leaves against search tables, boolean roles, scores, ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from confluo.functions.scoring import idf, rounded, tf_part
from confluo.functions.text import STOP_WORDS
from confluo.operators import tables as tb
from confluo.operators.leaves import FIELD_WEIGHTS, SCOPE_BOOSTS, QueryTable, atoms, required_clauses
from confluo.schemas import TEXT_FIELDS
from confluo.session import cut_lineage, store_step

# A leaf and its place in the query; ``at`` names the nested groups it stands in, where there are any.
_LEAF_KEY = ["query_id", "clause", "sub", "role"]


def _leaf_key(rows: DataFrame) -> list[str]:
    return [*_LEAF_KEY, "at"] if "at" in rows.columns else _LEAF_KEY


# What query rows may take in an executor, and what one character of query text can grow into: a word needs two characters, and
# a word becomes a row of so many bytes per text field and source.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 160


def fits(table: QueryTable, sources: int) -> bool:
    """True if all rows derived from the query table are surely small: a bound from the count of its characters."""
    return table.chars * len(TEXT_FIELDS) * max(sources, 1) * ROW_BYTES // 2 <= BROADCAST_BYTES


def small_side(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast only where the caller has checked the size of the query table the rows derive from."""
    return F.broadcast(df) if small else df


def weighted_terms(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Query terms with their per-source statistics; at most one row per atom and source."""
    # Field statistics hold one row per registered source and text field, whatever the size of the data.
    per_field = F.broadcast(tb.field_stats(stats).drop("total_len"))
    counted = rows.join(tb.term_stats(stats), ["field", "term"]).join(per_field, ["source", "field"])
    return counted.withColumn("idf", idf(F.col("n_docs"), F.col("df"))).drop("n_docs", "df")


def _bm25(weight: Column) -> Column:
    return weight * F.col("idf") * tf_part(F.col("tf"), F.col("len"), F.col("avg_len"))


def _term_hits(rows: DataFrame, postings: DataFrame, stats: DataFrame, small: bool) -> DataFrame:
    weighted = small_side(weighted_terms(rows, stats), small)
    found = postings.select("source", "field", "term", "id", "entity_id", "len", "tf")
    return found.join(weighted, ["source", "field", "term"]).withColumn("score", _bm25(F.col("weight")))


def _follows(acc: Column, part: Column, slop: Column) -> Column:
    """Positions of ``part`` within ``slop`` after one of ``acc``, however long the reach is."""
    return F.filter(part, lambda p: F.exists(acc, lambda y: (p > y) & (p <= y + slop)))


def _phrase_hits(rows: DataFrame, postings: DataFrame, stats: DataFrame, small: bool) -> DataFrame:
    found = postings.join(small_side(weighted_terms(rows, stats), small), ["source", "field", "term"])
    # A group is one phrase in one field of one document: as many rows as the phrase has words.
    grouped = found.groupBy(*_leaf_key(rows), "source", "id", "entity_id", "field", "n_terms", "slop", "weight").agg(
        F.array_sort(F.collect_list(F.struct("idx", "positions"))).alias("parts"),
        F.sum(_bm25(F.col("weight"))).alias("score"),
    )
    parts = F.transform("parts", lambda p: p["positions"])
    chain = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.element_at(parts, 1),
        lambda acc, p: _follows(acc, p, F.col("slop")),
    )
    complete = grouped.where(F.size("parts") == F.col("n_terms"))
    return complete.where(F.size(chain) > 0)


def expand_wildcards(rows: DataFrame, grams: DataFrame, small: bool) -> DataFrame:
    """Terms of the dictionary every pattern stands for.

    A pattern is cut into the grams its literal parts hold for sure; a term that has all of them is compared with the pattern itself. Patterns
    without a literal character have no gram and are compared with all terms of their field; there are only as many different ones of
    them as lengths.
    """
    keyed = rows.withColumnRenamed("term", "pattern").withColumn("grams", tb.pattern_grams("pattern"))
    needs = keyed.select("field", "pattern", "grams").distinct()
    asked = needs.select("field", "pattern", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    met = grams.join(small_side(asked, small), ["field", "gram"]).groupBy("field", "pattern", "n", "term").agg(F.count(F.lit(1)).alias("met"))
    some = met.where(F.col("met") == F.col("n")).select("field", "pattern", "term")
    bare = needs.where(F.size("grams") == 0).select("field", "pattern")
    known = grams.where(F.col("gram").startswith(tb.EDGE)).select("field", "term")
    every = known.join(small_side(bare, small), "field").select("field", "pattern", "term")
    fitting = some.unionByName(every).where(F.expr("term LIKE pattern"))
    return fitting.join(small_side(keyed.drop("grams"), small), ["field", "pattern"]).drop("pattern")


def _wildcard_hits(rows: DataFrame, tables, fields: Sequence[str], small: bool) -> DataFrame:
    expanded = store_step(expand_wildcards(rows, tables.grams(fields), small), "expanded")
    # All expansions are one leaf: a document counts once per field.
    return (
        tables.presence(fields, expanded.select("field", "term"))
        .join(expanded, ["field", "term"])
        .select(*_leaf_key(rows), "source", "id", "entity_id", "field", "weight")
        .distinct()
        .withColumn("score", F.col("weight"))
    )


def _keyword_hits(rows: DataFrame, tables, small: bool) -> DataFrame:
    found = tables.keywords().join(small_side(rows, small), ["field", "term"])
    return found.withColumn("score", F.col("weight"))


def _date_hits(rows: DataFrame, tables, small: bool) -> DataFrame:
    """Inclusive ranges through an equi-join on the year; ranges are cut to the years that occur, open ends among them.

    Stored tables know their years by name, and only the years that the ranges meet are read: one number per year is asked first. Elsewhere
    the first and last year are a part of the same query.
    """
    known = tables.date_years()
    if known is None:
        occurring = tables.dates()
        first, last = occurring.agg(F.min("year")).scalar(), occurring.agg(F.max("year")).scalar()
    else:
        first, last = (F.lit(y).cast("int") for y in ((known[0], known[-1]) if known else (None, None)))
    start, end = F.greatest(F.coalesce(F.year("lo"), first), first), F.least(F.coalesce(F.year("hi"), last), last)
    keyed = rows.withColumn("start", start).withColumn("end", end).withColumn("year", F.explode(F.expr("CASE WHEN start <= end THEN sequence(start, end) END")))
    keyed = keyed.drop("start", "end")
    dated = tables.dates()
    if known is not None:
        asked = {r["year"] for r in keyed.select("year").distinct().collect()}
        dated = tables.dates([y for y in known if y in asked])
    inside = (F.col("lo").isNull() | (F.col("date") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("date") < F.col("hi")))
    return dated.join(small_side(keyed, small), "year").where(inside).withColumn("score", F.col("weight"))


def leaf_hits(rows: Mapping[str, DataFrame], tables, fields: Sequence[str], small: bool) -> DataFrame:
    """Score of every (leaf, field, document) that matches."""
    keep = [*_leaf_key(next(iter(rows.values()))), "source", "id", "entity_id", "score"]
    parts = []
    texts = [rows[op] for op in ("words", "phrase") if op in rows]
    if texts:
        terms = texts[0].select("field", "term")
        for more in texts[1:]:
            terms = terms.union(more.select("field", "term"))
        postings, stats = tables.lookup(fields, terms, positions="phrase" in rows, small=small)
        if "words" in rows:
            parts.append(_term_hits(rows["words"], postings, stats, small))
        if "phrase" in rows:
            parts.append(_phrase_hits(rows["phrase"], postings, stats, small))
    if "wildcard" in rows:
        parts.append(_wildcard_hits(rows["wildcard"], tables, fields, small))
    if "keyword" in rows:
        parts.append(_keyword_hits(rows["keyword"], tables, small))
    if "date" in rows:
        parts.append(_date_hits(rows["date"], tables, small))
    # Joins on these keys would add the same filters one by one; stated here, every reader of the hits shares one plan.
    # Documents without an entity are found as well.
    known = F.col("query_id").isNotNull() & F.col("source").isNotNull() & F.col("id").isNotNull()
    parts = [p.where(known).select(*keep) for p in parts]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def retrieve(
    tables,
    table: QueryTable,
    weights: Mapping[str, float] = FIELD_WEIGHTS,
    boosts: Mapping[str, float] = SCOPE_BOOSTS,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Hits ``(query_id, source, id, entity_id, score)`` of every query, unranked and complete."""
    small = fits(table, len(tables.sources))
    rows = atoms(table, weights, boosts, stop_words)
    found = leaf_hits(rows, tables, table.text_fields(weights), small)
    doc = ["query_id", "source", "id", "entity_id"]
    if not table.boolean:
        return found.groupBy(*doc).agg(F.sum("score").alias("score"))
    # One row per clause first, so that clauses are counted and not the fields or terms that met them.
    key = _leaf_key(found)
    level = found.groupBy(*doc, *key[1:]).agg(F.sum("score").alias("score"))
    needed = small_side(required_clauses(rows), small)
    if not table.depth:
        return _combine(level, needed, doc).select(*doc, "score")
    # Groups from the innermost level outwards: what matches a group is one clause of the group around it. Each level reads its own
    # leaves and the groups of the level below.
    level, groups = store_step(level, "clauses"), None
    for depth in range(table.depth, -1, -1):
        here = level.where((F.col("at") != "") & (F.size(F.split("at", "/")) == depth) if depth else F.col("at") == "")
        groups = _combine(here if groups is None else here.unionByName(groups), needed, [*doc, "at"])
        if depth:
            own, outer = F.element_at(F.split("at", "/"), -1), F.regexp_replace("at", "/?[^/]*$", "")
            groups = groups.select(
                *doc, F.split_part(own, F.lit(":"), F.lit(1)).cast("int").alias("clause"), F.lit(0).alias("sub"),
                F.split_part(own, F.lit(":"), F.lit(2)).alias("role"), outer.alias("at"), "score",
            )
    return groups.select(*doc, "score")


def _combine(clauses: DataFrame, needed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Documents that match a group by the roles of its clauses, with the sum of the scoring ones."""
    scoring = F.col("role").isin("should", "must", "maybe")
    combined = clauses.groupBy(*group).agg(
        F.sum(F.when(scoring, F.col("score")).otherwise(F.lit(0.0))).alias("score"),
        F.count_if(F.col("role").isin("must", "filter")).alias("n_met"),
        F.max(F.col("role") == "must_not").alias("excluded"),
        F.max(F.col("role") == "should").alias("wanted"),
    )
    joined = combined.join(needed, [c for c in ("query_id", "at") if c in group], "left")
    n_required = F.coalesce(F.col("n_required"), F.lit(0))
    member = (F.col("n_met") == n_required) & ((n_required > 0) | F.col("wanted")) & ~F.col("excluded")
    return joined.where(member)


def best_order(tie: str = "id") -> list[Column]:
    return [rounded(F.col("score")).desc(), F.col(tie).asc()]


def top_k(hits: DataFrame, k: int, by: Sequence[str] = ("query_id",), ties: Sequence[str] = ("source", "id")) -> DataFrame:
    """Best ``k`` rows per group; each task drops all but ``k`` rows of a group before the shuffle."""
    order = [rounded(F.col("score")).desc(), *[F.col(t).asc() for t in ties]]
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def full_ranking(hits: DataFrame, by: Sequence[str] = ("query_id", "source"), ties: Sequence[str] = ("id",)) -> DataFrame:
    """Complete ranking of groups of any size, without gathering a group in one task.

    Rows are range-partitioned in rank order and stored once; a row's rank is its place inside its partition plus the
    rows the group has in earlier partitions. Only one count per (partition, group) is gathered.
    """
    spark = hits.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    group = [F.col(c).asc() for c in by]
    order = [*group, F.col("neg").asc(), *[F.col(t).asc() for t in ties]]
    ordered = hits.withColumn("neg", -rounded(F.col("score"))).repartitionByRange(n, *order).sortWithinPartitions(*order)
    stored = cut_lineage(
        ordered.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
    )
    counts = stored.groupBy("part", *by).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    return (
        stored.join(offsets, ["part", *by])
        .withColumn("rank", F.col("before") + F.col("place") - F.col("first_place") + 1)
        .drop("part", "place", "first_place", "before", "neg")
    )
