"""Search tables of a catalogue: postings, term statistics, keywords, dates, entity directory.

A postings row carries the document length and the entity, so that scoring and fusing need no join back to the
catalogue. The statistics table keeps one row per (source, field, term); the empty term stands for "any document" and
holds the document count and the total length of the field.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from confluo.functions.text import STOP_WORDS, analyser_of
from confluo.schemas import KEYWORD_FIELDS, TEXT_FIELDS
from confluo.session import import_in_tasks, store_step

ANY_TERM = ""

# Tokens whose postings are made together; a longer document is one group.
POSTING_TOKENS = 1 << 17


def token_rows(catalogue: DataFrame, fields: Sequence[str] = TEXT_FIELDS, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """One row per document and text field that has at least one token."""
    analysed = [F.struct(F.lit(f).alias("field"), analyser_of(f)(f, stop_words).alias("tokens")) for f in fields]
    return (
        catalogue.select("source", "id", "entity_id", F.explode(F.array(*analysed)).alias("t"))
        .select("source", "id", "entity_id", "t.field", "t.tokens", F.size("t.tokens").alias("len"))
        .where(F.col("len") > 0)
    )


def build_postings(tokens: DataFrame) -> DataFrame:
    """Term frequency and positions per document, without a shuffle.

    A document's tokens lie in one row, so they are grouped there: the tokens of a batch of rows are told apart at once, sorted by row and
    term, places in order, and cut where either changes.
    """
    import_in_tasks(tokens.sparkSession)
    rows = tokens.select("source", "field", "id", "entity_id", "len", "tokens")
    kinds = {f.name: f.dataType for f in rows.schema}
    kept = [StructField(c, kinds[c]) for c in ("source", "field")]
    schema = StructType(
        [
            *kept,
            StructField("term", StringType()),
            *[StructField(c, kinds[c]) for c in ("id", "entity_id", "len")],
            StructField("tf", IntegerType()),
            StructField("positions", ArrayType(IntegerType())),
        ]
    )
    return rows.mapInArrow(_postings, schema)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(lengths) - lengths) // POSTING_TOKENS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if lengths[a:b].any():
                yield _postings_of(batch.slice(a, b - a), lengths[a:b])


def _postings_of(rows: pa.RecordBatch, lengths: np.ndarray) -> pa.RecordBatch:
    told = rows.column("tokens").flatten().dictionary_encode()
    codes = told.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    key = row * len(told.dictionary) + codes
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    ends = np.append(starts, len(order))
    places = order - (np.cumsum(lengths) - lengths)[row[order]]
    first = order[starts]
    at = pa.array(row[first])
    columns = {c: rows.column(c).take(at) for c in ("source", "field", "id", "entity_id", "len")}
    columns["term"] = told.dictionary.take(pa.array(codes[first]))
    columns["tf"] = pa.array(np.diff(ends), pa.int32())
    columns["positions"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32()))
    names = ["source", "field", "term", "id", "entity_id", "len", "tf", "positions"]
    return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


def build_presence(tokens: DataFrame) -> DataFrame:
    """Which document holds which term; in-row as well."""
    return tokens.select("source", "field", "id", "entity_id", F.explode(F.array_distinct("tokens")).alias("term"))


def build_stats(tokens: DataFrame) -> DataFrame:
    """Document frequency per term, and per field the document count and total length (the ``ANY_TERM`` rows)."""
    seen = tokens.select(
        "source", "field", "len", F.explode(F.array_append(F.array_distinct("tokens"), F.lit(ANY_TERM))).alias("term")
    )
    return seen.groupBy("source", "field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum(F.col("len").cast("long")).alias("total_len")
    )


def stats_of_postings(postings: DataFrame) -> DataFrame:
    """The same from postings: the one that holds a document's first position stands for the document in the field totals."""
    first = F.get("positions", F.lit(0)) == 0
    length = F.col("len").cast("long")
    lead = F.when(first, F.lit(ANY_TERM))
    rows = postings.select("source", "field", length.alias("len"), F.explode(F.array_compact(F.array("term", lead))).alias("term"))
    return rows.groupBy("source", "field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("len").alias("total_len"))


def select_terms(tokens: DataFrame, terms: DataFrame, positions: bool = True, small: bool = False) -> DataFrame:
    """Postings of the asked terms together with the field totals.

    Each document adds one ``ANY_TERM`` row without a document key, so a task merges those to one row per source and field before
    anything is shuffled. ``small`` says that the asked terms are few enough to be sent to every task: texts are then read in one
    pass. Otherwise occurrences and terms meet by term, frequent terms are split by adaptive execution, and the totals
    come from a pass of their own, as they would all meet under one key.
    """
    wanted = terms.select("field", "term").distinct()
    document = ["source", "id", "entity_id", "field", "len"]
    if small:
        every = F.broadcast(wanted.union(wanted.select("field", F.lit(ANY_TERM))))
        rows = tokens.select(*document, F.posexplode(F.array_append("tokens", F.lit(ANY_TERM))).alias("pos", "term"))
        rows = rows.join(every, ["field", "term"], "left_semi")
    else:
        totals = tokens.select(*document, F.lit(0).alias("pos"), F.lit(ANY_TERM).alias("term"))
        rows = tokens.select(*document, F.posexplode("tokens").alias("pos", "term")).join(wanted, ["field", "term"], "left_semi")
        rows = rows.unionByName(totals)
    real = F.col("term") != ANY_TERM
    keys = ["source", "field", "term", *[F.when(real, F.col(c)).alias(c) for c in ("id", "entity_id", "len")]]
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.when(~real, F.col("len")).cast("long")).alias("total_len")]
    if positions:
        sums.append(F.sort_array(F.collect_list(F.when(real, F.col("pos")))).alias("positions"))
    return rows.groupBy(*keys).agg(*sums)


def selected_postings(selected: DataFrame) -> DataFrame:
    extra = ["positions"] if "positions" in selected.columns else []
    return selected.where(F.col("term") != ANY_TERM).select(
        "source", "field", "term", "id", "entity_id", "len", F.col("n").cast("int").alias("tf"), *extra
    )


def selected_stats(selected: DataFrame) -> DataFrame:
    per_term = (
        selected.where(F.col("term") != ANY_TERM)
        .groupBy("source", "field", "term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum(F.col("len").cast("long")).alias("total_len"))
    )
    totals = selected.where(F.col("term") == ANY_TERM).select("source", "field", "term", F.col("n").alias("df"), "total_len")
    return per_term.unionByName(totals)


def field_stats(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("term") == ANY_TERM).select(
        "source",
        "field",
        F.col("df").alias("n_docs"),
        "total_len",
        (F.col("total_len") / F.col("df")).alias("avg_len"),
    )


def term_stats(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("term") != ANY_TERM).select("source", "field", "term", "df")


# Marks the ends of a term in its grams. Terms are letters, digits, underscores and dots, so they cannot hold it.
EDGE = "^"


def term_grams(term: str) -> Column:
    """Single characters and pairs of neighbours of a term, with its ends."""
    return F.expr(
        f"array_distinct(concat(transform(sequence(1, length({term})), i -> substring({term}, i, 1)), "
        f"transform(sequence(1, length({term}) + 1), i -> substring(concat('{EDGE}', {term}, '{EDGE}'), i, 2))))"
    )


def pattern_grams(pattern: str) -> Column:
    """Grams that every term a LIKE pattern fits must have: pairs where two literal characters meet, single ones otherwise."""
    # An escaped underscore is a character like others, and leaves its place to a sign until the pattern is cut; other escaped
    # characters are in no term, so what is left of them finds none.
    plain = F.replace(F.col(pattern), F.lit("\\_"), F.lit("\x01"))
    parts = F.split(F.concat(F.lit(EDGE), plain, F.lit(EDGE)), "[%_]")
    parts = F.transform(parts, lambda p: F.replace(p, F.lit("\x01"), F.lit("_")))
    pairs = lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 1), lambda i: F.substring(p, i, F.lit(2)))
    literal = F.filter(parts, lambda p: (p != "") & (p != EDGE))
    return F.array_distinct(F.flatten(F.transform(literal, lambda p: F.when(F.length(p) == 1, F.array(p)).otherwise(pairs(p)))))


def gram_rows(stats: DataFrame, once: bool = False) -> DataFrame:
    """``field, gram, term`` of the dictionary, each term once; ``once`` says that it is, as in the statistics of one source."""
    terms = term_stats(stats).select("field", "term")
    terms = terms if once else terms.distinct()
    return terms.select("field", F.explode(term_grams("term")).alias("gram"), "term")


def keyword_rows(catalogue: DataFrame, fields: Sequence[str] = KEYWORD_FIELDS) -> DataFrame:
    """One row per document, keyword field and distinct element; elements stay whole and case-sensitive."""
    lists = [
        F.struct(F.lit(f).alias("field"), F.array_distinct(F.coalesce(F.col(f), F.array().cast("array<string>"))).alias("terms"))
        for f in fields
    ]
    return (
        catalogue.select("source", "id", "entity_id", F.explode(F.array(*lists)).alias("k"))
        .select("source", "id", "entity_id", "k.field", F.explode("k.terms").alias("term"))
        .where(F.col("term").isNotNull())
    )


def date_rows(catalogue: DataFrame) -> DataFrame:
    """Dated documents; the year is what ranges and dates meet by."""
    return catalogue.where(F.col("date").isNotNull()).select("source", "id", "entity_id", "date", F.year("date").alias("year"))


def own_entity() -> Column:
    """The entity of a document; one that has none yet stands for itself under the id a new entity would get."""
    return F.coalesce(F.col("entity_id"), F.sha2(F.concat_ws(":", "source", "id"), 256))


def entity_directory(catalogue: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Per entity its documents in registration order and the number of sources holding it.

    ``sources`` is the registry, so the row width is fixed and every aggregate merges on the map side.
    """
    per_source = [
        F.min(F.when(F.col("source") == s, F.col("id"))).alias(f"id_{i}") for i, s in enumerate(sources)
    ]
    docs = F.array(
        *[F.struct(F.lit(s).alias("source"), F.col(f"id_{i}").alias("id")) for i, s in enumerate(sources)]
    )
    return (
        catalogue.where(F.col("source").isin(*sources))
        .groupBy(own_entity().alias("entity_id"))
        .agg(*per_source)
        .select("entity_id", F.filter(docs, lambda d: d["id"].isNotNull()).alias("docs"))
        .withColumn("n_sources", F.size("docs"))
    )


def fetch_stored(hits: DataFrame, catalogue: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Display columns of the hits; only these columns are read from the catalogue."""
    return hits.join(catalogue.select("source", "id", *columns), ["source", "id"])


class CatalogueTables:
    """Search tables computed from a catalogue on demand, restricted to the terms a query asks for."""

    def __init__(self, catalogue: DataFrame, sources: Sequence[str], stop_words: Sequence[str] = STOP_WORDS):
        self.catalogue = catalogue
        self.sources = list(sources)
        self.stop_words = tuple(stop_words)
        self._token_rows: dict[tuple[str, ...], DataFrame] = {}

    def _tokens(self, fields: Sequence[str]) -> DataFrame:
        key = tuple(fields)
        if key not in self._token_rows:
            self._token_rows[key] = token_rows(self.catalogue, fields, self.stop_words)
        return self._token_rows[key]

    def postings(self, fields: Sequence[str] = TEXT_FIELDS) -> DataFrame:
        return build_postings(self._tokens(fields))

    def presence(self, fields: Sequence[str] = TEXT_FIELDS, terms: DataFrame | None = None) -> DataFrame:
        rows = build_presence(self._tokens(fields))
        return rows if terms is None else rows.join(terms.distinct(), ["field", "term"], "left_semi")

    def grams(self, fields: Sequence[str] = TEXT_FIELDS) -> DataFrame:
        return gram_rows(self.stats(fields))

    def stats(self, fields: Sequence[str] = TEXT_FIELDS) -> DataFrame:
        return build_stats(self._tokens(fields))

    def lookup(self, fields: Sequence[str], terms: DataFrame, positions: bool, small: bool = False, once: bool = False) -> tuple[DataFrame, DataFrame]:
        """Postings and statistics of some terms; the rows that texts yield are stored for the steps after, as the statistics are made of them, also for postings read ``once``."""
        selected = store_step(select_terms(self._tokens(fields), terms, positions, small), "terms")
        return selected_postings(selected), selected_stats(selected)

    def keywords(self, fields: Sequence[str] = KEYWORD_FIELDS) -> DataFrame:
        return keyword_rows(self.catalogue, fields)

    def dates(self, years: Sequence[int] | None = None) -> DataFrame:
        rows = date_rows(self.catalogue)
        return rows if years is None else rows.where(F.col("year").isin(*years))

    def date_years(self) -> list[int] | None:
        """The years that occur, if they are known without looking at the rows."""
        return None

    def entities(self) -> DataFrame:
        return entity_directory(self.catalogue, self.sources)

