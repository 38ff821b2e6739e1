"""Ranked lexical search with hashed max-sketches.

A document's impact of a term is what the term's weight is multiplied by: ``(UNIT * tf) div (1000 * tf + 8 * m)`` with the document's length part
``m``. The sketch of a document has ``BUCKETS`` places; terms are hashed to places, and each place holds the greatest impact of its terms
(coordinatewise maxima). For a query, the weights of its terms are added up per place; the product of sketches and query columns, for a
batch of documents and all queries of a block at once, bounds every score from above, as a place holds no less than any of its terms'
impacts. Documents are then scored exactly by descending bound until the bound falls below the query's k-th best score.

Two passes over the documents, neither with a shuffle of texts: the first counts documents, terms and, for the words of the queries, the
documents that hold them (added up in the tasks, then one row per word and task); the second sketches, bounds and scores, and leaves at most
k rows per query and task. Queries are a stated set, read in blocks of bounded size; each block takes these two passes. A task holds a
batch of documents as a sketch matrix, cut so that no matrix exceeds ``ROOM`` numbers.

Defined results: a NULL text has no terms and counts nowhere; documents without an id count and are ranked, after those with equal scores
that have one; documents with equal ids are separate; every query row is a query of its own, whatever its id; a query without terms, or without
a document that scores above 0, has no rows; repeated terms of a query count as often as they occur; long texts are taken whole; other
columns are ignored; empty tables give an empty table.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from confluo.llm.common import Batches, byte_texts, pick, small_batches
from confluo.llm.decontaminate import words_of
from confluo.session import store_step

K = 10
UNIT = 1_000_000_000
BUCKETS = 2048
BLOCK_ITEMS = 512
BLOCK_BYTES = 1 << 20
ROOM = 1 << 22
CHUNK = 32  # documents scored at once by descending bound
SLACK = 1e-4  # single precision sums of at most BUCKETS products, rounded up


@dataclass(frozen=True)
class Queries:
    """A block of queries: numbered terms, and per query its terms and how often each occurs."""

    first: int  # number of the first query
    ids: tuple[Any, ...]
    vocabulary: dict[bytes, int]
    terms: tuple[np.ndarray, ...]
    times: tuple[np.ndarray, ...]


def build_queries(first: int, rows: list[tuple[Any, bytes]]) -> Queries:
    vocabulary: dict[bytes, int] = {}
    terms, times = [], []
    for _, text in rows:
        counts = Counter(words_of(text))
        terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in counts], np.int64))
        times.append(np.array(list(counts.values()), np.int64))
    return Queries(first, tuple(i for i, _ in rows), vocabulary, tuple(terms), tuple(times))


def query_blocks(items: DataFrame, item_id: str, text: str, most_items: int = BLOCK_ITEMS, most_bytes: int = BLOCK_BYTES) -> Iterator[Queries]:
    """The queries in blocks; the driver holds one block at a time."""
    first, rows, size = 0, [], 0
    for item, body in pick(items, item_id, text).toLocalIterator():
        data = (body or "").encode()
        if rows and (len(rows) == most_items or size + len(data) > most_bytes):
            yield build_queries(first, rows)
            first, rows, size = first + len(rows), [], 0
        rows.append((item, data))
        size += len(data)
    if rows:
        yield build_queries(first, rows)


@dataclass(frozen=True)
class Statistics:
    documents: int  # with at least one term
    length: int  # all their terms
    held_by: np.ndarray  # documents per term of the block

    def weights(self) -> np.ndarray:
        n = self.documents
        return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in self.held_by.tolist()], np.int64)

    def length_part(self, n: int) -> int:
        return 100 - 75 + (75 * n * self.documents) // self.length


def corpus_statistics(docs: DataFrame, queries: Queries) -> Statistics:
    """Document count, total length and the block's document frequencies: as many rows per task as the block has terms."""
    handle = docs.sparkSession.sparkContext.broadcast(queries.vocabulary)
    n_terms = len(queries.vocabulary)

    def run(batches: Batches) -> Batches:
        vocabulary, documents, length, held = handle.value, 0, 0, np.zeros(n_terms, np.int64)
        for batch in batches:
            for text in byte_texts(batch.column(1)):
                words = words_of(text)
                if words:
                    documents, length = documents + 1, length + len(words)
                    held[[vocabulary[w] for w in vocabulary.keys() & set(words)]] += 1
        some = np.flatnonzero(held)
        numbers = np.r_[some, -1, -2]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(np.r_[held[some], documents, length], pa.int64())], names=["term", "n"])

    sums = docs.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    found = dict(zip(sums["term"], sums["n"], strict=True))
    return Statistics(int(found.get(-1, 0)), int(found.get(-2, 0)), np.array([found.get(t, 0) for t in range(n_terms)], np.int64))


def bucket(term: bytes, buckets: int = BUCKETS) -> int:
    return zlib.crc32(term) % buckets


@dataclass(frozen=True)
class Plan:
    """What a task needs for a block: weights per term, and the queries as columns over sketch places."""

    queries: Queries
    statistics: Statistics
    weights: np.ndarray
    columns: np.ndarray
    buckets: int
    k: int


def build_plan(queries: Queries, statistics: Statistics, buckets: int, k: int) -> Plan:
    weights = statistics.weights()
    places = np.array([bucket(t, buckets) for t in queries.vocabulary], np.int64)
    columns = np.zeros((buckets, len(queries.ids)))
    for q, (terms, times) in enumerate(zip(queries.terms, queries.times, strict=True)):
        np.add.at(columns[:, q], places[terms], weights[terms] * times)
    return Plan(queries, statistics, weights, columns.astype(np.float32), buckets, k)


class Impacts:
    """A batch of documents: sketches, and exact impacts of the terms that queries ask for."""

    def __init__(self, plan: Plan, documents: list[Counter]):
        statistics, vocabulary = plan.statistics, plan.queries.vocabulary
        tf = np.array([n for d in documents for n in d.values()], np.int64)
        sizes = np.array([len(d) for d in documents])
        parts = np.array([statistics.length_part(d.total()) for d in documents], np.int64)
        rows = np.repeat(np.arange(len(documents)), sizes)
        impact = (UNIT * tf) // (1000 * tf + 8 * parts[rows])
        places = np.array([zlib.crc32(t) for d in documents for t in d], np.int64) % plan.buckets
        self.sketch = np.zeros((len(documents), plan.buckets), np.float32)
        # Impacts are at most a million, so single precision holds them exactly.
        np.maximum.at(self.sketch.reshape(-1), rows * plan.buckets + places, impact.astype(np.float32))
        numbers = np.array([vocabulary.get(t, -1) for d in documents for t in d], np.int64)
        asked = numbers >= 0
        self.exact = np.zeros((len(documents), max(len(vocabulary), 1)), np.int64)
        self.exact[rows[asked], numbers[asked]] = impact[asked]


class Best:
    """The k best documents of every query: (score descending, documents without id last, id)."""

    def __init__(self, plan: Plan):
        self.plan = plan
        self.rows: list[list[tuple[int, bool, Any]]] = [[] for _ in plan.queries.ids]
        self.floor = np.zeros(len(plan.queries.ids))
        self.scored = 0

    def offer(self, ids: list[Any], impacts: Impacts) -> None:
        plan, k = self.plan, self.plan.k
        bounds = (impacts.sketch @ plan.columns) * (1 + SLACK)
        open_ = (bounds >= self.floor) & (bounds > 0)
        for q in np.flatnonzero(open_.any(axis=0)).tolist():
            terms = plan.queries.terms[q]
            weights = plan.weights[terms] * plan.queries.times[q]
            rows, bound = np.flatnonzero(open_[:, q]), bounds[:, q]
            rows = rows[np.argsort(-bound[rows], kind="stable")]
            best = self.rows[q]
            for at in range(0, len(rows), CHUNK):
                if len(best) == k and bound[rows[at]] < -best[-1][0]:
                    break
                some = rows[at : at + CHUNK]
                scores = impacts.exact[np.ix_(some, terms)] @ weights
                self.scored += len(some)
                for r, score in zip(some.tolist(), scores.tolist(), strict=True):
                    if score > 0 and (len(best) < k or score >= -best[-1][0]):
                        i = ids[r]
                        bisect.insort(best, (-score, i is None, 0 if i is None else i))
                        del best[k:]
            self.floor[q] = -best[-1][0] if len(best) == k else 0


def search_block(docs: DataFrame, queries: Queries, k: int = K, buckets: int = BUCKETS) -> DataFrame:
    """``query, doc_id, score``: at most k rows per query and task, the best of that task."""
    spark = docs.sparkSession
    statistics = corpus_statistics(docs, queries)
    plan = build_plan(queries, statistics, buckets, k)
    handle = spark.sparkContext.broadcast(plan)
    widest = max(buckets, len(queries.vocabulary), len(queries.ids))
    most = max(1, ROOM // widest)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        plan = handle.value
        best, id_type = Best(plan), None
        held_ids: list[Any] = []
        held: list[Counter] = []
        size = 0
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                counts = Counter(words_of(text))
                if counts:
                    held_ids.append(i)
                    held.append(counts)
                    size += len(counts)
                if len(held) >= most or size >= ROOM:
                    best.offer(held_ids, Impacts(plan, held))
                    held_ids, held, size = [], [], 0
        if held:
            best.offer(held_ids, Impacts(plan, held))
        rows = [(plan.queries.first + q, None if none else i, -neg) for q, found in enumerate(best.rows) for neg, none, i in found]
        if rows:
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], id_type), pa.array([r[2] for r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])

    return docs.mapInArrow(run, f"query bigint, doc_id {kind}, score bigint")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", buckets: int = BUCKETS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item with a score above 0, ties to the smaller id."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    item_kind = items.schema[item_id].dataType
    found, names = None, None
    for queries in query_blocks(items, item_id, item_text):
        # A block's names are as many rows as it has queries, its results at most k rows per query and task.
        block = store_step(search_block(rows, queries, k, buckets), "ranked")
        ids = pa.table({"query": pa.array(range(queries.first, queries.first + len(queries.ids)), pa.int64()), "item_id": pa.array(queries.ids)})
        own = spark.createDataFrame(ids).withColumn("item_id", F.col("item_id").cast(item_kind))
        found = block if found is None else found.unionByName(block)
        names = own if names is None else names.unionByName(own)
    if found is None:
        found = spark.createDataFrame([], f"query bigint, doc_id {rows.schema['doc_id'].dataType.simpleString()}, score bigint")
        names = spark.range(0).select(F.col("id").alias("query"), F.lit(None).cast(item_kind).alias("item_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(names, "query").select("item_id", "rank", "doc_id", "score")


def sql_ranked() -> str:
    """The same in DuckDB SQL, scoring every document that shares a term with an item."""
    lower = f"translate(text, '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
    cut = rf"unnest(regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""WITH q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, {cut} AS t FROM benchmark) GROUP BY ALL),
d AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, {cut} AS t FROM documents) GROUP BY ALL),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM d GROUP BY t), total),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * (({UNIT} * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN d USING (t) JOIN w USING (t) JOIN len USING (doc_id), total GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {K}"""
