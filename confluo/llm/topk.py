"""Exact top-k by inner product, with norm-sorted candidates and SVD-rotated partial sums.

Vectors become integers, so scores are exact in any order of summation. The singular vectors of all candidates (from the sum of outer
products, one small matrix) rotate candidates and queries so that the first coordinates carry most of the length. A task takes its
candidates by descending length. A block of them stops being looked at for a query as soon as its greatest length times the query's length cannot
reach the query's k-th best score; for the others the first rotated coordinates are multiplied and the rest is bounded by the product
of the remaining lengths (Cauchy-Schwarz). Only pairs whose bound reaches the k-th best score are scored in full: in doubles while the
product of the lengths shows that every sum stays below 2^52, in whole numbers of any size beyond.

Queries are a stated set: they are stored and read in blocks of bounded size, in batches and not row by row; each block meets all candidates in one
pass and leaves at most k rows per query and task. The pass starts from the k-th best scores against the longest vectors, so every task
prunes from its first block on.

Defined results: vectors that are NULL, or hold a NULL, NaN or infinite component, take no part, neither do rows without an id; vectors of
different dimensions are compared by what both have, the rest counting as zero; components and scores beyond the range of a long are its
ends; every query row has results of its own, also if ids are repeated; rows that share the query's id are its own; other repeated ids are
separate rows; a query without candidates has no rows; empty tables give empty tables.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from confluo.llm.common import Batches, pick, small_batches
from confluo.session import store_step

SCALE = 256
K = 5
EVERY = 50
BLOCK = 4096
SEEDS = 1024
HEAD_SHARE = 4  # the rotated head is a quarter of the dimensions
ROTATED = 1024  # so many leading dimensions are rotated; what lies behind them counts as rest
CHUNK = 256
DENSE = 0.05  # share of open pairs from which a block is multiplied whole
ROOM = 1 << 22  # numbers in a matrix
EXACT = float(1 << 52)
LEAST, MOST = -(1 << 63), (1 << 63) - 1  # LEAST stands for no score


def quantise(vector: Column, scale: int = SCALE) -> Column:
    """Components as integers: floor(scale * x), x as double; NULL if the vector takes no part."""
    ok = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(F.coalesce(ok, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint")))


def valid_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` of the vectors that take part."""
    rows = pick(table, vec_id, vector).toDF("vec_id", "vector")
    return rows.select("vec_id", quantise(F.col("vector"), scale).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")


def _matrices(ids: np.ndarray, column: pa.Array, room: int = ROOM) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors as rows of whole numbers, filled with zeros to the widest of a group; a group of short vectors holds no long one."""
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        width = int(lengths[order[at]])
        some = order[at : at + max(1, room // max(width, 1))]
        # The widest comes first, so a group ends where half of its width would be zeros.
        some = some[: max(1, int(np.searchsorted(-lengths[some], -(width // 2), "right")))]
        own = lengths[some]
        if (own == width).all() and (np.diff(some) == 1).all():
            first = offsets[some[0]]
            matrix = flat[first : first + width * len(some)].reshape(len(some), width)
        else:
            matrix = np.zeros((len(some), width), np.int64)
            inside = np.arange(width) < own[:, None]
            matrix[inside] = flat[(offsets[some][:, None] + np.arange(width))[inside]]
        yield ids[some], matrix
        at += len(some)


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the first ``width`` components of all vectors, strongest first: from a matrix summed up over tasks.

    The driver holds that matrix, whatever the number of vectors: width squared doubles.
    """

    def run(batches: Batches) -> Batches:
        total = np.zeros((width, width))
        for batch in batches:
            for _, m in _matrices(np.arange(batch.num_rows), batch.column(0)):
                part = np.ascontiguousarray(m[:, :width], np.float64)
                total[: part.shape[1], : part.shape[1]] += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["g"])

    parts = vectors.select("v").mapInArrow(run, "g array<double>")
    sums = parts.select(F.posexplode("g").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").collect()
    gram = np.array([r["x"] for r in sums]).reshape(width, width) if sums else np.zeros((width, width))
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _turned(vectors: np.ndarray, basis: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray]:
    """The rotated head, and the length of all the rest."""
    own = min(basis.shape[0], vectors.shape[1])
    turned = vectors[:, :own] @ basis[:own]
    behind = np.square(vectors[:, own:]).sum(axis=1)
    return turned[:, :head].copy(), np.sqrt(np.square(turned[:, head:]).sum(axis=1) + behind)


class QueryBlock:
    """Some queries with what pruning needs; ``floor`` is a k-th best score that others have reached already, ``rows`` tells queries apart."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, basis: np.ndarray, floor: np.ndarray | None = None, rows: np.ndarray | None = None):
        self.ids, self.whole, self.rows = ids, vectors, ids if rows is None else rows
        self.vectors = np.asarray(vectors, np.float64)
        self.floor = np.full(len(ids), LEAST) if floor is None else floor
        self.basis, self.n_head = basis, max(1, basis.shape[0] // HEAD_SHARE)
        self.head, self.rest = _turned(self.vectors, basis, self.n_head)
        self.length = np.linalg.norm(self.vectors, axis=1)


class BestScores:
    """The k best (score, smaller id first) of every query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((queries, k), LEAST), np.zeros((queries, k), np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Offer candidates: ``rows`` are query numbers."""
        # The complement orders whole numbers the other way round, and overflows never.
        order = np.lexsort((ids, ~scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
        use = place < self.k
        touched = rows[starts]
        at = np.searchsorted(touched, rows[use])
        all_scores = np.hstack([self.scores[touched], np.full((len(touched), self.k), LEAST)])
        all_ids = np.hstack([self.ids[touched], np.zeros((len(touched), self.k), np.int64)])
        all_scores[at, self.k + place[use]], all_ids[at, self.k + place[use]] = scores[use], ids[use]
        best = np.lexsort((all_ids, ~all_scores), axis=1)[:, : self.k]
        self.scores[touched] = np.take_along_axis(all_scores, best, 1)
        self.ids[touched] = np.take_along_axis(all_ids, best, 1)


def _whole_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows in numbers of any size, cut to the range of a long."""
    return np.array([min(max(sum(map(operator.mul, x, y)), LEAST + 1), MOST) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.int64)


def search_block(block: QueryBlock, ids: np.ndarray, vectors: np.ndarray, best: BestScores) -> int:
    """Offer candidates to a block of queries by descending length; returns how many pairs were scored in full."""
    both = min(vectors.shape[1], block.vectors.shape[1])
    length = np.linalg.norm(np.asarray(vectors, np.float64), axis=1)
    order = np.argsort(-length, kind="stable")
    ids, whole, length, scored = ids[order], vectors[order], length[order], 0
    vectors = np.asarray(whole, np.float64)
    head, rest = _turned(vectors, block.basis, block.n_head)
    small = len(length) == 0 or float(length[0]) * float(block.length.max(initial=0)) < EXACT
    for at in range(0, len(ids), CHUNK):
        floor = np.maximum(best.scores[:, -1], block.floor)
        need = np.where(floor == LEAST, -np.inf, floor.astype(np.float64))
        # The bounds are rounded; a relative slack keeps them above the true value.
        live = np.flatnonzero(length[at] * block.length * (1 + 1e-9) + 1e-6 >= need)
        if not len(live):
            break
        own = slice(at, at + CHUNK)
        bound = block.head[live] @ head[own].T + np.outer(block.rest[live], rest[own])
        slack = 1e-9 * np.outer(block.length[live], length[own]) + 1e-6
        open_ = (bound + slack >= need[live, None]) & (ids[own] != block.ids[live, None])
        if small and np.count_nonzero(open_) > open_.size * DENSE:
            # Most pairs are open, so one product of the whole block is cheaper than picking them out.
            products = block.vectors[live, :both] @ vectors[own, :both].T
            scored += products.size
            row, column = np.nonzero(open_ & (products >= need[live, None]))
            scores = products[row, column].astype(np.int64)
        else:
            row, column = np.nonzero(open_)
            scored += len(row)
            scores = np.zeros(len(row), np.int64)
            for k in range(0, len(row), step := max(1, ROOM // max(both, 1))):
                r, c = live[row[k : k + step]], column[k : k + step] + at
                if small:
                    scores[k : k + step] = np.einsum("ij,ij->i", block.vectors[r, :both], vectors[c, :both]).astype(np.int64)
                else:
                    scores[k : k + step] = _whole_scores(block.whole[r, :both], whole[c, :both])
            good = scores >= floor[live[row]]
            row, column, scores = row[good], column[good], scores[good]
        if len(row):
            best.add(live[row], ids[column + at], scores)
    return scored


_FOUND = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def _pass(handle, k: int):
    def run(batches: Batches) -> Batches:
        block: QueryBlock = handle.value
        best = BestScores(len(block.ids), k)
        for batch in batches:
            for ids, vectors in _matrices(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)):
                search_block(block, ids, vectors, best)
        row, place = np.nonzero(best.scores != LEAST)
        columns = [block.rows[row], block.ids[row], best.ids[row, place], best.scores[row, place]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_row", "query_id", "vec_id", "score"])

    return run


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, ids and vectors of stored queries, dealt to blocks by the hash of their row; the driver holds one block at a time."""
    n, widest = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = max(-(-n // size), -(-n * (widest or 0) // ROOM))
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "vec_id", "v").toArrow().combine_chunks()
        if own.num_rows:
            rows, ids, lists = own.column(0).to_numpy(), own.column(1).to_numpy(), own.column(2).combine_chunks()
            # Queries of very different dimensions are groups of their own.
            for place, vectors in _matrices(np.arange(len(rows)), lists):
                yield rows[place], ids[place], vectors


def top_k(table: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of every query with all other rows, ties to the smaller id.

    ``is_query`` is a condition on a column named ``vec_id``.
    """
    spark = table.sparkSession
    small_batches(spark, 8192)
    valid = valid_vectors(table, vec_id, vector, scale).withColumn("vec_id", F.col("vec_id").cast("bigint"))
    vectors = store_step(valid.withColumn("row", F.monotonically_increasing_id()), "vectors")
    widest = vectors.agg(F.max(F.size("v"))).first()[0]
    found = spark.createDataFrame([], _FOUND)
    if widest:
        basis = rotation(vectors, min(widest, ROTATED))
        square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        # The longest vectors, a fixed number of rows.
        seeds = vectors.select("vec_id", "v").orderBy(square.desc(), "vec_id").limit(SEEDS).toArrow().combine_chunks()
        seed_groups = list(_matrices(seeds.column(0).to_numpy(), seeds.column(1).combine_chunks()))
        for rows, ids, block_vectors in _blocks(vectors.where(is_query), block):
            first = QueryBlock(ids, block_vectors, basis, rows=rows)
            best = BestScores(len(ids), k)
            for seed_ids, seed_vectors in seed_groups:
                search_block(first, seed_ids, seed_vectors, best)
            first.floor = best.scores[:, -1].copy()
            handle = spark.sparkContext.broadcast(first)
            found = found.unionByName(store_step(vectors.select("vec_id", "v").mapInArrow(_pass(handle, k), _FOUND), "top-k"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def sql_top_k() -> str:
    """The same in DuckDB SQL."""
    return f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""
