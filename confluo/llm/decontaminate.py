"""Benchmark decontamination with suffix arrays of the training texts.

Training documents are cut into shards of whole documents, one after the other inside each input partition, so nothing is shuffled. A
shard gets a suffix array: its suffixes sorted by their first ``WINDOW`` words, leaving out suffixes that begin with fewer words
of the benchmark's vocabulary than the shortest window has, as no test suffix can match those. Every test suffix, cut to a window, is
binary-searched in every shard; the two borders of its run in the suffix array give all locations at once. Matches that follow each
other on one diagonal are one longer verbatim match, so longest matches and their places come from joining hits end to end.

A word is a run of letters, digits and non-ASCII characters after lower-casing A-Z. A window is ``WINDOW`` consecutive words of an item;
an item with fewer words, but not none, is one window. A document word inside any occurrence of a window is hit. A document
is contaminated if at least one in ``SHARE`` of its words is hit.

The benchmark is a stated query set: it is read in blocks of bounded size, each block meets all shards in one pass.

Items without an id hit like any other; all of them count as one item (NULL), which the digest of ids does not show. Ids are whole numbers or
texts; any other kind is taken as text.

Defined results: a NULL text has no words; an item without words has no window; rows with equal ids are judged on their own; a text
longer than a shard is a shard of its own; an empty benchmark hits nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm.common import Batches, byte_texts, fresh, pick, small_batches, with_columns
from confluo.session import store_step

WINDOW = 13
SHARE = 20
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text."""
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Block:
    """Test suffixes cut to windows: each distinct window once, with the items and places it comes from."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray  # word numbers from 1, padded with 0
    lengths: np.ndarray
    sources: tuple[tuple[tuple[int | None, int, int], ...], ...]  # (item id, word place, item row) of every window


def build_block(items: list[tuple[int | None, bytes]]) -> Block | None:
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], list[tuple[int | None, int, int]]] = {}
    for row, (item, text) in enumerate(items):
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        if ids:
            for i in range(max(1, len(ids) - WINDOW + 1)):
                found.setdefault(tuple(ids[i : i + WINDOW]), []).append((item, i, row))
    if not found:
        return None
    windows = np.zeros((len(found), WINDOW), np.uint32)
    for row, window in enumerate(found):
        windows[row, : len(window)] = window
    return Block(vocabulary, windows, np.array([len(w) for w in found]), tuple(map(tuple, found.values())))


def id_kind(benchmark: DataFrame, item_id: str = "item_id") -> str:
    """What item ids are reported as."""
    return "bigint" if benchmark.schema[item_id].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else "string"


def _arrow(kind: str) -> pa.DataType:
    return pa.int64() if kind == "bigint" else pa.string()


def blocks_of(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks; the driver holds one block of items at a time."""
    rows, size = [], 0
    items = pick(benchmark, item_id, text).toDF("item_id", "text")
    for item, body in items.select(F.col("item_id").cast(id_kind(benchmark, item_id)), "text").toLocalIterator():
        if not body:
            continue
        rows.append((item, body.encode()))
        size += len(rows[-1][1])
        if size >= block_bytes:
            if block := build_block(rows):
                yield block
            rows, size = [], 0
    if rows and (block := build_block(rows)):
        yield block


def _keys(matrix: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort in word order."""
    return np.ascontiguousarray(matrix.astype(">u4")).view(f"S{4 * matrix.shape[1]}").ravel()


class SuffixArray:
    """The suffixes of one shard that can match a test suffix, sorted."""

    def __init__(self, ids: np.ndarray, shortest: int):
        n = len(ids)
        stops = np.flatnonzero(ids == 0)
        known = np.append(stops, n)[np.searchsorted(stops, np.arange(n))] - np.arange(n)
        places = np.flatnonzero(known >= shortest)
        padded = np.append(ids, np.zeros(WINDOW, ids.dtype))
        suffixes = padded[places[:, None] + np.arange(WINDOW)]
        suffixes[np.arange(WINDOW) >= known[places][:, None]] = 0
        keys = _keys(suffixes)
        order = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[order], places[order]

    def search(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(place, window number) of every occurrence."""
        after = block.windows.copy()
        after[np.arange(WINDOW) >= block.lengths[:, None]] = 0xFFFFFFFF
        low = np.searchsorted(self.keys, _keys(block.windows), "left")
        high = np.searchsorted(self.keys, _keys(after), "right")
        counts = np.maximum(high - low, 0)
        rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return self.places[rows], np.repeat(np.arange(len(counts)), counts)


@dataclass
class DocumentMatches:
    n_words: int
    places: np.ndarray  # word places in the document
    windows: np.ndarray  # window numbers
    hits: np.ndarray  # start and end of every maximal hit stretch, one after the other


def _shard(texts: list[list[int]], block: Block) -> Iterator[DocumentMatches]:
    """Search one shard; one result per document."""
    lengths = np.array([len(x) for x in texts])
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    ids = np.zeros(int((lengths + 1).sum()), np.uint32)
    for start, text in zip(starts, texts, strict=True):
        ids[start : start + len(text)] = text
    places, windows = SuffixArray(ids, int(block.lengths.min())).search(block)
    order = np.argsort(places, kind="stable")
    places, windows = places[order], windows[order]
    change = np.bincount(places, minlength=len(ids) + 1) - np.bincount(places + block.lengths[windows], minlength=len(ids) + 1)
    hit = np.cumsum(change) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    cut, cut_edges = np.searchsorted(places, starts), np.searchsorted(edges, starts)
    for d, start in enumerate(starts):
        own = slice(cut[d], cut[d + 1] if d + 1 < len(starts) else len(places))
        own_edges = slice(cut_edges[d], cut_edges[d + 1] if d + 1 < len(starts) else len(edges))
        yield DocumentMatches(int(lengths[d]), places[own] - start, windows[own], edges[own_edges] - start)


def scan(texts: list[bytes], block: Block, shard_words: int = SHARD_WORDS) -> Iterator[DocumentMatches]:
    """Cut the texts into shards and search each."""
    shard, size, number = [], 0, block.vocabulary.get
    for text in texts:
        ids = list(map(number, words_of(text), itertools.repeat(0)))
        if shard and size + len(ids) > shard_words:
            yield from _shard(shard, block)
            shard, size = [], 0
        shard.append(ids)
        size += len(ids)
    if shard:
        yield from _shard(shard, block)


def _grouped(batches: Batches, rows: int = 8 * 512, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Join small batches up to a bound, so that a shard spans several; what does not fit in one batch comes as more."""
    held, held_bytes, held_rows = [], 0, 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.nbytes
        held_rows += batch.num_rows
        if held_bytes >= size or held_rows >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, held_bytes, held_rows = [], 0, 0
    if held_rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _ids(items: set[int | str | None]) -> list[int | str | None]:
    """Sorted, NULL last."""
    return sorted(items - {None}) + [None] * (None in items)


def _marker(handle, text: str, before: tuple[str, str] | None, names: tuple[str, str, str], id_type: pa.DataType) -> Callable[[Batches], Batches]:
    """Add word count, hit stretches and item ids; ``before`` names the columns an earlier block has left."""

    def run(batches: Batches) -> Batches:
        block = handle.value
        for batch in _grouped(batches):
            counts, hits, items = [], [], []
            for found in scan(byte_texts(batch.column(batch.schema.get_field_index(text))), block):
                counts.append(found.n_words)
                hits.append(found.hits)
                items.append(_ids({i for w in set(found.windows.tolist()) for i, _, _ in block.sources[w]}))
            if before:
                old = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in before]
                hits = [_union(a, b) for a, b in zip(old[0], hits, strict=True)]
                items = [_ids({*a, *b}) for a, b in zip(old[1], items, strict=True)]
            columns = (pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(id_type)))
            yield with_columns(batch, list(names), **dict(zip(names, columns, strict=True)))

    return run


def _union(a: list[int], b: np.ndarray) -> list[int]:
    """Union of two lists of stretches."""
    out: list[int] = []
    for start, end in sorted([*zip(a[::2], a[1::2], strict=True), *zip(b[::2].tolist(), b[1::2].tolist(), strict=True)]):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, list[str]]:
    """All columns of ``docs`` and three more: words, hit stretches as [start, end, start, end, ...], ids of items with hits.

    Also returns the names of the three, which avoid those of ``docs``.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    names = fresh(docs, "n_words", "hits", "items")
    kind = id_kind(benchmark, item_id)
    marks = zip(names, ("bigint", "array<int>", f"array<{kind}>"), strict=True)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{n}` {m}" for n, m in marks])
    out, done = docs, 0
    for block in blocks_of(benchmark, item_id, item_text, block_bytes):
        if done:
            out = store_step(out, "decontaminate")
        before = (names[1], names[2]) if done else None
        out = out.mapInArrow(_marker(spark.sparkContext.broadcast(block), text, before, tuple(names), _arrow(kind)), schema)
        done += 1
    if not done:
        empty = Block({}, np.full((1, WINDOW), 0xFFFFFFFE, np.uint32), np.array([WINDOW]), ((),))
        out = out.mapInArrow(_marker(spark.sparkContext.broadcast(empty), text, None, tuple(names), _arrow(kind)), schema)
    return out, names


def _length(hits: str):
    return F.aggregate(
        F.sequence(F.lit(1), F.floor(F.size(hits) / 2).cast("int")),
        F.lit(0).cast("bigint"),
        lambda total, i: total + F.element_at(hits, 2 * i) - F.element_at(hits, 2 * i - 1),
    )


def _hit_words(hits: str):
    return F.when(F.size(hits) > 0, _length(hits)).otherwise(F.lit(0).cast("bigint"))


def contaminated(n_hit, n_words):
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: words, hit words, items found and the verdict."""
    marked, (n_words, hits, items) = mark(pick(docs, doc_id, text).toDF("doc_id", "text"), benchmark, **options)
    n_hit = _hit_words(hits)
    return marked.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(n_hit, F.col(n_words)).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with."""
    marked, (n_words, hits, _) = mark(docs, benchmark, text, **options)
    return marked.where(~contaminated(_hit_words(hits), F.col(n_words))).select(*[F.col(f"`{c}`") for c in docs.columns])


def longest_matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Maximal verbatim matches: ``doc_id, start, item_id, item_start, length`` in words.

    Windows that follow each other in both the document and the item are joined; each match is as long as it can be.
    """
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    spark = docs.sparkSession
    small_batches(spark)
    kind = id_kind(benchmark, options.get("item_id", "item_id"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start int, item_id {kind}, item_start int, length int"
    parts = [
        rows.mapInArrow(_matcher(spark.sparkContext.broadcast(block), _arrow(kind)), schema) for block in blocks_of(benchmark, **options)
    ]
    out = spark.createDataFrame([], schema)
    for part in parts:
        out = out.unionByName(part)
    return out


def _matcher(handle, id_type: pa.DataType) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        block = handle.value
        for batch in _grouped(batches):
            out = []
            for key, found in zip(batch.column(0).to_pylist(), scan(byte_texts(batch.column(1)), block), strict=True):
                hits = [
                    (row, place - offset, place, int(block.lengths[w]), item)
                    for place, w in zip(found.places.tolist(), found.windows.tolist(), strict=True)
                    for item, offset, row in block.sources[w]
                ]
                for (_, shift), run_ in itertools.groupby(sorted(hits), key=lambda h: h[:2]):
                    start = end = None
                    for _, _, place, length, item in run_:
                        if start is not None and place == last + 1:
                            end, last = place + length, place
                            continue
                        if start is not None:
                            out.append((key, start, item, start - shift, end - start))
                        start, end, last = place, place + length, place
                    out.append((key, start, item, start - shift, end - start))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [batch.schema.types[0], pa.int32(), id_type, pa.int32(), pa.int32()], strict=True)],
                names=["doc_id", "start", "item_id", "item_start", "length"],
            )

    return run


def item_digest(items: list[int | str]) -> str:
    """The digest of item ids that :func:`contamination` reports."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


_SQL_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def sql_longest() -> str:
    """:func:`longest_matches` in DuckDB SQL: occurrences of windows that follow each other on one diagonal are one match."""
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, {_SQL_WORDS} AS w FROM benchmark),
win AS (SELECT item, item_id, j, least(len(w), {WINDOW}) AS n, array_to_string(w[j:j + least(len(w), {WINDOW}) - 1], ' ') AS gram
  FROM (SELECT item, item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 2, 2))) AS j FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
gram AS (SELECT row, doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT row, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), sizes WHERE i + n - 1 <= len(w)),
occ AS (SELECT row, doc_id, item, item_id, i, j, n FROM gram JOIN win USING (n, gram)),
run AS (SELECT *, i - row_number() OVER (PARTITION BY row, item, i - j ORDER BY i) AS run FROM occ)
SELECT doc_id, CAST(min(i) - 1 AS INTEGER) AS start, item_id, CAST(min(j) - 1 AS INTEGER) AS item_start, CAST(max(i) + any_value(n) - min(i) AS INTEGER) AS length
FROM run GROUP BY row, doc_id, item, item_id, i - j, run"""


def sql_contamination() -> str:
    """The same in DuckDB SQL: windows as joined texts, one equality join per window length."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 2, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
gram AS (SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT row, w, unnest(range(1, len(w) + 1)) AS i FROM d), sizes WHERE i + n - 1 <= len(w)),
occ AS (SELECT row, i, n, item_id FROM gram JOIN win USING (n, gram)),
hit AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM occ) GROUP BY row),
its AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item_id FROM occ) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN its USING (row)"""
