"""Spelling variants by blocked Gram matrices of letter counts.

Words are runs of ``A-Z``, ``a-z`` and U+00C0 to U+00FF, only A-Z lower-cased, so every letter is one Latin-1 byte. One inserted or deleted letter
changes one letter count by one (squared distance 1, lengths differ by one); one replaced letter changes two counts (squared distance 2,
equal lengths). Pairs at a greater squared distance cannot be near.

Blocks: letters fall into ``GROUPS`` groups by code, and the words of one block have the same number of letters of every group, hence the same
length. Near words lie in one block, or in blocks whose group counts differ by one in one group (adjacent lengths), or by one up and
one down in two groups. A block is cut into chunks of bounded size. Each pair of chunks of one or of two such blocks meets once, by
an equality join on the block's key; NumPy multiplies their count matrices (with the squares as two more columns, so that the product is
the squared distance), keeps pairs at most two apart, and verifies one edit by common prefix and suffix. What a pair of chunks yields
is, per word, the number of near words and the best of them; no pairs are stored.

No chunk, task or driver holds more than a bounded number of words: large blocks are many chunks, adaptive execution splits the join
partitions of a crowded key.

Forms lead to a word at least ``FACTOR`` times as frequent, so a way of forms is shorter than the digits of the greatest count, and
``HOPS`` doublings of the way reach the end of any.

Defined results: a NULL text has no words; a NULL id counts as the empty text in the checksum; rows with equal ids are separate documents;
other columns are ignored; tables without repeated words give an empty table; words of any length are taken whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import Batches, pick, small_batches, str_texts
from confluo.llm.sharding import sql_crc32
from confluo.session import store_step

LEAST_LETTERS = 7
LEAST_COUNT = 2
FACTOR = 10
EVERY = 31
GROUPS = 6
CHUNK_WORDS = 1024
CHUNK_BYTES = 1 << 16
HOPS = 5  # 2^5 forms in a row would need a count of 2 * 10^32
HELD = 400_000

_LETTERS = {*range(0x61, 0x7B), *range(0xC0, 0x100)}
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256))


def runs_of(text: str) -> list[bytes]:
    """Maximal runs in order, as Latin-1 bytes; whatever Latin-1 lacks is no letter."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def misspell(run: bytes, seed: int) -> bytes:
    """The run, or the run without one letter, by the checksum of ``<doc_id>:<run>``; ``seed`` is that of ``<doc_id>:``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of all words with enough letters and occurrences; tasks add up before the shuffle, a bounded number of words at a time."""
    small_batches(docs.sparkSession)
    rows = pick(docs, doc_id, text).toDF("doc_id", "text").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Batches) -> Batches:
        counts: Counter = Counter()
        for batch in batches:
            for i, body in zip(batch.column(0).to_pylist(), str_texts(batch.column(1)), strict=True):
                seed = zlib.crc32(f"{i}:".encode())
                for word, n in Counter([r for r in runs_of(body) if len(r) >= LEAST_LETTERS]).items():
                    word = misspell(word, seed)
                    if len(word) >= LEAST_LETTERS:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    found = rows.mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# Blocks ---------------------------------------------------------------------------------------------------------------


def block_key(word: bytes) -> tuple[int, ...]:
    """Letters per group."""
    counts = Counter(b % GROUPS for b in word)
    return tuple(counts[g] for g in range(GROUPS))


def key_text(key: tuple[int, ...]) -> str:
    return ".".join(map(str, key))


def lower_neighbours(key: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
    """Keys of the blocks beside it that come earlier: one letter less, or one letter moved to a later group."""
    for i, n in enumerate(key):
        if n:
            less = (*key[:i], n - 1, *key[i + 1 :])
            yield less
            for j in range(i + 1, len(key)):
                yield (*less[:j], less[j] + 1, *less[j + 1 :])


CHUNK_SCHEMA = "key string, chunk string, words binary, counts binary, guests array<string>"


def cut_chunks(words: DataFrame) -> DataFrame:
    """Blocks as rows of at most ``CHUNK_WORDS`` words or about ``CHUNK_BYTES`` letters: ``key, chunk, words, counts, guests``.

    ``chunk`` is the first word, ``guests`` are the keys of the earlier blocks a chunk has to meet besides its own.
    """
    small_batches(words.sparkSession, 8192)
    per_group = [F.length(F.regexp_replace("word", f"[^{_group_letters(g)}]", "")) for g in range(GROUPS)]
    keyed = words.select(F.concat_ws(".", *[c.cast("string") for c in per_group]).alias("key"), "word", "n")
    dealt = keyed.hint("rebalance", F.col("key")).sortWithinPartitions("key", "word")

    def row(key: str, words_: list[str], counts: list[int]) -> tuple:
        own = tuple(map(int, key.split(".")))
        guests = [key_text(k) for k in lower_neighbours(own)]
        return key, words_[0], "\n".join(words_).encode("latin-1"), np.array(counts, np.int64).tobytes(), guests

    def run(batches: Batches) -> Batches:
        key, held, counts, size = None, [], [], 0
        for batch in batches:
            out = []
            for k, w, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (k != key or len(held) >= CHUNK_WORDS or size >= CHUNK_BYTES):
                    out.append(row(key, held, counts))
                    held, counts, size = [], [], 0
                key = k
                held.append(w)
                counts.append(n)
                size += len(w)
            if out:
                yield _chunk_batch(out)
        if held:
            yield _chunk_batch([row(key, held, counts)])

    return dealt.mapInArrow(run, CHUNK_SCHEMA)


def _group_letters(group: int) -> str:
    return "".join(f"\\x{{{b:x}}}" for b in sorted(_LETTERS) if b % GROUPS == group)


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.string())]
    names = ["key", "chunk", "words", "counts", "guests"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


# Products -------------------------------------------------------------------------------------------------------------


class Chunk:
    """Words as rows of bytes: ``flat`` letters, ``starts``, ``lengths``, counts ``n`` and letter counts."""

    def __init__(self, words: bytes, counts: bytes):
        self.words = words.split(b"\n")
        self.n = np.frombuffer(counts, np.int64)
        self.lengths = np.array([len(w) for w in self.words])
        self.starts = np.cumsum(self.lengths) - self.lengths
        # Reading a few places past the last letter must not fail.
        self.flat = np.frombuffer(b"".join(self.words) + b"\0" * (int(self.lengths.max()) + 1), np.uint8)
        at = np.repeat(np.arange(len(self.words)), self.lengths) * 256 + self.flat[: int(self.lengths.sum())]
        self.letters = np.bincount(at, minlength=256 * len(self.words)).reshape(-1, 256)

    def padded(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Letters of some words from the left; what lies past a word's end is not looked at."""
        return self.flat[np.minimum(self.starts[rows][:, None] + np.arange(width), len(self.flat) - 1)]


def close_pairs(a: Chunk, b: Chunk, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs with squared distance of at most two; each pair once where both are the same chunk."""
    used = np.flatnonzero(a.letters.any(axis=0) | b.letters.any(axis=0))
    # Squares of counts stay exact below 2^24 in single precision.
    kind = np.float32 if max(a.lengths.max(), b.lengths.max()) < 2000 else np.float64
    x, y = a.letters[:, used].astype(kind), b.letters[:, used].astype(kind)
    one_a, one_b = np.ones((len(x), 1), kind), np.ones((len(y), 1), kind)
    left = np.hstack([x, (x * x).sum(axis=1, keepdims=True), one_a])
    right = np.hstack([-2 * y, one_b, (y * y).sum(axis=1, keepdims=True)])
    rows, columns = np.nonzero(left @ right.T <= 2)
    if same:
        rows, columns = rows[rows < columns], columns[rows < columns]
    return rows, columns


def one_edit(a: Chunk, rows: np.ndarray, b: Chunk, columns: np.ndarray) -> np.ndarray:
    """True where exactly one letter is replaced, or one is missing on either side: common prefix and suffix cover the rest."""
    out = np.zeros(len(rows), bool)
    la, lb = a.lengths[rows], b.lengths[columns]
    width = int(max(a.lengths.max(), b.lengths.max()))
    step = max(1, (4 << 20) // max(width, 1))
    for at in range(0, len(rows), step):
        part = slice(at, at + step)
        r, c = rows[part], columns[part]
        short = np.minimum(la[part], lb[part])
        place = np.arange(width)
        inside = place < short[:, None]
        left = (a.padded(r, width) == b.padded(c, width)) | ~inside
        prefix = np.where(left.all(axis=1), short, left.argmin(axis=1))
        ends_a, ends_b = (a.starts[r] + la[part])[:, None] - 1 - place, (b.starts[c] + lb[part])[:, None] - 1 - place
        right = (a.flat[np.maximum(ends_a, 0)] == b.flat[np.maximum(ends_b, 0)]) | ~inside
        suffix = np.where(right.all(axis=1), short, right.argmin(axis=1))
        longer = np.abs(la[part] - lb[part])
        replaced = (longer == 0) & (prefix + suffix == short - 1)
        out[part] = replaced | ((longer == 1) & (prefix + suffix >= short))
    return out


class Nearest:
    """Per word the number of near words so far and the best: greatest count, then smallest."""

    def __init__(self) -> None:
        self.found: dict[bytes, tuple[int, int, bytes]] = {}

    def add(self, chunk: Chunk, rows: np.ndarray, other: Chunk, columns: np.ndarray) -> None:
        """``columns`` of the other chunk are near ``rows``. Words of a chunk are sorted, so a smaller row is a smaller word."""
        order = np.lexsort((columns, -other.n[columns], rows))
        rows, columns = rows[order], columns[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        sizes = np.diff(np.r_[first, len(rows)])
        found, words, others = self.found, chunk.words, other.words
        for r, c, n, total in zip(rows[first].tolist(), columns[first].tolist(), other.n[columns[first]].tolist(), sizes.tolist(), strict=True):
            word, best = words[r], (-n, others[c])
            known = found.get(word)
            found[word] = (total, *best) if known is None else (total + known[0], *min(best, known[1:]))

    def take(self) -> pa.RecordBatch:
        words, values = list(self.found), list(self.found.values())
        self.found = {}
        columns = [
            pa.array([w.decode("latin-1") for w in words], pa.string()),
            pa.array([v[0] for v in values], pa.int64()),
            pa.array([-v[1] for v in values], pa.int64()),
            pa.array([v[2].decode("latin-1") for v in values], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of all words that have a near one; ``words(word, n)`` has each word once."""
    chunks = store_step(cut_chunks(words), "chunks")
    small_batches(words.sparkSession, 128)
    hosts = chunks.select("key", F.col("chunk").alias("host"), F.col("words").alias("host_words"), F.col("counts").alias("host_counts"))
    guests = chunks.select(F.explode(F.array_append("guests", F.col("key"))).alias("target"), F.col("key").alias("home"), "chunk", "words", "counts")
    meet = (F.col("home") != F.col("key")) | (F.col("chunk") >= F.col("host"))
    pairs = hosts.join(guests, F.col("key") == F.col("target")).where(meet).select("host", "host_words", "host_counts", "home", "key", "chunk", "words", "counts")

    def run(batches: Batches) -> Batches:
        nearest, name, host = Nearest(), None, None
        for batch in batches:
            for own, host_words, host_counts, home, key, chunk, guest_words, guest_counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if host is None or name != (key, own):
                    name, host = (key, own), Chunk(host_words, host_counts)
                same = home == key and own == chunk
                guest = host if same else Chunk(guest_words, guest_counts)
                rows, columns = close_pairs(host, guest, same)
                if len(rows):
                    keep = one_edit(host, rows, guest, columns)
                    rows, columns = rows[keep], columns[keep]
                    if len(rows):
                        nearest.add(host, rows, guest, columns)
                        nearest.add(guest, columns, host, rows)
                if len(nearest.found) >= HELD:
                    yield nearest.take()
        yield nearest.take()

    found = pairs.mapInArrow(run, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("neg"), F.col("best").alias("best")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return merged.select("word", "n_near", (-F.col("b.neg")).alias("best_n"), F.col("b.best").alias("best"))


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word: its more frequent spelling, and the last one reached that way."""
    words = store_step(count_words(docs, doc_id, text), "words")
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= FACTOR * F.col("n")
    formed = store_step(
        near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")),
        "forms",
    )
    # Doubling: where a way leads after 1, 2, 4, ... steps; a word that leads nowhere ends it.
    ways = formed.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    for _ in range(HOPS):
        on = ways.select(F.col("word").alias("to"), F.col("to").alias("further"))
        ways = store_step(ways.join(on, "to", "left").select("word", F.coalesce("further", "to").alias("to")), "ways")
    rooted = formed.join(ways, "word", "left")
    return rooted.select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")


def sql_variants() -> str:
    """The same in DuckDB SQL: near words share what is left when one letter is taken out at one place."""
    lower = f"translate(text, '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
    return f"""WITH RECURSIVE run AS (SELECT doc_id, unnest(regexp_extract_all({lower}, '[a-zÀ-ÿ]+')) AS r FROM documents),
one AS (SELECT doc_id, r, count(*) AS k, {sql_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r")} AS h FROM run WHERE length(r) >= {LEAST_LETTERS} GROUP BY doc_id, r),
made AS (SELECT CASE WHEN h % {EVERY} = 0 THEN left(r, CAST(h % length(r) AS INTEGER)) || substr(r, CAST(h % length(r) AS INTEGER) + 2) ELSE r END AS word, k FROM one),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM made WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
pair AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near, max(n) AS best_n FROM pair GROUP BY word),
best AS (SELECT near.word, n_near, best_n, min(other) AS best FROM near JOIN pair ON pair.word = near.word AND pair.n = best_n GROUP BY ALL),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {FACTOR} * n THEN best END AS form, CASE WHEN best_n >= {FACTOR} * n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
way AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON f.word = way.next)
SELECT f.word, form, way.at AS root, n, n_near, form_n FROM f JOIN way ON way.word = f.word AND way.next IS NULL"""
