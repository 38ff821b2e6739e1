"""Concatenate and cut: pack token sequences of all documents into windows of fixed length.

Pass one encodes every document once, ends it with the separator, and stores ids with the document's place inside its partition and the
partition's number. The totals of the partitions, one number each, are summed up in order; the sums are the global offsets of the
partitions. Pass two reads the stored ids, adds its partition's offset, and cuts at multiples of the window: a document that crosses a
border leaves a boundary record on each side. Nothing is shuffled, only the last window is padded, and both passes can be repeated
from stored tables when an executor is lost.

Ids are those of the library for the vocabulary file, without added special tokens; strings of special tokens inside a text become these tokens,
as the library does by default. Pieces that repeat in a batch of texts are encoded once.

Defined results: a NULL text is empty and gives the separator alone; rows with equal ids are packed one by one; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from confluo.llm.bpe import PATTERN, PieceEncoder, Vocabulary, settled
from confluo.llm.common import Batches, pick, small_batches, str_texts
from confluo.session import store_step

SEQUENCE = 2048
SEPARATOR = 1
# Rows of an Arrow batch, and characters of texts that are encoded together; a longer text is one group.
ROWS = 2048
GROUP_CHARS = 4 << 20
_WHITE = re.compile(r"[^\S\n]")
PIECES = "start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint, ids binary"


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.vocabulary.ids, special_tokens={})
        self.codes = [i.to_bytes(4, "little") for i in range(max(self.vocabulary.ids.values()) + 1)]
        self.lengths = np.zeros(len(self.codes), np.int64)
        for token, i in self.vocabulary.ids.items():
            self.lengths[i] = len(token)
        self.pieces = PieceEncoder(self._pieces)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that encode on their own; they are handed over as one text and told apart by their bytes."""
        line = "".join(pieces)
        if not settled(line):
            # Both libraries hold the same vocabulary; where their character tables could differ, the slower one decides.
            return [self._codes(self.library.encode(p, add_special_tokens=False).ids) if not settled(p) else self._codes(self.fast.encode_ordinary(p)) for p in pieces]
        ids = np.array(self.fast.encode_ordinary(line), "<u4")
        codes = ids.tobytes()
        if len(pieces) < 2:
            return [codes] * len(pieces)
        ends = np.cumsum(self.lengths[ids])
        cuts = [0, *(4 * np.searchsorted(ends, np.cumsum(list(map(len, map(str.encode, pieces))))) + 4).tolist()]
        return [codes[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _codes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.codes.__getitem__, ids))

    def encode(self, text: str) -> bytes:
        out = []
        for i, part in enumerate(self.vocabulary.cut(text)):
            out += [self._special(part)] if i % 2 else self.pieces.parts(part)
        return b"".join(out)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The same for many texts at once."""
        cuts = list(map(self.vocabulary.cut, texts))
        parts = chain.from_iterable(map(self._together, _groups([p for c in cuts for p in c[::2]])))
        return [b"".join(self._special(p) if i % 2 else next(parts) for i, p in enumerate(c)) for c in cuts]

    def _together(self, texts: list[str]) -> list[bytes]:
        """Texts cut as :class:`PieceEncoder` does; each different piece is encoded once, and its ids are put where it occurs."""
        plain = [i for i, t in enumerate(texts) if t and not (t[0].isspace() or t[-1].isspace())]
        cut = [texts[i].replace("\n", " \n").partition(" ") for i in plain]
        # With line breaks between them, first pieces encode on their own as well.
        first = self._pieces([x for c in cut for x in ("\n", c[0])][1:])[::2] if cut else []
        pieces = pc.split_pattern(pa.array([c[2] or None for c in cut], pa.string()), " ")
        told = pieces.flatten().dictionary_encode()
        known, odd = self._different(told.dictionary.to_numpy(zero_copy_only=False).tolist())
        index = told.indices.to_numpy()
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts, n = np.cumsum(sizes) - sizes, sizes[index]
        ends = np.cumsum(n)
        numbers = np.frombuffer(b"".join(known), "<u4")
        line = numbers[np.repeat(starts[index] - ends + n, n) + np.arange(n.sum())].tobytes()
        last = np.cumsum(pc.fill_null(pieces.value_lengths(), 0).to_numpy())
        at = [0, *(4 * np.concatenate([[0], ends])[last]).tolist()]
        odd_at = [0, *np.concatenate([[0], np.cumsum(odd[index])])[last].tolist()]
        out = [None if t else b"" for t in texts]
        for k, i in enumerate(plain):
            if odd_at[k] == odd_at[k + 1]:
                out[i] = first[k] + line[at[k] : at[k + 1]]
        return [self._pieces([t])[0] if x is None else x for x, t in zip(out, texts, strict=True)]

    def _different(self, pieces: list[str]) -> tuple[list[bytes], np.ndarray]:
        """Ids of pieces, and which have white space at a border: texts with such are encoded whole."""
        if _WHITE.search("".join(pieces)):
            odd = [not p or p[-1].isspace() or p.lstrip("\n")[:1].isspace() for p in pieces]
        else:
            odd = [p in ("", "\n") for p in pieces]
        good = [p if p[0] == "\n" else " " + p for p, o in zip(pieces, odd, strict=True) if not o]
        if not settled("".join(good)):
            few = {p: self._pieces([p])[0] for p in good if not settled(p)}
            rest = iter(self._pieces([p for p in good if p not in few]))
            ids = iter([few[p] if p in few else next(rest) for p in good])
        else:
            ids = iter(self._pieces(good))
        return [b"" if o else next(ids) for o in odd], np.array(odd, np.int64)

    def _special(self, token: str) -> bytes:
        return np.array([self.vocabulary.special[token]], "<u4").tobytes()


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _encode(path: str, separator: int):
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Batches) -> Batches:
        own, part, place = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = str_texts(batch.column(1))
            ids = [x + end for x in own.encode_all(texts)]
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            places = place + np.cumsum(sizes) - sizes
            place += int(sizes.sum())
            columns = [batch.column(0), pa.array([part] * len(ids), pa.int64()), pa.array(places), pa.array(sizes), pa.array(_narrow(ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "place", "doc_tokens", "ids"])

    return run


def _narrow(ids: list[bytes]) -> list[bytes]:
    """Two bytes a token where all ids of a document fit, marked by the length; halves what is stored."""
    out = []
    for x in ids:
        wide = np.frombuffer(x, "<u4")
        out.append(wide.astype("<u2").tobytes() if wide.max() < 1 << 16 else x)
    return out


def _wide(stored: bytes, n: int) -> bytes:
    return stored if len(stored) == 4 * n else np.frombuffer(stored, "<u2").astype("<u4").tobytes()


def encode_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, separator: int = SEPARATOR) -> DataFrame:
    """Pass one, stored: ids of every document with its partition and its place there."""
    small_batches(docs.sparkSession, ROWS)
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, part bigint, place bigint, doc_tokens bigint, ids binary"
    return store_step(rows.mapInArrow(_encode(path or default_vocabulary(), separator), schema), "packing")


def offsets(encoded: DataFrame) -> DataFrame:
    """``part, base``: what all earlier partitions hold. One row per partition, so one task sums them up."""
    totals = encoded.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def _cut(size: int, keep_ids: bool):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns = batch.to_pydict()
            out = {n: [] for n in ("doc_id", "doc_tokens", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")}
            for key, n, first, stored in zip(columns["doc_id"], columns["doc_tokens"], columns["first"], columns["ids"], strict=True):
                ids, start = _wide(stored, n), 0
                while start < n:
                    sequence, offset = divmod(first + start, size)
                    length = min(size - offset, n - start)
                    piece = ids[4 * start : 4 * (start + length)]
                    row = (key, n, start, length, zlib.crc32(piece), sequence, offset, piece if keep_ids else None)
                    for values, value in zip(out.values(), row, strict=True):
                        values.append(value)
                    start += length
            types = [batch.schema.types[0], *[pa.int64()] * 6, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    return run


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    path: str | None = None,
    separator: int = SEPARATOR,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, ``ids``."""
    encoded = encode_documents(docs, doc_id, text, path, separator)
    # One row of two numbers per partition of the input.
    placed = encoded.join(F.broadcast(offsets(encoded)), "part")
    kind = encoded.schema["doc_id"].dataType.simpleString()
    pieces = placed.select("doc_id", "doc_tokens", (F.col("base") + F.col("place")).alias("first"), "ids").mapInArrow(
        _cut(size, keep_ids), f"doc_id {kind}, doc_tokens bigint, {PIECES}"
    )
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pieces.select(*names, *["ids"] * keep_ids)
