"""Language identification by compression.

For each language a Zstandard dictionary holds raw text of that language. A text is compressed with every dictionary, stretch by stretch to its
end, so that the dictionary and not the text itself is what later parts refer to; the language with the smallest total is the answer. The score is how much smaller it is than the runner-up, on a scale from 0
to 1; answers with a narrow margin are marked as rejected.

Dictionaries are learned from a bounded sample: at most ``PER_LANGUAGE`` texts of a language outside the held-out fold, those with the
smallest hash of id and text, of which a stretch of ``EXCERPT`` characters at the end is used. Texts that were labelled wrongly or mix
languages would spoil a dictionary, so each half of the sample is first judged with dictionaries made from the other half, and texts
whose label is not confirmed are left out. What remains is laid end to end and the last ``DICTIONARY`` bytes are kept. Language, source
and id are no inputs of a prediction.

Every label gets a dictionary. ``LANGUAGES`` of them are made ready at a time: with more, each group of texts meets one block of dictionaries after
the other and keeps its two smallest totals, which is what one pass would find. The driver and a Python worker hold the raw content of all.
Confirming the sample on the driver takes time with the square of the number of labels.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; ties go to the language that sorts first; rows with equal
ids are judged one by one; without any labelled text every document is ``und``; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from confluo.llm.common import Batches, in_fold, pick, small_batches

FOLDS, HELD_OUT = 4, 2
LANGUAGES = 64
PER_LANGUAGE = 400
EXCERPT = 512
DICTIONARY = 112 << 10
LEVEL = 6
MARGIN = 0.02
STRETCH = 2048
NONE = "und"
# Marks stay with the letters they belong to; numbers of any kind, signs and blanks do not.
_NO_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> dict[str, bytes]:
    """Raw dictionary content of every language."""
    rows = pick(docs, doc_id, text, lang).toDF("doc_id", "text", "lang")
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
    # Counts of the languages; a share by hash bounds what is ranked, whatever the size of the input.
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return {}
    steps = 1 << 30
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], int(steps * min(1.0, 2 * per_language / r["count"])))])
    excerpt = F.substring(F.col("text"), -EXCERPT, EXCERPT).alias("excerpt")
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(steps)), "h", "doc_id")
    hashed = rows.withColumn("h", F.xxhash64("doc_id", "text"))

    def taken(some: DataFrame) -> list:
        chosen = some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
        return chosen.select("lang", "place", excerpt).orderBy("lang", "place").collect()

    got = taken(hashed.where(F.pmod("h", F.lit(steps)) <= F.element_at(shares, F.col("lang"))))
    # Languages of very many copies, of which no share holds one.
    missing = sorted({r["lang"] for r in counts} - {r["lang"] for r in got})
    if missing:
        got = sorted(got + taken(hashed.where(F.col("lang").isin(missing))), key=lambda r: (r["lang"], r["place"]))
    sample = [(r["lang"], _fold(r["excerpt"])) for r in got]
    return build([(language, text) for language, text in sample if text])


def build(sample: list[tuple[str, str]]) -> dict[str, bytes]:
    """Dictionaries from the sample's texts whose label the other half of the sample confirms."""
    halves = [_join(sample[0::2]), _join(sample[1::2])]
    confirmed = []
    for k, half in enumerate(halves):
        other = sample[1 - k :: 2]
        found = classify_all(_blocks(half), [text for _, text in other])
        confirmed += [(2 * i + 1 - k, x) for i, (x, f) in enumerate(zip(other, found, strict=True)) if x[0] == f[0]]
    confirmed = [x for _, x in sorted(confirmed)]
    # A language of which nothing is confirmed keeps what it has.
    return {**_join(sample), **_join(confirmed)}


def _join(sample: list[tuple[str, str]]) -> dict[str, bytes]:
    out: dict[str, list[str]] = {}
    for language, text in sample:
        out.setdefault(language, []).append(text)
    return {language: _end(" ".join(texts).encode()) for language, texts in sorted(out.items())}


def _fold(text: str) -> str:
    """Words in lower case, one blank between them: case, digits and signs say little about a language."""
    return _NO_LETTERS.sub(" ", text.lower()).strip() if _LETTER.search(text) else ""


def _end(data: bytes) -> bytes:
    if len(data) <= DICTIONARY:
        return data
    data = data[-DICTIONARY:]
    return data[data.find(b" ") + 1 :]


class Compressors:
    def __init__(self, content: tuple[tuple[str, bytes], ...], level: int = LEVEL):
        self.coders = []
        for language, data in content:
            words = zstandard.ZstdCompressionDict(data or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=level)
            self.coders.append((language, zstandard.ZstdCompressor(dict_data=words, level=level, write_checksum=False, write_content_size=False)))

    def smallest(self, text: str | None) -> list[tuple[int, str]]:
        """The two smallest totals and their languages."""
        folded = _fold(text) if text else ""
        if not folded:
            return []
        data = (" " + folded + " ").encode()
        stretches = [data[i : i + STRETCH] for i in range(0, len(data), STRETCH)]
        return sorted((sum(map(len, map(coder.compress, stretches))), language) for language, coder in self.coders)[:2]


def verdict(sizes: list[tuple[int, str]]) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow."""
    if not sizes:
        return NONE, 0.0, True
    if len(sizes) == 1:
        return sizes[0][1], 1.0, False
    margin = 1 - sizes[0][0] / sizes[1][0]
    return sizes[0][1], 1 - math.exp(-10 * margin), margin < MARGIN


Content = tuple[tuple[str, bytes], ...]


def _blocks(dictionaries: dict[str, bytes]) -> list[Content]:
    """At most ``LANGUAGES`` dictionaries each."""
    items = list(dictionaries.items())
    return [tuple(items[i : i + LANGUAGES]) for i in range(0, len(items), LANGUAGES)]


def classify_all(blocks: list[Content], texts: list[str | None]) -> list[tuple[str, float, bool]]:
    """The verdict on every text, one block of dictionaries after the other."""
    best: list[list[tuple[int, str]]] = [[] for _ in texts]
    for block in blocks:
        own = _compressors(block)
        best = [sorted(old + own.smallest(text))[:2] for old, text in zip(best, texts, strict=True)]
    return list(map(verdict, best))


@lru_cache(maxsize=1)
def _compressors(content: tuple[tuple[str, bytes], ...]) -> Compressors:
    return Compressors(content)


def _groups(batches: Batches, size: int = 16 << 20) -> Batches:
    """Join small batches up to a bound, so that a block is made ready for many texts."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def identify(docs: DataFrame, dictionaries: dict[str, bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every document."""
    small_batches(docs.sparkSession)
    # At most DICTIONARY bytes per language and LANGUAGES of them in one broadcast.
    shared = [docs.sparkSession.sparkContext.broadcast(block) for block in _blocks(dictionaries)]
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")

    def run(batches: Batches) -> Batches:
        blocks = [handle.value for handle in shared]
        for batch in batches if len(blocks) < 2 else _groups(batches):
            found = classify_all(blocks, batch.column(1).to_pylist())
            columns = [
                batch.column(0),
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[2] for x in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "rejected"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")
