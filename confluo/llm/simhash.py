"""SimHash near-duplicates, linked through deletion variants of fingerprint segments.

A text is cut into words at white space, A-Z lower-cased; its shingles are three words joined by a space, repeats included (all words, if
there are fewer). A fingerprint bit is set if more than half of the shingles' 64-bit hashes set it; a text without words has
fingerprint zero. Texts link when their fingerprints differ in at most two bits; groups are the connected components.

Two differing bits fall into two 32-bit segments, so one segment differs in at most one bit. Every distinct fingerprint is therefore
indexed under 64 variants: a segment with one of its bits deleted. Linked fingerprints agree on a variant; an equality join finds them,
and the full distance is verified. A pair is taken under its first common variant only, so nothing has to be made distinct.

Copies never multiply: the index holds distinct fingerprints. Where more than ``CROWD`` of them share a variant, joining them in
pairs would grow with the square, so these fingerprints are linked through midpoints instead: two values differ in at most two bits exactly if
they reach a common value by changing at most one bit each. Each such fingerprint is listed under its 65 values, and every list is linked to its
smallest member. That loses no link and adds none.

Components come from alternating star contractions (Kiveris et al. 2014) on the links alone; every round is stored in the shared folder.

Defined results: a NULL text has no words; rows with equal ids are one document of several texts, whose id may stand in several components;
an empty table gives an empty table; other columns are ignored. Deduplication goes by rows: one row of every component stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_digest

from confluo.llm.common import Batches, byte_texts, fresh, pick, small_batches, with_columns
from confluo.session import store_step

SHINGLE = 3
SEED = 42
DISTANCE = 2
CROWD = 32

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: bytes) -> bytes:
    """The 64-bit fingerprint of a UTF-8 text, most significant byte first."""
    words = text.translate(_LOWER).split()
    if not words:
        return bytes(8)
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxh64_digest(line, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    ends = (starts + lengths)[SHINGLE - 1 :].tolist()
    digests = b"".join([xxh64_digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends, strict=False)])
    return _majority(np.frombuffer(digests, np.uint8).reshape(-1, 8))


def _majority(hashes: np.ndarray, rows: int = 1 << 16) -> bytes:
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), rows):
        counts += np.unpackbits(hashes[i : i + rows], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def _fingerprints(batches: Batches) -> Batches:
    for batch in batches:
        prints = b"".join(map(fingerprint, byte_texts(batch.column(1))))
        values = np.frombuffer(prints, ">i8").astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp``: one row per document."""
    small_batches(docs.sparkSession)
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    return rows.mapInArrow(_fingerprints, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _bit(i: int) -> int:
    """One bit as a signed 64-bit number."""
    return (1 << i) - (1 << 64) if i == 63 else 1 << i


def _variants(fp: Column) -> Column:
    """64 (segment, deleted bit, rest) triples; the rest keeps the segment's bits in place."""
    out = []
    for i in range(64):
        segment = 0xFFFFFFFF if i < 32 else -(1 << 32)
        out.append(F.struct(F.lit(i).cast("tinyint").alias("bit"), fp.bitwiseAND(F.lit(segment & ~_bit(i))).alias("rest")))
    return F.array(*out)


def _first_common(diff: Column) -> Column:
    """The lowest deleted bit under which two fingerprints share a variant; NULL if there is none."""
    low, high = diff.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(diff, 32)

    def place(x: Column, base: int) -> Column:
        # A single set bit: its place is the number of ones below it.
        return F.when(x == 0, F.lit(base)).when(F.bit_count(x) == 1, F.bit_count(x - 1) + base)

    return F.coalesce(place(low, 0), place(high, 32))


def links(prints: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints whose links connect exactly what distances of at most two connect."""
    variants = prints.select("fp", F.inline(_variants(F.col("fp"))))
    crowd = F.count(F.lit(1)).over(Window.partitionBy("bit", "rest"))
    index = store_step(variants.withColumn("n", crowd).where("n > 1"), "simhash-index")
    quiet = index.where(F.col("n") <= CROWD).drop("n")
    left, right = quiet.withColumnRenamed("fp", "a"), quiet.withColumnRenamed("fp", "b")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (
        left.join(right, ["bit", "rest"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= DISTANCE) & (_first_common(diff) == F.col("bit")))
        .select("a", "b")
    )
    crowded = index.where(F.col("n") > CROWD).select("fp").distinct()
    reach = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_bit(i))) for i in range(64)])
    lists = crowded.select("fp", F.explode(reach).alias("near"))
    least = F.min("fp").over(Window.partitionBy("near"))
    stars = lists.select(least.alias("a"), F.col("fp").alias("b")).where("a < b").distinct()
    return pairs.unionByName(stars)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has a link; the root is the smallest node of its component.

    Large and small stars by turns: a node's minimum comes from a plain aggregate, which merges on the map side, so a hub costs no
    more than its links, and the join back to the links can be split.
    """
    edges = store_step(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    last = None
    while True:
        # Large star: all larger neighbours of u go to the smallest neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u > v")
        # Small star: all smaller neighbours of u, and u itself, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u > v").distinct()
        edges = store_step(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _rooted(prints: DataFrame) -> DataFrame:
    """``fp, first, root`` for every distinct fingerprint: its smallest id and the smallest fingerprint of its component."""
    distinct = store_step(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(distinct.select("fp")))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id``: the component is named by the smallest id reachable, the document's own included."""
    prints = store_step(fingerprints(docs, doc_id, text), "simhash")
    linked = _rooted(prints)
    named = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = linked.join(named, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_fingerprint(docs: DataFrame, text: str, name: str) -> DataFrame:
    """All columns of ``docs`` and the fingerprint of the text."""
    small_batches(docs.sparkSession)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            prints = b"".join(map(fingerprint, byte_texts(batch.column(batch.schema.get_field_index(text)))))
            yield with_columns(batch, [], **{name: pa.array(np.frombuffer(prints, ">i8").astype(np.int64), pa.int64())})

    return docs.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{name}` bigint"]))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component, with the columns it came with.

    The row with the smallest id stays, a row without an id only where no other is in the component. Of several rows with that id the one
    with the smallest fingerprint stays, then the one with the smallest hash of its columns. Where no id is repeated or missing, the
    id alone says which row it is, and texts are not read a second time.
    """
    prints = store_step(fingerprints(docs, doc_id, text), "simhash")
    linked = _rooted(prints)
    first = F.min(F.struct(F.col("first").isNull().alias("unnamed"), F.col("first").alias("id"), F.col("fp").alias("print"))).alias("w")
    winners = store_step(linked.groupBy("root").agg(first).select("w.id", "w.print"), "winners")
    named = prints.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count() == 0
    if named:
        return docs.join(winners.select(F.col("id").alias(doc_id)), doc_id, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    fp, tie, row = fresh(docs, "fp", "tie", "row_")
    printed = _with_fingerprint(docs, text, fp)
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("id")) & (F.col(fp) == F.col("print"))
    chosen = printed.join(winners, same, "left_semi")
    # Maps have no hash.
    plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    chosen = chosen.select(F.col(f"`{doc_id}`").alias(f"{row}id"), F.col(fp).alias(f"{row}fp"), F.xxhash64(*plain).alias(tie), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    return chosen.groupBy(f"{row}id", f"{row}fp").agg(F.min_by(row, tie).alias(row)).select(f"{row}.*")
