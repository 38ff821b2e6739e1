"""Shard documents by descending a weighted hash tree of regions, racks and shards.

Every inner node draws among its children: a child's straw is ``-ln(u) / weight`` with ``u`` hashed from the document id and the
child's name, and the shortest straw wins, so a child gets its share of the weight. A draw looks at the children of one node only.
When a weight changes, straws of other children stay what they were: below a node, documents move only into children whose
weight grew or out of children whose weight shrank, and subtrees off the changed path keep their documents among themselves.
:func:`grow` hangs a new shard under a region and a rack of its own, so growth moves documents into the new shard alone.

Everything is built from SQL functions. The tree is a literal in the plan: one entry per region, rack and shard.

Defined results: a NULL id draws as the empty text; a NULL text has no bytes and the checksum of the empty text; rows with equal ids
go to the same shard and get slots next to each other; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from confluo.llm.common import fresh, pick
from confluo.session import store_step

ROW_OVERHEAD = 16
# 52 hash bits, so that the draw is exact in a double.
HASH_DIGITS = 13


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


Topology = tuple[Leaf, ...]


def layout(shards: int = 40, per_rack: int = 4, racks_per_region: int = 2) -> Topology:
    """Equal shards, filled rack by rack and region by region."""
    return tuple(Leaf(i // (per_rack * racks_per_region), i // per_rack, i) for i in range(shards))


def grow(topology: Topology, weight: float = 1.0) -> Topology:
    """One more shard, under a region and a rack of its own."""
    return (
        *topology,
        Leaf(
            max((x.region for x in topology), default=-1) + 1,
            max((x.rack for x in topology), default=-1) + 1,
            max((x.shard for x in topology), default=-1) + 1,
            weight,
        ),
    )


def hash_text(key: Column, name: str | Column) -> Column:
    """52 bits of the MD5 of ``name`` and the key, as a long."""
    name = F.lit(name) if isinstance(name, str) else name
    return F.conv(F.substring(F.md5(F.concat_ws(":", name, key).cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def _draw(key: Column, level: str, children: Column) -> Column:
    """The child with the shortest straw among ``children``, an array of (name, weight); ties go to the smaller name."""

    def straw(child: Column) -> Column:
        bits = hash_text(key, F.concat(F.lit(level), child["name"].cast("string")))
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 4 * HASH_DIGITS))
        return F.struct((-F.ln(u) / child["weight"]).alias("length"), child["name"].alias("name"))

    return F.array_min(F.transform(children, straw))["name"]


def _children(pairs: dict[int, float]) -> Column:
    return F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in sorted(pairs.items()) if w > 0]
    )


def _table(topology: Topology, parent: str, child: str) -> Column:
    """A map literal from a node to its weighted children."""
    nodes: dict[int, dict[int, float]] = {}
    for leaf in topology:
        below = nodes.setdefault(getattr(leaf, parent), {})
        below[getattr(leaf, child)] = below.get(getattr(leaf, child), 0.0) + leaf.weight
    entries = [x for n, c in sorted(nodes.items()) if sum(c.values()) > 0 for x in (F.lit(n), _children(c))]
    return F.create_map(*entries)


def place(df: DataFrame, key: str, topology: Topology, out: str) -> DataFrame:
    """Add the shard that the key's descent ends in."""
    if not any(x.weight > 0 for x in topology) or any(x.weight < 0 for x in topology):
        raise ValueError("weights must not be negative, and one must be above zero")
    regions: dict[int, float] = {}
    for leaf in topology:
        regions[leaf.region] = regions.get(leaf.region, 0.0) + leaf.weight
    region, rack, out_ = *fresh(df, "region", "rack"), out
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return (
        df.withColumn(region, _draw(text, "region", _children(regions)))
        .withColumn(rack, _draw(text, "rack", F.element_at(_table(topology, "region", "rack"), F.col(region))))
        .withColumn(out_, _draw(text, "shard", F.element_at(_table(topology, "rack", "shard"), F.col(rack))))
        .drop(region, rack)
    )


def shard_documents(docs: DataFrame, topology: Topology | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes, checksums, shards and gapless slots of all documents.

    Slots follow the order (hash of the id, id, checksum) inside a shard. Rows are range-partitioned in that order with the row number
    as last key, so neither a large shard nor a repeated id lands in one task; a slot is the place in its partition plus the counts
    of earlier partitions, which are one row per shard and partition.
    """
    topology = layout() if topology is None else topology
    utf8 = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = pick(docs, key, text).toDF("doc_id", "text")
    rows = rows.select(
        "doc_id",
        (F.octet_length(utf8) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"),
        F.lit("key").alias("law"),
        hash_text(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "slot").alias("h"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = store_step(place(place(rows, "doc_id", topology, "shard"), "doc_id", grow(topology), "grown_shard"), "shards")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["shard", "h", "doc_id", "text_crc32", "row"]
    ordered = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ordered = store_step(ordered.withColumn("place", F.monotonically_increasing_id()).drop("h", "row"), "slots")
    part = F.shiftright("place", 33).alias("part")
    runs = ordered.groupBy("shard", part).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # One row per shard and partition, two longs each: at most (shards + partitions) rows, as partitions are ranges.
    slots = ordered.withColumn("part", part).join(F.broadcast(runs), ["shard", "part"])
    return slots.select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("place") - F.col("first") + F.col("before")).alias("slot"), "grown_shard"
    )


def sql_crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes in DuckDB SQL, byte by byte over the usual table."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(str(value))
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    step = f"lambda c, b: xor(c >> 8, [{', '.join(table)}][xor(c & 255, b) + 1])"
    return f"xor(list_reduce(list_concat([{0xFFFFFFFF}::BIGINT], {data}), {step}), {0xFFFFFFFF})"


def sql_shards(topology: Topology | None = None) -> str:
    """The same in DuckDB SQL: the tree as tables, a draw per level as a minimum over joined children."""
    topology = layout() if topology is None else topology

    def tree(t: Topology, tag: str) -> str:
        rows = ", ".join(f"({x.region}, {x.rack}, {x.shard}, CAST({x.weight} AS DOUBLE))" for x in t)
        u = f"(CAST(CAST('0x' || substr(md5('%s' || %s || ':' || doc_id), 1, {HASH_DIGITS}) AS BIGINT) AS DOUBLE) + 0.5) / {float(1 << 4 * HASH_DIGITS)}"

        def level(name: str, parents: str, source: str) -> str:
            straw = f"-ln({u % (name, 'c.' + name)}) / c.weight"
            on = f"USING ({parents})" if parents else "ON true"
            group = f"GROUP BY {parents + ', ' if parents else ''}{name}"
            cols = f"{parents + ', ' if parents else ''}{name}"
            return (
                f"{tag}_{name} AS (SELECT doc_id, min(ROW({straw}, c.{name})) AS best FROM {source} d JOIN "
                f"(SELECT {cols}, sum(weight) AS weight FROM {tag} {group}) c {on} GROUP BY doc_id)"
            )

        ids = "(SELECT DISTINCT doc_id FROM documents)"
        return f"""{tag}(region, rack, shard, weight) AS (VALUES {rows}),
{level("region", "", ids)},
{tag}_r AS (SELECT doc_id, best[2] AS region FROM {tag}_region),
{level("rack", "region", tag + "_r")},
{tag}_k AS (SELECT doc_id, best[2] AS rack FROM {tag}_rack),
{level("shard", "rack", tag + "_k")},
{tag}_s AS (SELECT doc_id, best[2] AS shard FROM {tag}_shard)"""

    return f"""WITH {tree(topology, "now")},
{tree(grow(topology), "later")},
crc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
rows AS (SELECT c.doc_id, CAST(strlen(text) + {ROW_OVERHEAD} AS BIGINT) AS size, {sql_crc32("text")} AS text_crc32, n.shard AS shard, l.shard AS grown_shard,
  CAST('0x' || substr(md5('slot:' || c.doc_id), 1, {HASH_DIGITS}) AS BIGINT) AS h
  FROM crc c JOIN now_s n USING (doc_id) JOIN later_s l USING (doc_id))
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY h, doc_id) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard FROM rows"""
