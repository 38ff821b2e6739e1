"""Multi-source aggregation: average score per entity over the sources that hold it, then top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from confluo.functions.scoring import rounded
from confluo.operators.tables import own_entity


def _score_column(i: int) -> str:
    return f"score_{i}"


def fuse_sources(hits: DataFrame, sources: Sequence[str]) -> DataFrame:
    """One row per (query, entity) with its score in every registered source, null where it did not match.

    Resolution is one to one, so a source holds an entity in one document. Should a catalogue break that, its best score counts
    here, and the directory shows its smallest id.
    """
    scores = [
        F.max(F.when(F.col("source") == s, F.col("score"))).alias(_score_column(i)) for i, s in enumerate(sources)
    ]
    # Rows of unregistered sources go after grouping, so that the hits are read the same way here and in ``with_hits``
    # and their shuffle is shared.
    matched = F.coalesce(*[F.col(_score_column(i)) for i, _ in enumerate(sources)]).isNotNull()
    return hits.groupBy("query_id", own_entity().alias("entity_id")).agg(*scores).where(matched)


def _total(sources: Sequence[str]):
    total = F.lit(0.0)
    for i, _ in enumerate(sources):
        total = total + F.coalesce(F.col(_score_column(i)), F.lit(0.0))
    return total


def average(fused: DataFrame, directory: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Mean over the sources that contain the entity; a source that has it but did not match counts as zero."""
    return fused.join(directory, "entity_id").withColumn("total_score", _total(sources) / F.col("n_sources"))


def fill_missing(fused: DataFrame, directory: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Every matched entity with all its documents: ``query_id, entity_id, source, id, score``, 0 where a document did not match."""
    order = F.create_map(*[F.lit(x) for i, s in enumerate(sources) for x in (s, i)])
    scores = F.array(*[F.coalesce(F.col(_score_column(i)), F.lit(0.0)) for i, _ in enumerate(sources)])
    rows = fused.withColumn("scores", scores).join(directory, "entity_id").select("query_id", "entity_id", "scores", F.explode("docs").alias("d"))
    return rows.select("query_id", "entity_id", "d.source", "d.id", F.get("scores", F.element_at(order, F.col("d.source"))).alias("score"))


def prune(fused: DataFrame, sources: Sequence[str], k: int) -> DataFrame:
    """Drop entities that cannot reach the top ``k``, before their source counts are looked up.

    The mean lies between sum / all sources and the best single score. Whoever's best score is below the k-th largest
    lower bound of the query is out, whatever its source count.
    """
    if len(sources) == 1:
        return fused
    best = F.greatest(*[F.coalesce(F.col(_score_column(i)), F.lit(0.0)) for i, _ in enumerate(sources)])
    bounded = fused.withColumn("low", _total(sources) / F.lit(len(sources))).withColumn("high", best)
    lows = bounded.select("query_id", "low").withColumn(
        "place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("low").desc()))
    )
    floor = lows.where(F.col("place") <= k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("low")).otherwise(F.lit(0.0)).alias("floor")
    )
    # Ranks compare rounded scores, so keep everything that rounds up to the floor.
    kept = bounded.join(floor, "query_id").where(rounded(F.col("high")) >= rounded(F.col("floor")))
    return kept.drop("low", "high", "floor")


def only_entities(directory: DataFrame, fused: DataFrame) -> DataFrame:
    """The directory of the entities in question: the semi-join moves below the directory's grouping, to the catalogue's rows."""
    return directory.join(fused.select("entity_id").distinct(), "entity_id", "left_semi")


def fused_top_k(hits: DataFrame, directory: DataFrame, sources: Sequence[str], k: int) -> DataFrame:
    """Best ``k`` entities per query with the average score; ties go to the smaller entity id."""
    kept = prune(fuse_sources(hits, sources), sources, k)
    scored = average(kept, only_entities(directory, kept), sources)
    order = Window.partitionBy("query_id").orderBy(rounded(F.col("total_score")).desc(), F.col("entity_id").asc())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k_one_query(hits: DataFrame, directory: DataFrame, sources: Sequence[str], k: int) -> DataFrame:
    """The same for a single query: a distributed take-ordered instead of a window."""
    kept = prune(fuse_sources(hits, sources), sources, k)
    scored = average(kept, only_entities(directory, kept), sources)
    return scored.orderBy(rounded(F.col("total_score")).desc(), F.col("entity_id").asc()).limit(k)


def _places(top: DataFrame, hits: DataFrame, sources: Sequence[str], small: bool = False) -> DataFrame:
    """Rank of fused documents in the complete ranking of their own source, where several sources matched the entity.

    Per (query, source) the fused documents are at most k thresholds. Each hit finds by itself how many thresholds come
    before it, so ranking takes one count per interval and never a sort of all hits. ``small`` says that the queries are so few that
    their thresholds may be sent to every task; hits then are counted where they are, and only counts are shuffled.
    """
    n_matched = F.size(F.array_compact(F.array(*[F.col(_score_column(i)) for i, _ in enumerate(sources)])))
    entries = top.where(n_matched > 1).select(
        "query_id",
        "rank",
        F.posexplode(F.array(*[F.col(_score_column(i)) for i, _ in enumerate(sources)])).alias("order", "score"),
        "docs",
    ).where(F.col("score").isNotNull())
    names = F.array(*[F.lit(s) for s in sources])
    entries = entries.withColumn("source", F.get(names, F.col("order")))
    entries = entries.withColumn(
        "id", F.get(F.filter("docs", lambda d: d["source"] == F.col("source")), F.lit(0))["id"]
    )
    marks = entries.groupBy("query_id", "source").agg(
        F.array_sort(F.collect_list(F.struct((-rounded(F.col("score"))).alias("neg"), F.col("id")))).alias("marks")
    )
    keyed = hits.select("query_id", "source", F.struct((-rounded(F.col("score"))).alias("neg"), F.col("id")).alias("h"))
    slots = (
        keyed.join(F.broadcast(marks) if small else marks, ["query_id", "source"])
        .withColumn("slot", F.size(F.filter("marks", lambda m: m < F.col("h"))))
        .groupBy("query_id", "source", "slot")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy("query_id", "source").orderBy("slot")
    slots = slots.withColumn("place", F.sum("n").over(running)).select("query_id", "source", "slot", "place")
    placed = marks.select("query_id", "source", F.posexplode("marks").alias("slot", "mark"))
    return placed.join(slots, ["query_id", "source", "slot"]).select(
        "query_id", "source", F.col("mark.id").alias("id"), "place"
    )


def with_hits(top: DataFrame, hits: DataFrame, sources: Sequence[str], small: bool = False) -> DataFrame:
    """Add the documents of every fused entity: the source that shows it first leads, the others keep registry order.

    ``small`` promises that ``top`` is small enough to be sent to every task.
    """
    orders = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(i).alias("order")) for i, s in enumerate(sources)])
    scores = F.array(*[F.coalesce(F.col(_score_column(i)), F.lit(0.0)) for i, _ in enumerate(sources)])
    docs = (
        top.withColumn("scores", scores)
        .withColumn("met", F.array(*[F.col(_score_column(i)).isNotNull() for i, _ in enumerate(sources)]))
        .select("query_id", "rank", "entity_id", "total_score", "n_sources", "scores", "met", F.explode("docs").alias("doc"))
        .withColumn("order", F.get(F.filter(orders, lambda o: o["source"] == F.col("doc.source")), F.lit(0))["order"])
        .select(
            "query_id",
            "rank",
            "entity_id",
            "total_score",
            "n_sources",
            F.col("doc.source").alias("source"),
            F.col("doc.id").alias("id"),
            "order",
            F.get("scores", F.col("order")).alias("score"),
            F.get("met", F.col("order")).alias("met"),
        )
    )
    placed = docs.join(_places(top, hits, sources, small), ["query_id", "source", "id"], "left")
    by_entity = placed.groupBy("query_id", "rank", "entity_id", "total_score", "n_sources").agg(
        # An entity only one source matched has no place to compare: that source leads.
        F.coalesce(
            F.min(F.when(F.col("place").isNotNull(), F.struct("place", "order")))["order"], F.min(F.when(F.col("met"), F.col("order")))
        ).alias("lead"),
        F.collect_list(F.struct("order", "source", "id", "score")).alias("docs"),
    )
    lead_first = F.transform(
        F.array_sort(
            F.transform(
                "docs",
                lambda d: F.struct((d["order"] != F.col("lead")).alias("late"), d["order"], d["source"], d["id"], d["score"]),
            )
        ),
        lambda d: F.struct(d["source"].alias("source"), d["id"].alias("id"), d["score"].alias("score")),
    )
    return by_entity.select("query_id", "rank", "entity_id", "total_score", "n_sources", lead_first.alias("hits"))
