"""Result tables for display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.functions.text import snippet
from confluo.functions.values import join_list


def result_table(fused: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per fused hit with its stored fields; what a record lacks stays null or empty."""
    hits = fused.select("query_id", "rank", "entity_id", "total_score", F.posexplode("hits").alias("pos", "hit")).select(
        "query_id", "rank", "entity_id", "total_score", "pos", "hit.source", "hit.id"
    )
    shown = catalogue.select(
        "source",
        "id",
        "name",
        "date",
        join_list(F.col("genres")).alias("genres"),
        join_list(F.col("platforms")).alias("platforms"),
        join_list(F.col("devs")).alias("devs"),
        snippet(F.col("summary")).alias("snippet"),
    )
    return hits.join(shown, ["source", "id"])
