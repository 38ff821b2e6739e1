"""Quality of rankings against graded judgements: DCG, NDCG, precision, average precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from confluo.functions.scoring import gain_at

# Grades from here on are relevant; interpolated precision is read at ten recall levels.
RELEVANT = 2
LEVELS = 10

# Ranks summed up by one row when ideal gains are computed.
BLOCK = 10_000


def last_judgement(qrels: DataFrame, order: str | None = "line_no") -> DataFrame:
    """One grade per (query, source, id): the last one given by ``order``.

    Judgements without an order must be free of contradictions: several grades for one document fail.
    """
    keys = ["query_id", "source", "id"]
    if order in qrels.columns:
        return qrels.groupBy(*keys).agg(F.max_by("relevance", order).alias("relevance"))
    clash = F.raise_error(F.concat(F.lit("several grades and no order for document "), F.coalesce("id", F.lit("")))).cast("int")
    low, high = F.min("relevance"), F.max("relevance")
    return qrels.groupBy(*keys).agg(low.alias("low"), high.alias("high")).select(
        *keys, F.when(F.col("low") < F.col("high"), clash).otherwise(F.col("high")).alias("relevance")
    )


def grade_fused(fused: DataFrame, qrels: DataFrame) -> DataFrame:
    """Grade of each fused row: its first hit that has a judgement, else 0."""
    hits = fused.select("query_id", "rank", F.posexplode("hits").alias("pos", "hit")).select(
        "query_id", "rank", "pos", "hit.source", "hit.id"
    )
    judged = hits.join(last_judgement(qrels), ["query_id", "source", "id"], "left")
    first = F.min_by("relevance", F.when(F.col("relevance").isNotNull(), F.col("pos")))
    return judged.groupBy("query_id", "rank").agg(F.coalesce(first, F.lit(0)).alias("grade"))


def grade_ranking(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """The same for a plain ranking ``(query_id, rank, source, id)``."""
    judged = run.join(last_judgement(qrels), ["query_id", "source", "id"], "left")
    return judged.select("query_id", "rank", F.coalesce("relevance", F.lit(0)).alias("grade"))


def dcg(graded: DataFrame) -> DataFrame:
    return graded.groupBy("query_id").agg(F.sum(gain_at(F.col("grade"), F.col("rank"))).alias("dcg"))


def ideal_dcg(qrels: DataFrame, block: int = BLOCK) -> DataFrame:
    """DCG of all judgements of a query from best to worst, without sorting them.

    Only the number of judgements per grade matters: a grade fills one run of ranks, cut into blocks that are summed where
    they lie. A query with any number of judgements costs one shuffled row per grade.
    """
    counts = qrels.groupBy("query_id", "relevance").agg(F.count(F.lit(1)).alias("n"))
    better = Window.partitionBy("query_id").orderBy(F.col("relevance").desc()).rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.withColumn("above", F.coalesce(F.sum("n").over(better), F.lit(0)))
    blocks = runs.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(block)))).select(
        "query_id",
        "relevance",
        (F.col("above") + F.col("start") + 1).alias("lo"),
        (F.col("above") + F.least(F.col("start") + block, F.col("n"))).alias("hi"),
    )
    share = F.aggregate(F.sequence("lo", "hi"), F.lit(0.0), lambda acc, p: acc + gain_at(F.lit(1.0), p))
    return blocks.groupBy("query_id").agg(F.sum(F.col("relevance") * share).alias("ideal_dcg"))


def ndcg(graded: DataFrame, qrels: DataFrame, block: int = BLOCK) -> DataFrame:
    """Queries without results score 0; without a positive judgement the ratio is null."""
    return (
        ideal_dcg(qrels, block)
        .join(dcg(graded), "query_id", "full")
        .select(
            "query_id",
            F.coalesce("dcg", F.lit(0.0)).alias("dcg"),
            F.coalesce("ideal_dcg", F.lit(0.0)).alias("ideal_dcg"),
        )
        .withColumn("ndcg", F.try_divide("dcg", "ideal_dcg"))
    )


def _relevant(grade: str | Column) -> Column:
    return (F.col(grade) if isinstance(grade, str) else grade) >= RELEVANT


def relevant_totals(qrels: DataFrame) -> DataFrame:
    return qrels.groupBy("query_id").agg(F.count_if(_relevant("relevance")).alias("total"))


def natural_precision(graded: DataFrame, qrels: DataFrame) -> DataFrame:
    """Precision and recall at every relevant row. The window holds the graded rows of one query, at most k."""
    so_far = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    points = graded.withColumn("ordinal", F.count_if(_relevant("grade")).over(so_far)).where(_relevant("grade"))
    return points.join(relevant_totals(qrels), "query_id").select(
        "query_id",
        "rank",
        "ordinal",
        "total",
        (F.col("ordinal") / F.col("rank")).alias("precision"),
        F.try_divide(F.col("ordinal"), F.col("total")).alias("recall"),
    )


def interpolated_precision(graded: DataFrame, qrels: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Best natural precision at each recall level, 0 where the level is not reached, null without relevant judgements."""
    points = natural_precision(graded, qrels).groupBy("query_id").agg(
        F.collect_list(F.struct("ordinal", "precision")).alias("points")
    )
    wanted = relevant_totals(qrels).withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(levels))))
    reached = F.filter(
        F.coalesce("points", F.array().cast("array<struct<ordinal:bigint,precision:double>>")),
        lambda p: p["ordinal"] * levels >= F.col("level") * F.col("total"),
    )
    best = F.coalesce(F.array_max(F.transform(reached, lambda p: p["precision"])), F.lit(0.0))
    return wanted.join(points, "query_id", "left").select(
        "query_id", "level", F.when(F.col("total") > 0, best).alias("precision")
    )


def average_precision(graded: DataFrame, qrels: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per query: natural (sum over relevant rows / relevant total) and interpolated (mean of the levels)."""
    found = natural_precision(graded, qrels).groupBy("query_id").agg(F.sum("precision").alias("gained"))
    natural = (
        relevant_totals(qrels)
        .join(found, "query_id", "left")
        .select("query_id", F.try_divide(F.coalesce("gained", F.lit(0.0)), F.col("total")).alias("ap_raw"))
    )
    level_mean = interpolated_precision(graded, qrels, levels).groupBy("query_id").agg(F.avg("precision").alias("ap_interpolated"))
    return natural.join(level_mean, "query_id")


def mean_average_precision(graded: DataFrame, qrels: DataFrame, levels: int = LEVELS) -> DataFrame:
    return average_precision(graded, qrels, levels).agg(
        F.avg("ap_interpolated").alias("map_interpolated"), F.avg("ap_raw").alias("map_raw")
    )


def level_means(graded: DataFrame, qrels: DataFrame, levels: int = LEVELS) -> DataFrame:
    return interpolated_precision(graded, qrels, levels).groupBy("level").agg(F.avg("precision").alias("mean_precision"))
