"""Raw records to catalogue rows: filters, first-wins dedup, field mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from confluo.functions import values as V
from confluo.functions.text import strip_tags

# Popularity a record needs in "only known" mode, and the record types kept.
RATINGS_CUTOFF = 5
STORE_CUTOFF = 1000
STORE_TYPES = ("game", "dlc")


def known_only(df: DataFrame, popularity: str, cutoff: int) -> DataFrame:
    """A plain comparison on the column, so that it reaches a Parquet scan; a missing count is below any cutoff."""
    return df.where(F.col(popularity) >= cutoff)


def known_only_by_source(catalogue: DataFrame, cutoffs: Mapping[str, int]) -> DataFrame:
    kept = F.lit(False)
    for source, cutoff in cutoffs.items():
        kept = kept | ((F.col("source") == source) & (F.col("popularity") >= cutoff))
    others = ~F.col("source").isin(*cutoffs) if cutoffs else F.lit(True)
    return catalogue.where(kept | others)


def valid_records(df: DataFrame, types: Sequence[str] = STORE_TYPES) -> DataFrame:
    """Named, not failed, of a wanted type; a missing type is unknown and dropped."""
    named = F.coalesce(F.col("name"), F.lit("")) != ""
    failed = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in df.columns else F.lit(False)
    return df.where(named & ~failed & F.coalesce(F.col("type"), F.lit("unknown")).isin(*types))


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key. The group limit keeps one row per key and task before the shuffle, so hot keys stay cheap."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def ratings_dump_rows(api: DataFrame) -> DataFrame:
    """Nested service records to the flat dump layout."""
    return api.select(
        "id",
        "name",
        "storyline",
        "summary",
        V.nested_names(F.col("genres")).alias("genres"),
        V.nested_names(F.col("platforms")).alias("platforms"),
        V.developer_names(F.col("involved_companies")).alias("dev_companies"),
        V.earliest_date(F.col("release_dates")).alias("release_date"),
        V.number_or_zero(F.col("total_rating_count")).cast("long").alias("total_rating_count"),
    )


def ratings_catalogue(dump: DataFrame, only_known: bool = True, cutoff: int = RATINGS_CUTOFF) -> DataFrame:
    kept = known_only(dump, "total_rating_count", cutoff) if only_known else dump
    return kept.select(
        F.col("id").cast("string").alias("id"),
        "name",
        "storyline",
        "summary",
        "genres",
        "platforms",
        F.col("dev_companies").alias("devs"),
        V.epoch_to_timestamp(F.col("release_date")).alias("date"),
        F.col("total_rating_count").alias("popularity"),
    )


def store_catalogue(
    dump: DataFrame,
    order: Sequence[str | Column],
    only_known: bool = True,
    cutoff: int = STORE_CUTOFF,
    types: Sequence[str] = STORE_TYPES,
    formats: Sequence[str] = V.DATE_FORMATS,
    strip: Sequence[str] = ("summary",),
    only_true_platforms: bool = False,
) -> DataFrame:
    """Store pages to catalogue rows. Filters come first, so a filtered duplicate never hides a good one."""
    kept = valid_records(dump, types)
    if only_known:
        kept = kept.where(F.coalesce(F.col("recommendations.total"), F.lit(0)) >= cutoff)
    texts = {"storyline": F.col("detailed_description"), "summary": F.col("about_the_game")}
    texts = {name: strip_tags(text) if name in strip else text for name, text in texts.items()}
    return first_wins(kept, ["steam_appid"], order).select(
        F.col("steam_appid").cast("string").alias("id"),
        "name",
        texts["storyline"].alias("storyline"),
        texts["summary"].alias("summary"),
        V.nested_names(F.col("genres"), "description").alias("genres"),
        V.map_key_list(F.col("platforms"), only_true_platforms).alias("platforms"),
        F.coalesce(F.col("developers"), V.no_strings()).alias("devs"),
        V.parse_date(F.col("release_date.date"), F.col("release_date.coming_soon"), formats).alias("date"),
        V.number_or_zero(F.col("recommendations.total")).cast("long").alias("popularity"),
    )


def unreadable_dates(dump: DataFrame, formats: Sequence[str] = V.DATE_FORMATS) -> DataFrame:
    """Report: how many given dates no format could read."""
    lost = V.unreadable_date(F.col("release_date.date"), F.col("release_date.coming_soon"), formats)
    return dump.agg(F.count_if(lost).alias("unreadable"), F.count(F.lit(1)).alias("records"))
