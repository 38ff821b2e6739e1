"""Dump files and incremental fetch bookkeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from confluo.schemas import STORE_DUMP, STORE_KEEP, STORE_REPLY


def read_dump(spark: SparkSession, path: str | list[str], schema: T.StructType, partitions: int | None = None) -> DataFrame:
    """JSON lines, gzipped or not; blank lines are skipped.

    A gzip file is one split. ``partitions`` spreads the rows of few large files over the cluster.
    """
    rows = spark.read.schema(schema).json(path)
    return rows.repartition(partitions) if partitions else rows


# Records of a file: a gzip file is read by one task, so large dumps are many files.
FILE_RECORDS = 10_000


def in_files(df: DataFrame, *keys: str, records: int = FILE_RECORDS, least: int = 1) -> DataFrame:
    """As many partitions as files of about ``records`` records need, ``least`` of them at least."""
    return df.repartition(max(least, -(-df.count() // records)), *keys)


def write_dump(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "gzip").json(path)


def append_dump(df: DataFrame, path: str) -> None:
    write_dump(df, path, "append")


def keep_fields(df: DataFrame, fields: Sequence[str] = STORE_KEEP) -> DataFrame:
    """Only the listed fields, those that exist; the rest is never read from a columnar table."""
    return df.select(*[f for f in fields if f in df.columns])


def new_keys(listing: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys that are listed and not fetched yet."""
    return listing.select(key).distinct().join(done.select(key), key, "left_anti")


def classify_fetch(replies: DataFrame) -> DataFrame:
    """Outcome of every reply ``(asked, payload)``: ``ok``, ``failed`` or ``redirect``.

    A payload maps the asked key to ``{success, data}``. Broken JSON, a missing entry or no success is a failure; a record
    that carries another key is a redirect.
    """
    parsed = replies.withColumn(
        "reply", F.from_json("payload", T.MapType(T.StringType(), STORE_REPLY))
    ).withColumn("reply", F.try_element_at("reply", F.col("asked").cast("string")))
    returned = F.col("reply.data.steam_appid")
    succeeded = F.coalesce(F.col("reply.success"), F.lit(False)) & returned.isNotNull()
    outcome = F.when(~succeeded, "failed").when(returned != F.col("asked"), "redirect").otherwise("ok")
    return parsed.select(
        "asked",
        outcome.alias("outcome"),
        F.when(outcome == "redirect", returned).alias("redirect"),
        F.when(succeeded, F.col("reply.data")).alias("record"),
    )


def fetched_rows(classified: DataFrame, listing: DataFrame, key: str = "steam_appid") -> DataFrame:
    """Rows to append to the dump.

    Failures and redirects leave a marker under the asked key. A redirect's record is kept under its own key only when
    that key is not listed: listed keys are fetched for themselves.
    """
    failures = classified.where(F.col("outcome") != "ok").select(
        F.col("asked").alias("steam_appid"), F.lit(True).alias("failed"), "redirect"
    )
    direct = classified.where(F.col("outcome") == "ok").select("record.*")
    moved = (
        classified.where(F.col("outcome") == "redirect")
        .join(listing.select(F.col(key).alias("redirect")), "redirect", "left_anti")
        .select("record.*")
    )
    columns = [f for f in STORE_DUMP.names if f in (*STORE_KEEP, "failed", "redirect")]
    return direct.unionByName(moved).unionByName(failures, allowMissingColumns=True).select(*columns)
