"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts travel to Python in batches of so many rows and about so many bytes, so that a batch of long texts stays small.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of an Arrow batch of texts, and let Python workers import this package from where the driver has it.

    On a cluster whose machines do not share that folder, the package is installed or shipped like any other dependency.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that start as asked and clash with none of the frame's (names compare without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; extra ones of any name are left out before anything is added."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def in_fold(doc_id: Column, folds: int, held: int) -> Column:
    """True where crc32(doc_id as text) mod ``folds`` is ``held``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == held


def sample_distinct(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """At most ``bound`` distinct 64-bit hashes ``h`` of a key, the smallest ones; some wherever there are rows.

    A share of the hashes is taken first, from the approximate number of different ones, so that what is sorted does not grow with the input.
    Repeated keys count once.
    """
    steps = 1 << 30
    keyed = rows.select(F.xxhash64(key).alias("h"))
    different = keyed.agg(F.approx_count_distinct("h")).first()[0]
    share = min(1.0, max(2 * bound, 64) / max(different, 1))
    taken = keyed.where(F.pmod("h", F.lit(steps)) <= int(steps * share)).distinct()
    return taken.orderBy(F.pmod("h", F.lit(steps)), "h").limit(bound)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; NULL becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def str_texts(column: pa.Array) -> list[str]:
    """Every text; NULL becomes empty."""
    return [x or "" for x in column.to_pylist()]


def with_columns(batch: pa.RecordBatch, drop: list[str], **added: pa.Array) -> pa.RecordBatch:
    """The batch without the dropped columns and with the added ones at the end."""
    keep = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in drop]
    names = [n for n, _ in keep] + list(added)
    return pa.RecordBatch.from_arrays([c for _, c in keep] + list(added.values()), names=names)


Batches = Iterator[pa.RecordBatch]
