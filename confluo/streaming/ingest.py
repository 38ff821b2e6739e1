"""Incremental ingest: new dump files arrive, records with unseen keys are appended.

Which keys are stored is kept twice: in the rows, which lie in buckets by the hash of their key, and as a Bloom filter beside them
(``<stored>/_filters``): a key sets ``HASHES`` bits in one of the bitmaps of 32,768 bits that ``bits`` are divided into, and only bitmaps with a bit
set exist. A batch asks the filter first; a key that is not in it is new. Only for keys that may be stored, a few hundredths of a per cent of the new ones as long
as there are 16 bits for every key, the rows of their buckets are looked through. The filter of a batch is written before its rows, so a batch
that fails leaves bits too many and never too few; filters of batches are joined by a bitwise OR, and :func:`compact_filters` writes them as one.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from confluo.operators.normalise import first_wins
from confluo.session import step_tables, store_step
from confluo.sources.files import child_names, delete, exists, make_dir

log = logging.getLogger(__name__)

_RUN = "confluo-run-"
BUCKETS = 64
BITS = 1 << 30
HASHES = 5
# Bits of one bitmap of the bitmap functions.
_MAP = 32768
_FILTERS = "_filters"
_FILTER_ROWS = "part long, bits binary, run string, batch long"


def _run_token(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run a checkpoint belongs to. A new checkpoint is a new run and never overwrites an older one's rows."""
    found = [n for n in child_names(spark, checkpoint) if n.startswith(_RUN)]
    if found:
        return found[0][len(_RUN) :]
    token = uuid.uuid4().hex
    make_dir(spark, f"{checkpoint}/{_RUN}{token}")
    return token


def read_ingested(spark: SparkSession, stored: str, schema: T.StructType) -> DataFrame:
    places = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())]
    layout = T.StructType([*schema.fields, *places])
    return spark.read.schema(layout).parquet(stored)


def _part(key: str, bits: int) -> Column:
    """The bitmap of a key."""
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(max(1, bits // _MAP))).alias("part")


def _places(key: str) -> Column:
    """The places of its bits there."""
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(_MAP)).cast("int") for i in range(1, HASHES + 1)])


def key_filter(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """``part, bits``: bitmaps of the keys' bits."""
    places = rows.select(_part(key, bits), F.explode(_places(key)).alias("place"))
    return places.groupBy("part").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))


def read_filters(spark: SparkSession, stored: str) -> DataFrame:
    return spark.read.schema(_FILTER_ROWS).parquet(f"{stored}/{_FILTERS}")


def may_be_stored(rows: DataFrame, key: str, filters: DataFrame, bits: int) -> DataFrame:
    """The rows all of whose key's bits are set."""
    merged = filters.groupBy("part").agg(F.bitmap_or_agg("bits").alias("_bits"))
    asked = rows.withColumns({"_part": _part(key, bits), "_places": _places(key)})
    is_set = "forall(_places, p -> shiftright(cast(conv(hex(substring(_bits, p div 8 + 1, 1)), 16, 10) AS int), p % 8) & 1 = 1)"
    return asked.join(merged, F.col("_part") == F.col("part")).where(is_set).select(*rows.columns)


def compact_filters(spark: SparkSession, stored: str) -> None:
    """Write the filters of all batches as one. Not while a stream writes to the same folder."""
    merged = read_filters(spark, stored).groupBy("part").agg(F.bitmap_or_agg("bits").alias("bits"))
    names = child_names(spark, f"{stored}/{_FILTERS}")
    merged.write.mode("overwrite").parquet(f"{stored}/{_FILTERS}/run=compact-{uuid.uuid4().hex}/batch=0")
    for name in names:
        if name.startswith("run="):
            delete(spark, f"{stored}/{_FILTERS}/{name}")


def ingest(
    spark: SparkSession,
    incoming: str,
    stored: str,
    checkpoint: str,
    schema: T.StructType,
    key: str,
    max_files: int | None = None,
    buckets: int = BUCKETS,
    bits: int = BITS,
) -> StreamingQuery:
    """Take in what has arrived in ``incoming`` since the last call, then stop.

    Within a batch the first record of a key wins (older file, then order in the file); keys stored by other batches are
    skipped. A batch owns one folder and overwrites it, so a batch that is retried after a failure does not double its rows. All calls for
    one folder use the same ``buckets`` and ``bits``.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    order = ["_time", "_file", "_start", "_row"]
    arriving = reader.json(incoming).select(
        *schema.names,
        F.col("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    run = _run_token(spark, checkpoint)

    def append(batch: DataFrame, batch_id: int) -> None:
        with step_tables(batch.sparkSession):
            take_in(batch, batch_id)

    def take_in(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = batch.where(F.col(key).isNotNull()).withColumn("_row", F.monotonically_increasing_id())
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        fresh = store_step(first_wins(fresh, [key], order).select(*schema.names, bucket.alias("bucket")), "arrived")
        mine = (F.col("run") == run) & (F.col("batch") == batch_id)
        if exists(session, f"{stored}/{_FILTERS}"):
            filters = read_filters(session, stored).where(~mine)
            asked = store_step(may_be_stored(fresh.select(key, "bucket"), key, filters, bits), "asked")
            # At most one number per bucket; they prune folders of the stored rows.
            touched = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
            log.info("batch %d: %d keys may be stored, in %d of %d buckets", batch_id, asked.count(), len(touched), buckets)
            if touched:
                others = read_ingested(session, stored, schema).where(F.col("bucket").isin(touched)).where(~mine).select(key)
                fresh = fresh.join(asked.join(others, key, "left_semi").select(key), key, "left_anti")
        key_filter(fresh, key, bits).write.mode("overwrite").parquet(f"{stored}/{_FILTERS}/run={run}/batch={batch_id}")
        rows = fresh.hint("rebalance", F.col("bucket"))
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{stored}/run={run}/batch={batch_id}")

    return (
        arriving.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
