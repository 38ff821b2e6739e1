"""Session set-up and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from confluo.sources.files import delete

CHECKPOINT_CONF = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the jobs rely on. Token patterns and dates assume UTC and plain string literals.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call sites are captured by several gateway calls per column; plans here have many columns.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Position lists are built by an object aggregate; let it stay hash-based for normal document sizes.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def build_session(master: str | None = None, app_name: str = "confluo", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SESSION_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints and step tables.

    Only a session without one (tests, a laptop) gets a folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if not current:
        if not named:
            if not context.master.startswith("local"):
                raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
            named = tempfile.mkdtemp(prefix="confluo-checkpoint-")
        context.setCheckpointDir(named)
        current = context.getCheckpointDir()
    return named or os.path.dirname(current.rstrip("/"))


PACKAGE_ROOT = str(Path(__file__).resolve().parents[1])


def import_in_tasks(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines do not share that folder, the package is installed or shipped like any other dependency.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are stored in the shared folder, so a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def step_tables(spark: SparkSession) -> Iterator[None]:
    """Owns the step tables written inside and deletes them at the end, so what is read after it must not depend on them."""
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in paths:
            delete(spark, path)


def step_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table written between two steps of a job; it belongs to the :func:`step_tables` around, if there is one."""
    path = f"{shared_dir(spark).rstrip('/')}/confluo-{name}-{uuid.uuid4().hex}"
    owner = _owned.get()
    if owner is not None:
        owner.append(path)
    return path


def store_step(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Cuts lineage like a checkpoint, and besides gives later joins column pruning and true sizes.
    """
    path = step_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def free_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job go when it ends, not when the driver happens to collect its garbage. For jobs whose plans run once."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def plan_size(df: DataFrame) -> int:
    """Catalyst's size estimate in bytes. It says how files are laid out, not what texts weigh, so no broadcast rests on it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *keys: str, above: int = 4 << 20) -> DataFrame:
    """Use all cores for a table that arrives in fewer splits than there are cores, as one gzip or one row group does.

    Many-split tables pass unchanged: at scale this adds no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if plan_size(df) <= above or df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
