"""Session settings, reliable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after it was counted and found to be at most this long.
BROADCAST_ROWS = 100_000


def build_session(app_name: str = "orderlens", **settings: str) -> SparkSession:
    """A session with the settings that the jobs rely on; ``settings`` adds to them or replaces them.

    Adaptive execution merges small shuffle partitions and splits skewed ones, but never makes more than
    ``spark.sql.shuffle.partitions``: set it so that a partition of the largest shuffle (the order lines)
    has about 200 MB, that is 5,000 for each TB shuffled. Spark's default of 200 is for small data.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="orderlens-checkpoint-")
    context.setCheckpointDir(shared)


def reliable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and read it back from there.

    Used where a plan reads the same aggregate several times: the later passes cost a scan of the
    checkpoint, survive the loss of executors and all see the same rows in the same partitions.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    with leaving_no_shuffle_files(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def lying_together(spark: SparkSession) -> AbstractContextManager[None]:
    """For what is run inside: a join takes sides that both lie by some of its keys as they are.

    Otherwise Spark moves both by all keys. Only for keys of which no value holds a large part of the rows.
    """
    return _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def leaving_no_shuffle_files(spark: SparkSession) -> AbstractContextManager[None]:
    """For what is built and run inside: its shuffle files go as soon as it has ended.

    Otherwise they stay on the executors' disks until the driver happens to collect garbage, beside those
    of all later steps of a job. A write is built when it is called; a frame that is collected or
    checkpointed must be made inside.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, next to the checkpoints."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid4()}"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if a count proves it small; else leave the join to AQE.

    ``df`` should be cheap to read twice (a checkpoint or an aggregate of one).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
