"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGE_FOLDER = "zonecast_stage"
BROADCAST_BYTES = 64 * 1024 * 1024
COUNTED_BYTES = 1024 * 1024  # of files, from which on rows are counted before a broadcast
ROW_BYTES = 32  # that a broadcast row takes beside its values
TASK_ROWS = 500_000  # rows that one task sorts or groups
CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_KEY = "spark.sql.shuffle.partitions"
SCAN_KEY = "spark.sql.files.minPartitionNum"


def build_session(app: str = "zonecast", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is written for (UTC, AQE, skew handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """Folder every executor can reach, or None where the session names none.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without that
    setting gets a temporary folder of this machine.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="zonecast-"))
        return spark.sparkContext.getCheckpointDir()
    return None


def new_stage_path(spark: SparkSession, label: str) -> str:
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    return f"{folder}/{STAGE_FOLDER}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several branches share one computation.

    The written table survives lost executors, cuts lineage, keeps column pruning and filter
    pushdown, and has a known size, so the optimizer broadcasts it only when it is small.
    A cluster session without a shared folder is an error, not another plan.
    """
    spark = df.sparkSession
    path = new_stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size of a result: file bytes for a scan, a product for most joins."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def held_bytes(df: DataFrame) -> int:
    """About what the rows of a result take in memory, which compressed files do not show: its rows are counted."""
    return df.count() * (int(df._jdf.schema().defaultSize()) + ROW_BYTES)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks of ``TASK_ROWS`` rows at most, the session's number of shuffle partitions at least.

    What a task sorts or groups stays in its memory, so the number of tasks follows the rows.
    """
    return max(int(spark.conf.get(SHUFFLE_KEY)), -(-rows // TASK_ROWS))


@contextmanager
def tasks(spark: SparkSession, number: int) -> Iterator[None]:
    """Plans made within have at least ``number`` tasks after a shuffle and about as many where they scan files.

    Adaptive execution puts those together that turn out small. For what is written within the block.
    """
    if number <= int(spark.conf.get(SHUFFLE_KEY)):
        yield
        return
    before = {key: spark.conf.get(key, None) for key in (SHUFFLE_KEY, SCAN_KEY)}
    for key in before:
        spark.conf.set(key, str(number))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def small(df: DataFrame, label: str) -> DataFrame:
    """Mark a side that should be small for broadcast, but only once its size is known.

    A plan of unknown size is written first, so that its real size decides: that of its rows in memory,
    as files of few bytes may hold many rows. Above the limit the side joins by shuffle. A client that
    cannot see plan sizes leaves the choice to AQE.
    """
    if not hasattr(df, "_jdf"):
        return df
    if planned_bytes(df) > BROADCAST_BYTES:
        df = stage(df, label)
    if planned_bytes(df) > BROADCAST_BYTES:
        return df
    if planned_bytes(df) > COUNTED_BYTES and held_bytes(df) > BROADCAST_BYTES:
        return df.hint("merge")
    return F.broadcast(df)
