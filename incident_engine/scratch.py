"""Shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _named_dir(spark: SparkSession) -> str | None:
    return spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def has_shared_dir(spark: SparkSession) -> bool:
    """Whether there is a folder that all tasks of the session can write to and read."""
    return _is_local(spark) or _named_dir(spark) is not None


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    named = _named_dir(spark)
    if named:
        return named
    if not _is_local(spark):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="incident-engine-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def unsized(df: DataFrame) -> DataFrame:
    """The rows of `df` as a frame of which the planner knows no size.

    A checkpoint keeps the size that was estimated for its plan, and joins multiply estimates. Where a loop
    joins what its last round wrote with itself, that exact integer doubles its digits each round, until such
    numbers fill the driver. For narrow rows: each is converted once more.
    """
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.toJavaRDD(), df._jdf.schema()), spark)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a frame made here go as soon as the frame has run, not when the driver collects garbage.

    For loops that write each round's frames once; a frame that runs again shuffles again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
