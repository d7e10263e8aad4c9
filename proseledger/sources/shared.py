"""The folder all executors share, and tables kept there between two jobs."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Folders of local sessions that name none, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the one set on the context.

    A local session without either gets a fresh temporary folder. On a cluster
    that would be a folder of one machine, so there a missing setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="proseledger-")
        folder = _LOCAL[context.applicationId]
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses, grouped by application."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/proseledger/{application}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "table") -> DataFrame:
    """Write the table to the shared folder and return it read back.

    Later jobs then read the stored rows: a lost executor costs a re-read, not
    the jobs before it, and two uses of the table see the same rows. Parquet
    keeps column pruning, and its size tells the optimizer whether to broadcast.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, name: str = "table") -> Iterator[DataFrame]:
    """As ``store``, but the files go at the end of the block. Results that outlive it must be stored in it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def reused(
    df: DataFrame, level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep a table that several actions read, for as long as the block lasts.

    Results that outlive the block must be stored in it. With no level the table
    is computed anew by each action.
    """
    if level is None:
        yield df
        return
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
