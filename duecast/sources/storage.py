"""Shared storage of a run: where checkpoints and intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, where the folder of the driver is the folder of the
    executors, falls back to one of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="duecast-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written once to shared storage; the lineage ends there."""
    spark = df.sparkSession
    directory = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(directory)
    return df.checkpoint()


def by_folder(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows gathered for a write into one folder per value of ``columns``.

    Adaptive execution merges small folders' rows into few tasks and splits a
    dominant one over many, so neither tiny files nor one huge task result.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def stored(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """The rows written as a table in the shared folder and read back.

    Unlike a checkpoint this keeps column pruning, filter pushdown and the file
    sizes that the optimizer uses to choose joins. ``by`` gives the columns
    that get a folder per value, so that a reader of one value reads no other.
    """
    path = scratch_path(df.sparkSession, name)
    if by:
        by_folder(df, by).write.partitionBy(*by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def measured(df: DataFrame, name: str) -> DataFrame:
    """A reduced table, such as one row per tenant, stored before it is joined.

    Its size is then known when the join is planned: Spark broadcasts it when
    it is below ``spark.sql.autoBroadcastJoinThreshold``, and the large side is
    not shuffled on a key that may hold a third of it. A larger one is joined by
    shuffle, with skewed partitions split.
    """
    return stored(df, name)


def side_by_side(tables: dict[str, DataFrame], job: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """``job`` of independent tables at the same time; one small job does not hold up the next."""
    spark = next(iter(tables.values())).sparkSession
    with ThreadPool(len(tables)) as pool:
        one = inheritable_thread_target(spark)(lambda item: job(*item))
        return dict(zip(tables, pool.map(one, tables.items(), 1)))


def stored_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Independent tables stored side by side."""
    return side_by_side(tables, lambda name, df: stored(df, name))
