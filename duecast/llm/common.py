"""What the corpus operators share: session settings, table reading, text rules."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = " \t\n\x0b\x0c\r"
"""The characters that separate words and are stripped from lines."""

WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS = 1000
"""Rows of an Arrow batch; whole texts of so many rows are held by a Python worker."""

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
}


_HELD: dict[str, Callable[[], None]] = {}


# Fixed values of the C library: parameters of mallopt.
TRIM_THRESHOLD, MMAP_THRESHOLD = -1, -3
KEPT_FREE = 1 << 20
"""Free bytes above which an allocation's memory goes back to the machine at once."""


@functools.cache
def lean() -> None:
    """From now on this worker keeps little of the memory it frees.

    Executors share a machine's memory between the JVM and its Python workers, and
    workers that stay idle would keep the most they ever used.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    set_option = getattr(ctypes.CDLL(None), "mallopt", None)
    if set_option is not None:
        set_option(MMAP_THRESHOLD, KEPT_FREE)
        set_option(TRIM_THRESHOLD, KEPT_FREE)


def _returned() -> None:
    """Gives memory that is free inside this worker back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def tidy(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` on batches in a worker that gives free memory back when the task ends."""

    def task(batches: Batches) -> Batches:
        lean()
        try:
            yield from work(batches)
        finally:
            _returned()

    return task


def holding(owner: str, clear: Callable[[], None]) -> None:
    """Says that a Python worker remembers things for ``owner``; what it held for others goes.

    Workers outlive their tasks, so a job of several operators would otherwise
    carry the memory of all of them along.
    """
    if owner not in _HELD:
        lean()
        for let_go in _HELD.values():
            let_go()
        _HELD.clear()
        _HELD[owner] = clear
        _returned()


def prepared(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def packed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as one struct ``row``, so that no name of theirs meets a working column."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))


def kept(rows: DataFrame, added: list[str]) -> list[str]:
    """The columns of ``rows`` but those named, in any letter case, like the added ones."""
    names = {a.lower() for a in added}
    return [c for c in rows.columns if c.lower() not in names]


def unpacked(columns: list[str]) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in columns]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def body(column: str | Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lowered(column: Column) -> Column:
    """A-Z lower-cased; other letters stay as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def uniform(*columns: Column) -> Column:
    """A number in (0, 1) fixed by the columns' values: the same in every run and retry."""
    top = F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double")
    return (top + F.lit(0.5)) / F.lit(float(1 << 53))
