"""Incremental cleaning as a stream: the checkpoint takes the place of the mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean
from ..operators.incremental import new_rows
from ..schemas import KEY, SOURCES
from ..sources.tables import append_table, existing


def clean_arrivals(
    spark: SparkSession,
    entity: str,
    arrivals: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Clean what arrived since the last run and append the rows not yet held.

    Cleaning comes first, so a draft does not stand in for the completed document of
    its key. A batch repeated after a failure adds nothing, because rows whose
    key the target holds are left out, however late they come.
    """
    rows = (
        spark.readStream.schema(SOURCES[entity])
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(arrivals)
    )

    def merge(batch: DataFrame, _batch_id: int) -> None:
        cleaned = clean.clean(entity, batch)
        held = existing(batch.sparkSession, target, cleaned.schema)
        append_table(new_rows(cleaned, held, KEY[entity]), target)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def arrived(spark: SparkSession, entity: str, target: str) -> DataFrame:
    """The cleaned table a stream has filled so far."""
    empty = spark.createDataFrame([], SOURCES[entity])
    return spark.read.schema(clean.clean(entity, empty).schema).parquet(target)
