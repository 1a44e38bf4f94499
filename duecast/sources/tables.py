"""Readers and writers for the source and lake tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import DEFAULTS, PRIMARY_KEY, REQUEST, SOURCES
from .storage import by_folder

NULL_TEXT = "\\N"
TENANT_FOLDERS = ["ad_client_id"]


def project(df: DataFrame, entity: str) -> DataFrame:
    """Only the columns that are read, in their declared types."""
    fields = SOURCES[entity]
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields])


def read_parquet(spark: SparkSession, entity: str, path: str, where: Column | None = None) -> DataFrame:
    df = project(spark.read.parquet(path), entity)
    return df if where is None else df.where(where)


def read_jdbc(
    spark: SparkSession,
    entity: str,
    options: dict[str, str],
    id_range: tuple[int, int],
    partitions: int,
    fetch_rows: int = 50_000,
    where: Column | None = None,
) -> DataFrame:
    """A relational table read in parallel slices of its primary key.

    Filters put on the result are pushed to the database.
    """
    reader = spark.read.format("jdbc").options(**options).options(
        dbtable=options.get("dbtable", entity),
        partitionColumn=PRIMARY_KEY[entity],
        lowerBound=id_range[0],
        upperBound=id_range[1],
        numPartitions=partitions,
        fetchsize=fetch_rows,
    )
    df = project(reader.load(), entity)
    return df if where is None else df.where(where)


def read_csv(spark: SparkSession, schema: T.StructType, path: str, null_text: str | None = NULL_TEXT) -> DataFrame:
    """A headed CSV file with an explicit schema."""
    reader = spark.read.schema(schema).option("header", True)
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, null_text: str = NULL_TEXT) -> None:
    df.write.option("header", True).option("nullValue", null_text).csv(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append to a lake table, one folder per tenant."""
    by_folder(df, TENANT_FOLDERS).write.mode("append").partitionBy(*TENANT_FOLDERS).parquet(path)


def replace_tenants(df: DataFrame, path: str) -> None:
    """Replace the rows of exactly the tenants that occur in ``df``."""
    (
        by_folder(df, TENANT_FOLDERS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*TENANT_FOLDERS)
        .parquet(path)
    )


def append_jdbc(df: DataFrame, options: dict[str, str], table: str, batch_rows: int = 50_000) -> None:
    df.write.format("jdbc").options(**options).options(dbtable=table, batchsize=batch_rows).mode("append").save()


def existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A lake table, or None before its first load. A table that cannot be read is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_lake(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Nulls replaced by the declared column defaults of a lake table."""
    kinds = {f.name: f.dataType for f in df.schema}
    filled = {
        name: F.coalesce(F.col(name), F.lit(value).cast(kinds[name]))
        for name, value in DEFAULTS[table].items()
        if name in kinds
    }
    return df.withColumns(filled)


def read_requests(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Scoring requests from JSON records or a headed CSV file."""
    if kind == "csv":
        return read_csv(spark, REQUEST, path, null_text="")
    return spark.read.schema(REQUEST).json(path)


def write_records(df: DataFrame, path: str) -> None:
    df.write.json(path)


def as_records(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """One JSON record per row, nulls written out, next to the key columns."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(*keys, body.alias("record"))
