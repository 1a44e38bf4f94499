"""Trained models on storage, with a table that says where each one is."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import forest, trees

REGISTRY = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("ad_client_id", T.LongType()),
        T.StructField("run_ts", T.TimestampNTZType()),
        T.StructField("path", T.StringType()),
    ]
)

STAMP = "%Y%m%dT%H%M%S"
"""How run times are written in names: they sort by time and hold nothing a file system refuses."""


def model_path(root: str, model_type: str, tenant: int, run_ts: datetime) -> str:
    return f"{root}/{model_type}_models/{tenant}/{run_ts.strftime(STAMP)}"


def save_model(model: PipelineModel, root: str, model_type: str, tenant: int, run_ts: datetime) -> str:
    """Save under (type, tenant, run time)."""
    path = model_path(root, model_type, tenant, run_ts)
    model.write().overwrite().save(path)
    return path


def save_trees(spark: SparkSession, path: str, root: str, tenant: int, run_ts: datetime) -> None:
    """The trees of a model saved at ``path`` as rows, for scoring all tenants in one job."""
    forest_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/stages")
    system = forest_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max((s.getPath().getName() for s in system.listStatus(forest_path)), key=lambda n: int(n.split("_")[0]))
    own = f"{root}/forest_trees/ad_client_id={tenant}/run={run_ts.strftime(STAMP)}"
    trees.tree_rows(spark, f"{path}/stages/{last}").coalesce(1).write.mode("overwrite").parquet(own)


def save_inputs(inputs: DataFrame, root: str, run_ts: datetime) -> None:
    """The preparations of a run's models, beside their trees."""
    inputs.write.mode("overwrite").parquet(f"{root}/forest_inputs/run={run_ts.strftime(STAMP)}")


def trees_of(spark: SparkSession, root: str, saved: list[tuple] | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trees and preparations of the models listed as in the registry, each with its tenant."""
    listed = saved if isinstance(saved, DataFrame) else spark.createDataFrame(saved, REGISTRY)
    wanted = listed.select("ad_client_id", F.date_format("run_ts", "yyyyMMdd'T'HHmmss").alias("run"))
    fitted = spark.read.schema(f"{trees.NODES}, ad_client_id long, run string").parquet(f"{root}/forest_trees")
    inputs = spark.read.schema(f"{forest.INPUTS}, run string").parquet(f"{root}/forest_inputs")
    key = ["ad_client_id", "run"]
    return fitted.join(wanted, key, "left_semi").drop("run"), inputs.join(wanted, key, "left_semi").drop("run")


def register(spark: SparkSession, saved: list[tuple[str, int, datetime, str]], root: str) -> None:
    """Enter saved models, (type, tenant, run time, path) each, in the registry."""
    if saved:
        spark.createDataFrame(saved, REGISTRY).coalesce(1).write.mode("append").parquet(f"{root}/registry")


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(f"{root}/registry")


def latest_models(registry: DataFrame) -> DataFrame:
    """The newest model of each (type, tenant), matched on the exact tenant."""
    return registry.groupBy("model_type", "ad_client_id").agg(
        F.max("run_ts").alias("run_ts"),
        F.max_by("path", "run_ts").alias("path"),
    )


def with_file_name(registry: DataFrame) -> DataFrame:
    return registry.withColumn("file_name", F.substring_index("path", "/", -1))


def load_latest(spark: SparkSession, root: str, model_type: str, tenant: int) -> PipelineModel:
    found = latest_models(read_registry(spark, root)).where(
        (F.col("model_type") == model_type) & (F.col("ad_client_id") == tenant)
    ).first()
    if found is None:
        raise LookupError(f"no {model_type} model for tenant {tenant}")
    return PipelineModel.load(found["path"])
