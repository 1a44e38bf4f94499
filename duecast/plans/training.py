"""Training of both models of every tenant from the stored feature table."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import moment
from ..operators import folds, forest, lasso, metrics, prep, splits
from ..params import Params
from ..sources import registry
from ..sources.storage import measured, scratch_path, side_by_side, stored

PAID = "paid = 1"
REGRESSION_FOLDS = 10
IMPUTED = [*prep.NUMERIC, prep.DAYS_TARGET]

STATUS = "ad_client_id long, step string, ok int, message string"


def days_training_rows(table: DataFrame) -> DataFrame:
    """All paid rows, gaps filled with the tenant's means."""
    return prep.mean_impute(table.where(PAID), ["ad_client_id"], IMPUTED)


def days_split_rows(table: DataFrame) -> DataFrame:
    """Paid rows split by time, gaps filled with the means of their own side."""
    return prep.mean_impute(splits.time_split(table, PAID), ["ad_client_id", "is_test"], IMPUTED)


def final_sums(table: DataFrame, vocabulary: dict[str, list[str]], params: Params) -> tuple[DataFrame, list[str]]:
    rows = folds.contiguous_folds(days_training_rows(table), REGRESSION_FOLDS, params)
    inputs, names = lasso.design(rows, vocabulary)
    return lasso.product_sums(inputs), names


def evaluation_sums(table: DataFrame, vocabulary: dict[str, list[str]], params: Params) -> tuple[DataFrame, int]:
    rows = days_split_rows(table)
    train = folds.contiguous_folds(rows.where("is_test = 0"), REGRESSION_FOLDS, params)
    test = rows.where("is_test = 1").withColumn("fold", F.lit(lasso.HELD_OUT))
    inputs, names = lasso.design(train.unionByName(test), vocabulary)
    return lasso.product_sums(inputs), len(names)


def days_models(table: DataFrame, vocabulary: dict[str, list[str]], params: Params) -> DataFrame:
    """Fitted days-to-settle models of all tenants, one row each."""
    sums, names = final_sums(table, vocabulary, params)
    return lasso.with_names(lasso.fit_tenants(sums, len(names)), names)


def days_model_stats(
    table: DataFrame, models: DataFrame, vocabulary: dict[str, list[str]], params: Params
) -> DataFrame:
    """Per tenant the errors of its days-to-settle model.

    As recorded by the business: ``test_mse`` is measured on the training side
    of the split and ``test_r2`` on the test side; ``train_r2`` belongs to the
    final model.
    """
    judged = lasso.fit_tenants(*evaluation_sums(table, vocabulary, params))
    errors = judged.select("ad_client_id", F.col("train_mse").alias("test_mse"), "test_r2")
    return models.select("ad_client_id", "train_r2").join(errors, "ad_client_id", "left")


def class_training_rows(table: DataFrame, grid: forest.Grid, params: Params) -> tuple[DataFrame, DataFrame]:
    """Interleaved rows split by time: training rows with folds, and test rows."""
    rows = stored(splits.class_interleave(splits.time_split(table), params), "interleaved", ["ad_client_id"])
    train = folds.stratified_folds(rows.where("is_test = 0"), grid.folds, params)
    return stored(train, "class_train", ["ad_client_id"]), rows.where("is_test = 1")


def tenant_ids(table: DataFrame) -> Iterator[int]:
    """Tenants one by one; their number, not their data, passes the driver."""
    for row in table.select("ad_client_id").distinct().orderBy("ad_client_id").toLocalIterator():
        yield row["ad_client_id"]


def test_problem(test: DataFrame, tenants: list[int]) -> dict[int, str]:
    """Tenants whose test rows are not of both classes: nothing can be said about their forests."""
    sizes = splits.class_sizes(test).where("n_paid > 0 AND n_unpaid > 0").select("ad_client_id")
    fine = {r["ad_client_id"] for r in sizes.toLocalIterator()}
    return {t: "the test lines are all of one class" for t in tenants if t not in fine}


def train_classifiers(
    table: DataFrame, grid: forest.Grid, params: Params, root: str, run_ts: datetime
) -> tuple[DataFrame, DataFrame | None]:
    """One forest per tenant, saved, with a status row each, and test predictions.

    Fits are distributed jobs over one tenant's rows, ``grid.parallelism`` of them at a time; votes and
    predictions are one job for all tenants. A tenant whose data does not suffice fails alone.
    """
    spark = table.sparkSession
    # Rows are dealt and stored several times on the way: with the columns that are used, not all of the facts.
    table = table.select("ad_client_id", "c_invoice_id", "paid", splits.MOMENT, *splits.ROW_ORDER, *prep.FEATURES)
    train, test = class_training_rows(table, grid, params)
    test = stored(test, "class_test")
    failed = {
        r["ad_client_id"]: r["problem"]
        for r in splits.class_problem(splits.class_sizes(table)).where("problem IS NOT NULL").toLocalIterator()
    }
    tenants = list(tenant_ids(table))
    failed = test_problem(test, [t for t in tenants if t not in failed]) | failed
    messages: dict[int, str] = {}
    saved: list[tuple] = []

    with ThreadPool(grid.parallelism) as threads:
        pool = lambda job, items: threads.map(inheritable_thread_target(spark)(job), items, 1)
        models, chosen, inputs, problems = forest.search(
            spark, train, [t for t in tenants if t not in failed], grid, params, scratch_path(spark, "grid"), pool
        )
        failed |= problems

        def save(tenant: int) -> None:
            try:
                path = registry.save_model(models[tenant], root, "classification", tenant, run_ts)
                registry.save_trees(spark, path, root, tenant, run_ts)
                best = chosen[tenant]
                messages[tenant] = (
                    f"accuracy {best['accuracy']:.4f} with {best['n_trees']} trees on {best['fraction']} of the rows each"
                )
                saved.append(("classification", tenant, run_ts, path))
            except Exception as error:  # one tenant must not stop the others
                failed[tenant] = str(error)

        pool(save, list(models))
    registry.save_inputs(inputs, root, run_ts)
    registry.register(spark, saved, root)
    rows = [(t, "classification", int(t not in failed), failed.get(t) or messages[t]) for t in tenants]
    status = spark.createDataFrame(rows, STATUS)
    if not saved:
        return status, None
    fitted, known = registry.trees_of(spark, root, saved)
    key = ["c_invoice_id", "paid"]
    predicted = forest.predict_all(fitted, known, test.withColumn("paid", F.col("paid").cast("int")), key)
    path = f"{root}/test_predictions/{run_ts.strftime(registry.STAMP)}"
    predicted.select("ad_client_id", *key, "prediction", "score").write.mode("overwrite").parquet(path)
    return status, spark.read.schema(forest.PREDICTIONS).parquet(path)


def days_status(table: DataFrame, models: DataFrame) -> DataFrame:
    known = models.select("ad_client_id", F.lit(1).alias("found"))
    listed = table.select("ad_client_id").distinct().join(known, "ad_client_id", "left")
    return listed.selectExpr(
        "ad_client_id", "'regression' AS step", "coalesce(found, 0) AS ok",
        "IF(found = 1, 'fitted', 'too few paid lines') AS message",
    )


def classification_stats(predictions: DataFrame, date_run: datetime) -> DataFrame:
    """The statistics row of each tenant's classifier."""
    return metrics.classification(predictions).selectExpr(
        "ad_client_id", "auc", "precision", "recall", "accuracy", "accuracy AS score", "fp", "fn", "tp", "tn"
    ).withColumn("date_run", moment(date_run))


def vocabulary_of(table: DataFrame) -> dict[str, list[str]]:
    return prep.categories(prep.impute_constant(table).select(*prep.CATEGORICAL))


def latest_classifier(spark: SparkSession, root: str, tenant: int):
    return registry.load_latest(spark, root, "classification", tenant)


def latest_days_models(spark: SparkSession, root: str) -> DataFrame:
    """The newest days-to-settle model of each tenant."""
    kept = spark.read.parquet(f"{root}/regression_models")
    columns = [c for c in kept.columns if c != "ad_client_id"]
    newest = kept.groupBy("ad_client_id").agg(F.max_by(F.struct(*columns), "run_ts").alias("model"))
    return measured(newest.select("ad_client_id", "model.*"), "days_models")


def run(table: DataFrame, root: str, grid: forest.Grid, params: Params, run_ts: datetime) -> DataFrame:
    """Train, save and judge both models of every tenant; returns the status rows.

    Models and the two statistics tables are appended below ``root``.
    """
    stamp = moment(run_ts)

    def days(rows: DataFrame) -> DataFrame:
        vocabulary = vocabulary_of(rows)
        models = measured(days_models(rows, vocabulary, params), "days_models").withColumn("run_ts", stamp)
        models.write.mode("append").parquet(f"{root}/regression_models")
        errors = days_model_stats(rows, models, vocabulary, params).withColumn("date_run", stamp)
        errors.write.mode("append").parquet(f"{root}/regression_stats")
        return days_status(rows, models)

    def classes(rows: DataFrame) -> DataFrame:
        status, predictions = train_classifiers(rows, grid, params, root, run_ts)
        if predictions is not None:
            classification_stats(predictions, run_ts).write.mode("append").parquet(f"{root}/classification_stats")
        return status

    # The two models need nothing of each other; jobs of the one fill the cores that those of the other leave idle.
    jobs = {"classes": classes, "days": days}
    done = side_by_side(dict.fromkeys(jobs, table), lambda name, rows: jobs[name](rows))
    return done["classes"].unionByName(done["days"])
