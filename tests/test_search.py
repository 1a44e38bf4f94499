"""The search of forests: judged where they grow, with little of it stored or sent."""

from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from duecast.operators import forest, trees
from duecast.sources.derived import PARAMS as P


def _codes(spark, tenants):
    return spark.range(900).selectExpr(
        f"CAST(id % {tenants} AS BIGINT) - 1 AS ad_client_id", "CAST(id AS STRING) AS c_invoice_id", "CAST(pmod(xxhash64(id), 3) AS INT) AS fold",
        "CAST(rand(4) * 9 + id % 5 > 6 AS INT) AS paid",
        "array(CAST(id % 3 AS TINYINT), CAST(id % 5 AS TINYINT), CAST(id % 7 AS TINYINT), CAST(0 AS TINYINT)) AS features",
    )


def test_forests_are_judged_as_their_stored_trees_are(spark, monkeypatch):
    codes = _codes(spark, 2).localCheckpoint()
    grid = forest.Grid(trees=(2, 5, 9), sample_fraction=(0.3, 0.6), folds=3)
    shown = lambda df: sorted((r["ad_client_id"], r["n_trees"], r["fraction"], round(r["accuracy"], 12)) for r in df.collect())
    wanted = shown(forest.judged(trees.grown(codes, grid, 7), codes, grid))
    assert len(wanted) == 2 * 3 * 2
    for block, parts in ((25, 1), (4, 6)):
        monkeypatch.setattr(trees, "TREES_A_GROUP", block)
        tried = trees.grown(codes.repartition(parts), grid, 7, True)
        assert shown(forest.mean_accuracy(tried)) == wanted
        assert tried.count() == 2 * 3 * 3 * 2 and tried.agg(F.sum("rows")).first()[0] == 900 * 3 * 2


def test_packed_rows_come_back_whole(spark):
    import pyarrow as pa

    codes = _codes(spark, 1)
    rows = {r["place"]: r for r in codes.withColumn("place", F.xxhash64("c_invoice_id")).collect()}
    sent = [r["packet"] for r in trees.packets(codes.repartition(3)).collect()]
    fold, paid, x = trees.unpacked(pa.chunked_array([pa.array([bytes(p) for p in sent], pa.binary())]))
    for at, place in enumerate(sorted(rows)):
        assert (fold[at], paid[at], list(x[at])) == (rows[place]["fold"], rows[place]["paid"], rows[place]["features"])
    assert sum(len(p) for p in sent) < 900 * 16 and x.dtype == np.int8


def test_a_search_stores_no_trees_it_drops_and_no_wide_lines(spark, small, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from duecast.plans import model_queries, training
    from duecast.sources.storage import scratch_path

    table = model_queries._in_full(spark, small).where("ad_client_id = 2")
    written, write = {}, DataFrameWriter.parquet
    monkeypatch.setattr(
        DataFrameWriter, "parquet",
        lambda self, path, *a, **k: written.update({path.split("/")[-1].split("-")[0]: self._df.columns}) or write(self, path, *a, **k),
    )
    fits, estimator = [], forest.estimator
    monkeypatch.setattr(forest, "estimator", lambda *a: fits.append(estimator(*a)) or fits[-1])
    grid = forest.Grid(trees=(2, 4), sample_fraction=(0.2,), folds=2, max_depth=4)
    status, _ = training.train_classifiers(table, grid, P, scratch_path(spark, "models"), datetime(2001, 2, 1))
    assert [r["ok"] for r in status.collect()] == [1]
    assert not {"grid_trees", "forest_rows"} & set(written) and set(written["tried"]) == {c.split()[0] for c in trees.TRIED.split(", ")}
    assert {"interleaved", "class_train", "class_test"} <= set(written)
    assert not any({"grandtotal", "paid_total"} & set(written[name]) for name in ("interleaved", "class_train", "class_test"))
    assert not any(f.getCacheNodeIds() for f in fits)
