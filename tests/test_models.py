"""Folds, interleaving, metrics and the Lasso against brute force."""

import math
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from duecast.operators import folds, forest, lasso, metrics, prep, splits
from duecast.params import Params

P = Params()


def _rows(spark, flags):
    data = [(1, int(paid), i, 0) for i, paid in enumerate(flags)]
    return spark.createDataFrame(data, "ad_client_id long, paid int, src_invoice_id long, line_no long")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.booleans(), min_size=6, max_size=40))
def test_interleave_matches_its_definition(spark, flags):
    rows = _rows(spark, flags)
    got = {r["src_invoice_id"]: r["position"] for r in splits.class_interleave(rows, P).collect()}
    paid = [i for i, f in enumerate(flags) if f]
    unpaid = [i for i, f in enumerate(flags) if not f]
    rare, often = (paid, unpaid) if len(unpaid) > len(paid) else (unpaid, paid)
    if len(rare) < 2:
        assert got == {}
        return
    step = math.ceil(len(often) / (len(rare) - 1))
    places = {row: i * (step + 1) for i, row in enumerate(rare)}
    free = [p for p in range(len(rare) * (step + 1)) if p % (step + 1)]
    places.update(dict(zip(often, free)))
    assert got == places


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.booleans(), min_size=12, max_size=45), st.integers(2, 6))
def test_stratified_folds_deal_the_classes_evenly(spark, flags, k):
    if len(set(flags)) < 2:
        return
    rows = _rows(spark, flags).withColumn("position", F.col("src_invoice_id"))
    got = {r["src_invoice_id"]: r["fold"] for r in folds.stratified_folds(rows, k, P).collect()}
    first = flags[0]
    laid = [i for i, f in enumerate(flags) if f == first] + [i for i, f in enumerate(flags) if f != first]
    want = {}
    for kind in (first, not first):
        members = [i for i in laid if flags[i] == kind]
        sizes = [sum(1 for p, i in enumerate(laid) if p % k == f and flags[i] == kind) for f in range(k)]
        labels = [f for f, size in enumerate(sizes) for _ in range(size)]
        want.update(dict(zip(members, labels)))
    assert got == want


@pytest.mark.parametrize("n,k", [(23, 10), (10, 10), (7, 10), (5, 2), (30, 7)])
def test_contiguous_folds(spark, n, k):
    got = folds.contiguous_folds(_rows(spark, [True] * n), k, replace(P, hot_group_rows=4)).collect()
    allowed = n // 2 if k >= n else k
    sizes = [n // allowed + (1 if f < n % allowed else 0) for f in range(allowed)]
    labels = [f for f, size in enumerate(sizes) for _ in range(size)]
    assert [r["fold"] for r in sorted(got, key=lambda r: r["src_invoice_id"])] == labels


def test_too_few_rows_get_no_folds(spark):
    assert folds.contiguous_folds(_rows(spark, [True] * 3), 10, P).count() == 0


def test_window_backs_off_to_nothing(spark):
    rows = spark.sql(
        "SELECT 1L AS ad_client_id, paid, TIMESTAMP_NTZ '2020-12-31 00:00:00' - make_dt_interval(d) AS dateinvoiced "
        "FROM VALUES (0, 0), (1, 500), (1, 900) AS t(paid, d)"
    )
    assert splits.time_split(rows, "paid = 1").count() == 0
    assert splits.time_split(rows).where("is_test = 1").count() == 1
    assert splits.backoff_days() == [365, 182, 91, 45, 22, 11, 5, 2, 1]


def test_metrics_of_a_known_confusion(spark):
    data = [(1, 1, 1)] * 6 + [(1, 1, 0)] * 2 + [(1, 0, 1)] * 1 + [(1, 0, 0)] * 3
    got = metrics.classification(spark.createDataFrame(data, "ad_client_id long, paid int, prediction int")).first()
    assert (got["tp"], got["fn"], got["fp"], got["tn"]) == (6, 2, 1, 3)
    assert got["auc"] == pytest.approx((6 / 8 + 3 / 4) / 2)
    assert got["f1"] == pytest.approx(12 / 15)


@pytest.mark.parametrize("hot_rows", [4, 10_000])
def test_roc_area_is_the_chance_of_the_right_order(spark, hot_rows):
    rng = np.random.default_rng(5)
    truth = rng.integers(0, 2, 200)
    score = np.round(rng.random(200) + 0.3 * truth, 1)
    rows = spark.createDataFrame([(1, int(t), float(s)) for t, s in zip(truth, score)], "ad_client_id long, paid int, score double")
    area = metrics.roc_area(metrics.roc_points(rows, hot_rows)).first()["auc"]
    high, low = score[truth == 1], score[truth == 0]
    chance = np.mean((high[:, None] > low) + 0.5 * (high[:, None] == low))
    assert area == pytest.approx(chance)


# ---- Lasso -----------------------------------------------------------------


def _descent(x, y, alpha):
    """Plain coordinate descent on centred columns of unit length."""
    means = x.mean(0)
    centred = x - means
    length = np.sqrt((centred**2).sum(0))
    length[length < 1e-9] = 1.0
    unit = centred / length
    w, left = np.zeros(x.shape[1]), y - y.mean()
    for _ in range(100_000):
        moved = 0.0
        for j in range(len(w)):
            size = unit[:, j] @ unit[:, j]
            if size < 0.5:
                continue
            pull = unit[:, j] @ left + size * w[j]
            new = np.sign(pull) * max(abs(pull) - alpha * len(y), 0) / size
            left -= unit[:, j] * (new - w[j])
            moved, w[j] = max(moved, abs(new - w[j])), new
        if moved < 1e-11:
            break
    coefficients = w / length
    return np.concatenate([[y.mean() - means @ coefficients], coefficients])


@pytest.fixture(scope="module")
def regression_data():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 6)) * [1, 10, 1000, 1, 1e5, 1] + [0, 5, 2000, 3, 1e6, 0]
    x[:, 3] = 3.0
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + 0.001 * x[:, 2] + rng.normal(size=300) + 30
    return x, y


@pytest.mark.parametrize("alpha", [1.0, 0.05, 0.005, 0.0005])
def test_lasso_matches_coordinate_descent(regression_data, alpha):
    x, y = regression_data
    z = np.column_stack([np.ones(len(y)), x, y])
    got = lasso.fit_path(z.T @ z, np.array([alpha]))[0]
    want = _descent(x, y, alpha)
    assert np.allclose(got * np.concatenate([[1], x.std(0)]), want * np.concatenate([[1], x.std(0)]), atol=1e-6)


def test_lasso_agrees_with_the_spark_regression(spark, regression_data):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import LinearRegression

    x, y = regression_data
    x = np.delete(x, 3, axis=1)
    alpha = 0.02
    z = np.column_stack([np.ones(len(y)), x, y])
    ours = lasso.fit_path(z.T @ z, np.array([alpha]))[0]
    data = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"])
    model = LinearRegression(
        solver="l-bfgs", elasticNetParam=1.0, standardization=True, regParam=alpha * math.sqrt(len(y) - 1),
        maxIter=500, tol=1e-12,
    ).fit(data)
    assert np.allclose(ours[1:] * x.std(0), model.coefficients.toArray() * x.std(0), atol=1e-4)


def test_cross_validation_picks_the_penalty_a_plain_loop_picks(regression_data):
    x, y = regression_data
    z = np.column_stack([np.ones(len(y)), x, y])
    fold = np.arange(len(y)) // 60
    sums = {int(f): z[fold == f].T @ z[fold == f] for f in np.unique(fold)}
    penalties = lasso.PENALTIES[75:]
    got = lasso.fit_sums(sums, penalties)
    errors = []
    for alpha in penalties:
        held = []
        for f in np.unique(fold):
            fit = _descent(x[fold != f], y[fold != f], alpha)
            held.append(np.mean((y[fold == f] - fit[0] - x[fold == f] @ fit[1:]) ** 2))
        errors.append(np.mean(held))
    assert got["alpha"] == penalties[int(np.argmin(errors))]
    assert got["cv_mse"] == pytest.approx(min(errors), rel=1e-6)


def test_product_sums_and_models_of_all_tenants(spark, regression_data):
    x, y = regression_data
    tenant = np.arange(len(y)) % 3
    fold = (np.arange(len(y)) // 3) % 4
    columns = ", ".join(f"x{i} double" for i in range(x.shape[1]))
    rows = [(int(t), int(f), *map(float, a), float(b)) for t, f, a, b in zip(tenant, fold, x, y)]
    table = spark.createDataFrame(rows, f"ad_client_id long, fold int, {columns}, y double").repartition(5)
    models = {r["ad_client_id"]: r for r in lasso.fit_tenants(lasso.product_sums(table), x.shape[1]).collect()}
    for t in range(3):
        own = tenant == t
        z = np.column_stack([np.ones(own.sum()), x[own], y[own]])
        want = lasso.fit_sums({f: z[fold[own] == f].T @ z[fold[own] == f] for f in range(4)})
        assert models[t]["alpha"] == want["alpha"] and models[t]["n"] == own.sum()
        assert np.allclose(models[t]["coefficients"], want["coefficients"], rtol=1e-6, atol=1e-9)


def test_sums_of_many_groups_are_flushed(spark):
    rows = [(t, 0, float(t), 1.0) for t in range(1200)]
    table = spark.createDataFrame(rows, "ad_client_id long, fold int, x0 double, y double").coalesce(1)
    assert lasso.product_sums(table).groupBy("cell").count().where("count <> 1200").count() == 0


def test_days_come_from_the_newest_model_of_the_tenant(spark, tmp_path):
    from datetime import datetime

    from duecast.operators import score
    from duecast.plans import training

    names = [*prep.NUMERIC, "paymentrule=P", "tendertype=Missing"]
    for year, base in ((2020, 100.0), (2021, 10.0)):
        fits = spark.createDataFrame([(1, base, [float(i) for i in range(len(names))])],
                                     "ad_client_id long, intercept double, coefficients array<double>")
        models = lasso.with_names(fits, names).withColumn("run_ts", F.lit(datetime(year, 1, 1)).cast("timestamp_ntz"))
        models.write.mode("append").parquet(str(tmp_path / "regression_models"))
    values = {c: float(i % 3) for i, c in enumerate(prep.NUMERIC)}
    rows = spark.createDataFrame([(1, 1, "P", None), (2, 1, "Q", "A")],
                                 "row_id long, ad_client_id long, paymentrule string, tendertype string")
    rows = rows.withColumns({c: F.lit(v) for c, v in values.items()}).withColumn("late", F.lit(None).cast("int"))
    days = {r["row_id"]: r["days"] for r in score.predict_days(rows, training.latest_days_models(spark, str(tmp_path))).collect()}
    dot = 10.0 + sum(i * (i % 3) for i, c in enumerate(prep.NUMERIC) if c != "late")
    assert days == {1: dot + len(prep.NUMERIC) + len(prep.NUMERIC) + 1, 2: dot}


def test_unknown_category_is_all_zeros(spark):
    hot = prep.one_hot_expressions({"tendertype": ["A", "it's"]})
    rows = spark.createDataFrame([("A",), ("it's",), ("Z",)], "tendertype string")
    got = [tuple(r) for r in rows.selectExpr(*hot.values()).collect()]
    assert got == [(1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]


@pytest.mark.parametrize("chunk, nodes", [(20_000, 2_000_000), (37, 60)])
def test_votes_of_rows_equal_the_model(spark, tmp_path, monkeypatch, chunk, nodes):
    """Two groups' forests applied in one job: as Spark applies each, and by their first trees."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from duecast.operators import trees

    monkeypatch.setattr(trees, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(trees, "BLOCK_NODES", nodes)
    rows = spark.range(400).selectExpr(
        "id", "id % 2 AS part", "rand(1) AS a", "rand(2) AS b", "CAST(floor(rand(3) * 3) AS STRING) AS c"
    ).withColumn("label", F.expr("CAST((a > 0.5) = (c = '1' OR b > 0.8) AS DOUBLE)"))
    rows = StringIndexer(inputCol="c", outputCol="ci").fit(rows).transform(rows)
    rows = OneHotEncoder(inputCol="ci", outputCol="ch").fit(rows).transform(rows)
    rows = VectorAssembler(inputCols=["a", "b", "ch"], outputCol="v").transform(rows).cache()
    fitted, want, first = None, {}, {}
    for part in (0, 1):
        own = rows.where(f"part = {part}")
        model = RandomForestClassifier(featuresCol="v", numTrees=7, maxDepth=6, seed=part).fit(own)
        model.write().overwrite().save(f"{tmp_path}/{part}")
        got = trees.tree_rows(spark, f"{tmp_path}/{part}").withColumn("part", F.lit(part).cast("long"))
        fitted = got if fitted is None else fitted.unionByName(got)
        for r in model.transform(own).select("id", "prediction", vector_to_array("probability").alias("p")).collect():
            want[r["id"]] = (r["prediction"], r["p"][1])
        for tree in model.trees[:2]:
            for r in tree.transform(own).select("id", vector_to_array("probability").alias("p")).collect():
                first[r["id"]] = first.get(r["id"], 0.0) + r["p"][1]
    given = rows.select("part", "id", vector_to_array("v").alias("features"))
    given = given.unionByName(given.limit(1).withColumn("part", F.lit(9).cast("long")))
    voted = trees.votes(fitted, given, ["part"], ["id"], [2, 7]).collect()
    assert len(voted) == 400
    for r in voted:
        zero, one = r["zero"][1], r["one"][1]
        assert (float(one > zero), pytest.approx(one / (zero + one), abs=1e-12)) == want[r["id"]]
        assert r["one"][0] == pytest.approx(first[r["id"]], abs=1e-12) and r["zero"][0] + r["one"][0] == pytest.approx(2)


def test_forest_beats_the_majority(spark, small):
    from duecast.plans import scoring, training
    from duecast.plans.model_queries import QUICK_GRID
    from duecast.plans.session import full_fact_table
    from duecast.sources import derived
    from duecast.sources.storage import scratch_path

    whole = full_fact_table(spark, small)
    table = whole.where("ad_client_id IN (2, 3)")
    # The third tenant has paid test lines only.
    newest = whole.where("ad_client_id = 1").agg(F.max("dateinvoiced")).first()[0]
    late = F.col("dateinvoiced") > F.lit(newest) - F.expr("make_dt_interval(500)")
    table = table.unionByName(whole.where("ad_client_id = 1").where(~late | (F.col("paid") == 1)))
    root = scratch_path(spark, "models")
    grid = replace(QUICK_GRID, trees=(3, 10), sample_fraction=(0.3,), folds=3)
    status, predictions = training.train_classifiers(table, grid, derived.PARAMS, root, making_time())
    rows = {r["ad_client_id"]: r for r in status.collect()}
    assert [rows[t]["ok"] for t in (1, 2, 3)] == [0, 1, 1] and "one class" in rows[1]["message"]
    assert {r["ad_client_id"] for r in predictions.select("ad_client_id").distinct().collect()} == {2, 3}
    for tenant in (2, 3):
        paid = table.where(f"ad_client_id = {tenant}").agg(F.avg("paid")).first()[0]
        assert float(rows[tenant]["message"].split()[1]) > max(paid, 1 - paid)
    # All tenants in one job give what each saved pipeline gives.
    asked = table.withColumn("row_id", F.xxhash64("ad_client_id", "c_invoice_id"))
    got = {r["row_id"]: r for r in scoring.classify(asked, root).collect()}
    assert len(got) == table.where("ad_client_id <> 1").count()
    for tenant in (2, 3):
        model = training.latest_classifier(spark, root, tenant)
        for r in forest.predict(model, asked.where(f"ad_client_id = {tenant}")).collect():
            assert got[r["row_id"]]["prediction"] == r["prediction"]
            assert got[r["row_id"]]["score"] == pytest.approx(r["score"], abs=1e-12)
    with pytest.raises(LookupError):
        training.latest_classifier(spark, root, 30)


@pytest.mark.parametrize("name", ["train_classifier", "train_status", "score"])
def test_registered_queries_search_the_full_grid(monkeypatch, spark, small, name):
    from duecast.plans import training
    from duecast.plans.catalog import QUERIES

    class Asked(Exception):
        pass

    def asked(*args, **_):
        raise Asked(next(a for a in args if isinstance(a, forest.Grid)))

    monkeypatch.setattr(training, "train_classifiers", asked)
    monkeypatch.setattr(training, "run", asked)
    with pytest.raises(Asked) as found:
        QUERIES[name](spark, small)
    assert found.value.args[0] == forest.Grid()


def making_time():
    from datetime import datetime

    return datetime(2001, 2, 1, 3, 4, 5)


def test_one_class_tenant_fails_alone(spark):
    sizes = splits.class_problem(splits.class_sizes(_rows(spark, [True] * 5)))
    assert sizes.first()["problem"] == "all lines are of one class"


def test_a_grown_tree_takes_the_best_splits():
    """Against all splits tried one by one; two sampled rows of a leaf differ in no feature or agree in class."""
    from duecast.operators import trees

    draw = np.random.default_rng(3)
    x = draw.integers(0, 6, (300, 4)).astype(np.int8)
    label = ((x[:, 0] > 2) ^ (x[:, 2] < 2) ^ (draw.random(300) < 0.1)).astype(int)
    weight = draw.poisson(0.7, 300)
    tree = trees.grow(x, label, weight, 4, 30, draw)

    def impurity(rows):
        n, k = weight[rows].sum(), (weight * label)[rows].sum()
        return k * (n - k) / n if n else 0.0

    def check(node, rows):
        n = weight[rows].sum()
        assert tree["one"][node] == pytest.approx((weight * label)[rows].sum() / n)
        tried = [impurity(rows & (x[:, f] <= c)) + impurity(rows & (x[:, f] > c)) for f in range(4) for c in range(5)]
        if tree["feature"][node] < 0:
            assert min(tried) >= impurity(rows) - 1e-6
            return 1
        low = x[:, tree["feature"][node]] <= tree["threshold"][node]
        assert impurity(rows & low) + impurity(rows & ~low) == pytest.approx(min(tried))
        return 1 + check(tree["left"][node], rows & low) + check(tree["right"][node], rows & ~low)

    assert check(0, weight > 0) == len(tree["feature"]) > 3
    for label, weight in ((label * 0, weight), (label, weight * 0)):
        assert list(trees.grow(x, label, weight, 2, 30, draw)["feature"]) == [-1]


@pytest.mark.parametrize("most", [10**6, 0])
def test_search_needs_a_fit_only_for_chosen_forests_and_large_tenants(spark, small, monkeypatch, most):
    from duecast.operators import trees
    from duecast.plans import training
    from duecast.plans.model_queries import QUICK_GRID
    from duecast.plans.session import full_fact_table
    from duecast.sources import derived
    from duecast.sources.storage import scratch_path

    fits, estimator = [], forest.estimator
    monkeypatch.setattr(forest, "estimator", lambda *args: fits.append(args) or estimator(*args))
    monkeypatch.setattr(forest, "ROWS_A_GROUP", most)
    monkeypatch.setattr(trees, "TREES_A_GROUP", 3)
    grid = replace(QUICK_GRID, trees=(2, 7), sample_fraction=(0.2, 0.4), folds=3)
    table = full_fact_table(spark, small).where("ad_client_id IN (2, 3)")
    status, predictions = training.train_classifiers(table, grid, derived.PARAMS, scratch_path(spark, "models"), making_time())
    assert [r["ok"] for r in status.collect()] == [1, 1] and predictions.count() > 0
    assert len(fits) == (2 if most else 2 + 2 * 3 * 2)
    for row in status.collect():
        paid = table.where(F.col("ad_client_id") == row["ad_client_id"]).agg(F.avg("paid")).first()[0]
        assert float(row["message"].split()[1]) > max(paid, 1 - paid) - 0.03


def test_grown_trees_do_not_depend_on_how_they_are_dealt(spark, monkeypatch):
    from duecast.operators import trees

    grid = forest.Grid(trees=(2, 5), sample_fraction=(0.5,), folds=2)
    rows = spark.range(200).selectExpr(
        "-1L AS ad_client_id", "CAST(id AS STRING) AS c_invoice_id", "CAST(id % 2 AS INT) AS fold", "CAST(id % 7 > 2 AS INT) AS paid",
        "array(CAST(id % 3 AS TINYINT), CAST(id % 5 AS TINYINT)) AS features",
    )
    got = []
    for block, parts in ((25, 1), (2, 5)):
        monkeypatch.setattr(trees, "TREES_A_GROUP", block)
        found = trees.grown(rows.repartition(parts), grid, 7).collect()
        got.append({(r["fold"], r["tree"]): r for r in found})
    assert got[0] == got[1] and len(got[0]) == 10


@pytest.mark.parametrize("name", ["impute_constant", "best_model", "profile_backjoin"])
def test_tables_read_once_are_not_stored_with_all_partner_values(monkeypatch, spark, small, name):
    """Lines with the thirty values of their partner are wide; nothing of that shape is written."""
    from pyspark.sql import DataFrameWriter

    from duecast.plans.catalog import QUERIES

    written, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: written.append(set(self._df.columns)) or write(self, *a, **k))
    result = QUERIES[name](spark, small)
    assert result.count() > 0 and written
    assert not [columns for columns in written if {"paid", "total_invoices", "std_paid"} <= columns]


def test_folds_are_dealt_with_the_columns_they_need(monkeypatch, spark, small):
    from duecast.plans import model_queries, training

    seen, rows = [], training.class_training_rows
    monkeypatch.setattr(training, "class_training_rows", lambda table, *a: seen.append(table.columns) or rows(table, *a))
    assert model_queries.stratified_kfold(spark, small).count() > 0
    assert len(seen[0]) == 6


def test_least_costs_are_those_of_all_cuts():
    from duecast.operators import trees

    draw = np.random.default_rng(5)
    x, at = draw.integers(0, 9, (200, 3)).astype(np.int8), draw.integers(0, 40, 200)
    x[at == 7], at[:40] = 4, np.arange(40)  # a node that no column divides, no empty node
    label, weight = draw.integers(0, 2, 200).astype(float), draw.integers(1, 4, 200).astype(float)
    total, ones = np.bincount(at, weight, 40), np.bincount(at, weight * label, 40)
    cost, cut = trees.least_cost(x, label, weight, at, total, ones, 9)
    for node in range(40):
        for column in range(3):
            tried = {}
            for c in range(9):
                sides = [(at == node) & (x[:, column] <= c), (at == node) & (x[:, column] > c)]
                n, k = [weight[s].sum() for s in sides], [(weight * label)[s].sum() for s in sides]
                if min(n) > 0:
                    tried[c] = sum(b * (a - b) / a for a, b in zip(n, k))
            assert cost[node, column] == pytest.approx(min(tried.values(), default=np.inf))
            if tried:
                assert cut[node, column] == min(tried, key=lambda c: (round(tried[c], 9), c))


def test_large_tenants_are_fitted_in_parts_however_their_rows_lie(spark, small, monkeypatch):
    from duecast.plans import model_queries, training

    table = model_queries._in_full(spark, small)
    train = training.class_training_rows(table, forest.Grid(folds=2), P)[0].coalesce(1).cache()
    monkeypatch.setattr(forest, "ROWS_A_TASK", train.count() // 3)
    _, made = forest.ready(train)
    sizes = [r["n"] for r in made.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 3 and sum(sizes) == train.count() and max(sizes) < 2 * min(sizes)


def test_votes_hold_few_places_at_once_and_add_up_the_same(monkeypatch):
    import pyarrow as pa

    from duecast.operators import trees

    draw = np.random.default_rng(3)
    x, label = draw.integers(0, 9, (300, 4)).astype(np.int8), draw.integers(0, 2, 300)
    fitted = trees.Forest(pa.Table.from_pylist([
        {"tree": i, **trees.grow(x, label, draw.poisson(0.5, 300), 2, 30, draw)} for i in range(9)
    ]))
    share = lambda i, row: fitted.share[:, fitted.leaves(x[row : row + 1], fitted.roots[i : i + 1])[0, 0]]
    wanted = [[sum((share(i, row) for i in range(stop)), np.zeros(2)) for stop in (0, 4, 9)] for row in range(300)]
    held, leaves = [], trees.Forest.leaves
    monkeypatch.setattr(trees.Forest, "leaves", lambda *a: held.append(leaves(*a)) or held[-1])
    for places in (64, 1 << 14):
        monkeypatch.setattr(trees, "PLACES", places)
        assert np.array_equal(fitted.votes(x, [0, 4, 9]), np.moveaxis(np.array(wanted), 2, 0))
        assert max(found.size for found in held) <= places
        held.clear()


def test_folds_put_only_keys_in_order(spark, monkeypatch):
    seen, positions = [], folds.positions
    monkeypatch.setattr(folds, "positions", lambda df, *a: seen.append(df.columns) or positions(df, *a))
    rows = _rows(spark, [True] * 11).withColumn("wide", F.lit("x")).withColumn("line_no", F.col("src_invoice_id") % 2)
    rows = rows.withColumn("src_invoice_id", F.expr("src_invoice_id div 2"))
    got = folds.contiguous_folds(rows, 3, P).orderBy("src_invoice_id", "line_no").collect()
    assert [r["fold"] for r in got] == [0] * 4 + [1] * 4 + [2] * 3
    assert seen == [["ad_client_id", "src_invoice_id", "line_no"]]


def test_snapshots_need_no_line_numbers(monkeypatch, spark, small):
    from pyspark.sql import DataFrameWriter

    from duecast.plans.catalog import QUERIES

    written, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: written.append(set(self._df.columns)) or write(self, *a, **k))
    assert QUERIES["cashflow_forecast"](spark, small).count() > 0 and written
    assert not [columns for columns in written if "line_no" in columns]


def test_coefficients_are_looked_up_once_a_model(spark, capsys):
    from duecast.operators import score

    names = [*prep.NUMERIC, "paymentrule=P", "tendertype=Missing"]
    fits = spark.createDataFrame([(1, 2.0, [float(i) for i in range(len(names))])],
                                 "ad_client_id long, intercept double, coefficients array<double>")
    rows = spark.range(3).selectExpr("id AS row_id", "1L AS ad_client_id", "'P' AS paymentrule", "CAST(NULL AS STRING) AS tendertype",
                                     *[f"CAST(id + {i} AS DOUBLE) AS {c}" for i, c in enumerate(prep.NUMERIC)])
    days = score.predict_days(rows, lasso.with_names(fits, names))
    for r in days.collect():
        dot = sum((r["row_id"] + i) * i for i in range(len(prep.NUMERIC)))
        assert r["days"] == pytest.approx(2.0 + dot + 2 * len(prep.NUMERIC) + 1)
    days.explain()
    above = capsys.readouterr().out.split("Join")[0]
    assert above.count("try_element_at") + above.count("element_at(") <= 2 * len(prep.CATEGORICAL)


def test_features_of_rows_need_no_lambda_a_number(spark, capsys):
    """A lambda is interpreted; only the few labels of a category are still looked at by one."""
    labels = [["A", "P"], ["Missing"]]
    inputs = spark.createDataFrame([(1, [1.0] * len(prep.NUMERIC), [2.0] * len(prep.NUMERIC), labels)], forest.INPUTS)
    rows = spark.range(2).selectExpr("id", "1L AS ad_client_id", "'P' AS paymentrule", "CAST(NULL AS STRING) AS tendertype",
                                     *[f"IF(id = 0, NULL, {i}) AS {c}" for i, c in enumerate(prep.NUMERIC)])
    made = forest.with_features(rows, inputs)
    got = {r["id"]: r["features"] for r in made.collect()}
    assert got[0] == [-2.0] * len(prep.NUMERIC) + [0.0, 1.0, 1.0]
    assert got[1] == [(i - 1.0) * 2 for i in range(len(prep.NUMERIC))] + [0.0, 1.0, 1.0]
    made.select("features").explain()
    assert capsys.readouterr().out.count("lambdafunction") == len(prep.CATEGORICAL)


def test_searched_rows_lie_in_even_parts(spark, small, monkeypatch):
    from duecast.operators import trees
    from duecast.plans import model_queries, training
    from duecast.sources.storage import scratch_path

    table = model_queries._in_full(spark, small).where("ad_client_id = 2")
    monkeypatch.setattr(forest, "ROWS_A_TASK", 100)
    found, grown = [], trees.grown
    monkeypatch.setattr(trees, "grown", lambda codes, *a: found.append(codes) or grown(codes, *a))
    grid = forest.Grid(trees=(2,), sample_fraction=(0.2,), folds=2, max_depth=4)
    training.train_classifiers(table, grid, P, scratch_path(spark, "models"), making_time())
    sizes = [r["n"] for r in found[0].groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == sum(sizes) // 100 > 1 and max(sizes) < 2 * min(sizes)


def test_votes_are_dealt_over_more_places_than_cells(spark):
    """Left to adaptive execution, cells share a task where their bytes are few, however long they take."""
    from duecast.operators import trees

    grid = forest.Grid(trees=(3,), sample_fraction=(0.5,), folds=2)
    rows = spark.range(100).selectExpr(
        "1L AS ad_client_id", "CAST(id AS STRING) AS c_invoice_id", "CAST(id % 2 AS INT) AS fold", "CAST(id % 7 > 2 AS INT) AS paid",
        "array(CAST(id % 3 AS TINYINT), CAST(id % 5 AS TINYINT)) AS features",
    )
    voted = trees.votes(trees.grown(rows, grid, 7), rows.withColumn("fraction", F.lit(0.5)), ["ad_client_id", "fold", "fraction"], ["c_invoice_id"])
    assert voted.count() == 100 and voted.rdd.getNumPartitions() == 4 * 2


@pytest.mark.parametrize("name", ["score_json", "score_features", "score_join"])
def test_requests_and_facts_are_made_of_the_same_stored_entities(monkeypatch, spark, small, name):
    from pyspark.sql import DataFrameWriter

    from duecast.plans.catalog import QUERIES

    paths, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: paths.append(path) or write(self, path, *a, **k))
    assert QUERIES[name](spark, small).count() > 0
    made = [path.split("/")[-1].split("-")[0] for path in paths]
    assert made.count("orders") == 1 and made.count("c_invoice") == 1 and "asked" not in made
