"""Registered queries: model inputs, splits, folds, metrics and training."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import features, folds, forest, lasso, metrics, prep, splits
from ..sources import derived
from ..sources.lake import Lake
from ..sources.storage import measured, scratch_path, stored
from . import nightly, training
from .oracle_base import statement
from .output import comparable, sql_columns
from .session import fact_table, facts, full_fact_table, shown_partners, tuned

P = derived.PARAMS
RUN = datetime(2001, 2, 1)
# The full grid is 9 settings of up to 500 trees; the registered queries search that one, tests this one.
QUICK_GRID = forest.Grid(trees=(10,), sample_fraction=(0.1, 0.3), folds=5, max_depth=6)
FOLDS = 5
HISTORY = "closed_invoices_no / total_invoices"
LIKELY = 0.75


def _in_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_fact_table(spark, sf_dir)


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored facts of one tenant, read by partition."""
    lake = stored(facts(spark, sf_dir), "lake", ["ad_client_id"])
    one = lake.where("ad_client_id = 1")
    return comparable(one.select("ad_client_id", "c_invoice_id", "paid", "late", "dayslate", "daystosettle", "grandtotal"))


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = facts(spark, sf_dir).select("ad_client_id", "src_invoice_id", "line_no", "c_invoice_id", "grandtotal")
    return comparable(lines.orderBy("ad_client_id", "src_invoice_id", "line_no").limit(5))


def feature_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.roles(_in_full(spark, sf_dir))


def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fact_table(spark, sf_dir)
    own = comparable(lines.select(*features.PARTNER_KEY, "c_invoice_id", *[c for c in prep.FEATURES if c in lines.columns]))
    rows = prep.impute_constant(features.with_partner_features(own, shown_partners(lines)))
    return rows.select("ad_client_id", "c_invoice_id", *prep.FEATURES)


SCALED = ["dayslate", "late", "totalopenamt", "paid_late_percent", "avg_paid", "max_late_paid"]


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.time_split(prep.impute_constant(_in_full(spark, sf_dir)))
    scaled = prep.standard_scale(rows, "is_test = 0", SCALED)
    return comparable(
        scaled.select("ad_client_id", "c_invoice_id", *[(F.round(F.col(c), 6) + F.lit(0.0)).alias(c) for c in SCALED])
    )


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of the training rows, applied to all rows."""
    rows = splits.time_split(prep.impute_constant(fact_table_inputs(spark, sf_dir)))
    vocabulary = prep.categories(rows.where("is_test = 0"))
    hot = prep.one_hot_expressions(vocabulary)
    shown = rows.selectExpr("ad_client_id", "c_invoice_id", *[f"{e} AS `{n}`" for n, e in hot.items()])
    digits = [
        F.concat(*[F.col(f"`{c}={v}`").cast("int").cast("string") for v in vocabulary[c]]).alias(f"{c}_hot")
        for c in prep.CATEGORICAL
    ]
    return shown.select("ad_client_id", "c_invoice_id", *digits)


def fact_table_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored facts with the inputs that need no partner features; the others null."""
    lines = fact_table(spark, sf_dir)
    absent = [c for c in prep.NUMERIC if c not in lines.columns]
    return lines.selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS {c}" for c in absent])


def mean_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training.days_split_rows(_in_full(spark, sf_dir))
    shown = ["paid_late_percent", "paid_late_raport_percent", "late_unpaid_invoices_sum_percent", "avg_paid", "daystosettle"]
    return comparable(rows.select("ad_client_id", "c_invoice_id", "is_test", *shown))


def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.time_split(fact_table(spark, sf_dir), training.PAID)
    return comparable(rows.select("ad_client_id", "c_invoice_id", "n_days", "is_test"))


def time_split_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(splits.window_sizes(fact_table(spark, sf_dir), training.PAID))


def yearly_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.yearly_split(fact_table(spark, sf_dir))
    return comparable(rows.select("ad_client_id", "c_invoice_id", "n_years", "role"))


def train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training.days_training_rows(_in_full(spark, sf_dir))
    return comparable(rows.select("ad_client_id", "c_invoice_id", "paid_late_percent", "avg_late_paid", "daystosettle"))


def class_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.class_interleave(fact_table(spark, sf_dir), P)
    return comparable(rows.select("ad_client_id", "c_invoice_id", "paid", "class_position", "position"))


def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = folds.contiguous_folds(fact_table(spark, sf_dir).where(training.PAID), training.REGRESSION_FOLDS, P)
    return comparable(rows.select("ad_client_id", "c_invoice_id", "fold"))


def stratified_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rows are dealt and stored several times on the way: with the columns that are used, not all of the facts.
    lines = fact_table(spark, sf_dir).select("ad_client_id", "c_invoice_id", "paid", splits.MOMENT, *splits.ROW_ORDER)
    train, _ = training.class_training_rows(lines, forest.Grid(folds=FOLDS), P)
    return comparable(train.select("ad_client_id", "c_invoice_id", "paid", "fold"))


def fold_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds per partner-sized training set: small ones fall below the request."""
    lines = facts(spark, sf_dir)
    per_tenant = folds.fold_counts(lines, training.REGRESSION_FOLDS).withColumn("level", F.lit("tenant"))
    per_partner = folds.fold_counts(
        lines.withColumn("ad_client_id", F.col("c_bpartner_id")), training.REGRESSION_FOLDS
    ).withColumn("level", F.lit("partner"))
    return comparable(per_tenant.unionByName(per_partner).withColumnRenamed("ad_client_id", "set_id"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with a plain prediction: the partner's share of closed lines."""
    lines = fact_table(spark, sf_dir).where("c_bpartner_id IS NOT NULL")
    test = splits.time_split(lines).where("is_test = 1").select(*features.PARTNER_KEY, "paid")
    counts = features.partner_features(lines).select(*features.PARTNER_KEY, "closed_invoices_no", "total_invoices")
    joined = stored(features.with_partner_features(test, measured(counts, "partners")), "judged")
    scored = joined.withColumn("score", F.expr(HISTORY))
    return scored.withColumn("prediction", F.expr(f"IF(score >= {LIKELY}D, 1, 0)"))


def cls_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(metrics.classification(_judged(spark, sf_dir)))


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = metrics.roc_points(_judged(spark, sf_dir), P.hot_group_rows)
    return comparable(points.select("ad_client_id", "threshold", "tp", "fp", "tpr", "fpr"))


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(metrics.roc_area(metrics.roc_points(_judged(spark, sf_dir), P.hot_group_rows)))


def reg_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training.days_split_rows(_in_full(spark, sf_dir))
    return comparable(metrics.regression(rows, ["ad_client_id", "is_test"], "daystosettle", "avg_days_paid_late"))


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut-off on the partner's history that classifies best per tenant."""
    judged = _judged(spark, sf_dir).select("ad_client_id", "paid", "score")
    tried = judged.selectExpr("*", "explode(array(50, 60, 70, 80, 90)) AS cutoff")
    results = tried.groupBy("ad_client_id", "cutoff").agg(
        F.expr("CAST(count_if((score >= cutoff / 100) = (paid = 1)) AS DOUBLE) / count(*)").alias("accuracy")
    )
    return comparable(metrics.best_candidate(results, ["ad_client_id"], "cutoff", "accuracy"))


def lasso_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of products of the model inputs, on a logarithmic scale."""
    table = _in_full(spark, sf_dir)
    sums, names = training.final_sums(table, training.vocabulary_of(table), P)
    named = lasso.named_cells(sums, names).where("value <> 0")
    counts = named.where("left_name = '1' AND right_name = '1'").selectExpr("ad_client_id", "fold", "value AS n")
    return comparable(
        named.join(counts, ["ad_client_id", "fold"]).selectExpr(
            "ad_client_id", "fold", "left_name", "right_name", "sign(value) * ln(1 + abs(value) / n) AS log_mean"
        )
    )


def lasso_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen penalty of every tenant and the coefficients under it."""
    table = _in_full(spark, sf_dir)
    return lasso.coefficient_rows(training.days_models(table, training.vocabulary_of(table), P))


def lasso_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _in_full(spark, sf_dir)
    vocabulary = training.vocabulary_of(table)
    models = measured(training.days_models(table, vocabulary, P), "days_models")
    return training.days_model_stats(table, models, vocabulary, P)


def train_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the forests trained for all tenants."""
    root = scratch_path(spark, "models")
    _, predictions = training.train_classifiers(_in_full(spark, sf_dir), forest.Grid(), P, root, RUN)
    return training.classification_stats(predictions, RUN)


def train_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each tenant got both models."""
    root = scratch_path(spark, "models")
    status = training.run(_in_full(spark, sf_dir), root, forest.Grid(), P, RUN)
    return comparable(status.select("ad_client_id", "step", "ok"))


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per tenant how the steps of a nightly run went, as the run itself records it."""
    root = scratch_path(spark, "lake")
    nightly.run(derived.ledger_sources(tuned(spark), sf_dir), root, P, RUN)
    status = Lake(spark, root).read("run_status", T.StructType.fromDDL(nightly.STATUS))
    return comparable(status.select("ad_client_id", "step", "ok", "result_rows"))


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar functions of the engine, each on every order."""
    orders = tuned(spark).read.parquet(f"{sf_dir}/orders.parquet")
    return comparable(
        orders.selectExpr(
            "o_orderkey",
            "to_timestamp_ntz(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), 'yyyy-MM-dd HH:mm:ss') AS parsed",
            "o_orderdate + make_dt_interval(CAST(o_orderkey % 400 AS INT)) AS shifted",
            "datediff(CAST(o_orderdate AS DATE), DATE '1998-01-01') AS days_since",
            "CAST(bround(o_orderkey / 2, 0) AS BIGINT) AS half_even",
            "CAST(ceil(o_orderkey / 7) AS BIGINT) AS ceiling",
            "o_orderkey div 2 AS halved",
            "concat_ws('_', CAST(o_orderkey AS STRING), CAST(o_orderkey % 3 AS STRING)) AS line_id",
            "CAST(endswith(CAST(o_orderkey AS STRING), '7') AS INT) AS ends_in_seven",
            "substring_index(concat('models/', o_orderpriority, '/', o_orderkey), '/', -1) AS last_segment",
            "greatest(o_orderkey % 100 - 50, 0) AS clamped",
            "IF(o_orderstatus = 'F', 1, 0) AS finished",
            "coalesce(nullif(o_orderkey % 5, 0), -1) AS filled",
            "date_format(o_orderdate, \"yyyyMMdd'T'HHmmss\") AS stamp",
        )
    )


QUERIES = {
    "training_rows": training_rows,
    "head_rows": head_rows,
    "feature_roles": feature_roles,
    "impute_constant": impute_constant,
    "mean_impute": mean_impute,
    "standard_scale": standard_scale,
    "one_hot": one_hot,
    "time_split": time_split,
    "time_split_backoff": time_split_backoff,
    "yearly_split": yearly_split,
    "train_all": train_all,
    "class_interleave": class_interleave,
    "kfold_assign": kfold_assign,
    "stratified_kfold": stratified_kfold,
    "fold_guard": fold_guard,
    "cls_metrics": cls_metrics,
    "roc_curve": roc_curve,
    "roc_auc": roc_auc,
    "reg_metrics": reg_metrics,
    "best_model": best_model,
    "lasso_gram": lasso_gram,
    "lasso_path": lasso_path,
    "lasso_stats": lasso_stats,
    "train_classifier": train_classifier,
    "train_status": train_status,
    "run_status": run_status,
    "scalar_functions": scalar_functions,
}

# ---- oracles ---------------------------------------------------------------

_WINDOW = """
paid_split AS (
  SELECT f.*, CASE WHEN f.dateinvoiced > w.newest - INTERVAL 365 DAY THEN 1 ELSE 0 END AS is_test
  FROM full_facts f JOIN (
    SELECT ad_client_id, max(dateinvoiced) AS newest,
      max(dateinvoiced) FILTER (paid = 1) AS newest_paid FROM facts GROUP BY 1) w USING (ad_client_id)
  WHERE f.paid = 1 AND w.newest_paid > w.newest - INTERVAL 365 DAY),
any_split AS (
  SELECT f.*, CASE WHEN f.dateinvoiced > w.newest - INTERVAL 365 DAY THEN 1 ELSE 0 END AS is_test
  FROM full_facts f JOIN (
    SELECT ad_client_id, max(dateinvoiced) AS newest FROM facts GROUP BY 1) w USING (ad_client_id))"""

_JUDGED = """
judged AS (
  SELECT ad_client_id, paid, CAST(closed_invoices_no AS DOUBLE) / total_invoices AS score
  FROM any_split WHERE is_test = 1),
predicted AS (SELECT *, CASE WHEN score >= 0.75 THEN 1 ELSE 0 END AS prediction FROM judged),
confusion AS (
  SELECT ad_client_id, count(*) FILTER (paid = 1 AND prediction = 1) AS tp,
    count(*) FILTER (paid = 0 AND prediction = 0) AS tn, count(*) FILTER (paid = 0 AND prediction = 1) AS fp,
    count(*) FILTER (paid = 1 AND prediction = 0) AS fn FROM predicted GROUP BY 1)"""

_MEANS = "mean_filled AS (SELECT * REPLACE (" + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), avg(CAST({c} AS DOUBLE)) OVER (PARTITION BY ad_client_id, is_test)) AS {c}"
    for c in training.IMPUTED
) + ") FROM paid_split)"

_ALL_MEANS = "all_filled AS (SELECT * REPLACE (" + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), avg(CAST({c} AS DOUBLE)) OVER (PARTITION BY ad_client_id)) AS {c}"
    for c in training.IMPUTED
) + ") FROM full_facts WHERE paid = 1)"

_FOLDED = """
folded AS (
  SELECT *, ntile(10) OVER (PARTITION BY ad_client_id ORDER BY src_invoice_id, line_no) - 1 AS fold
  FROM all_filled)"""

_INTERLEAVED = """
sized AS (
  SELECT *, row_number() OVER (PARTITION BY ad_client_id, paid ORDER BY src_invoice_id, line_no) - 1 AS class_position,
    sum(paid) OVER (PARTITION BY ad_client_id) AS n1,
    sum(1 - paid) OVER (PARTITION BY ad_client_id) AS n0
  FROM any_split),
stepped AS (
  SELECT *, CASE WHEN n0 > n1 THEN 1 ELSE 0 END AS rare,
    CAST(ceil(CAST(greatest(n0, n1) AS DOUBLE) / (least(n0, n1) - 1)) AS BIGINT) AS step
  FROM sized WHERE least(n0, n1) >= 2),
interleaved AS (
  SELECT *, CASE WHEN paid = rare THEN class_position * (step + 1)
    ELSE (class_position // step) * (step + 1) + 1 + class_position % step END AS position
  FROM stepped)"""

# Surplus rows of a stratified fold are counted place by place: the classes are
# laid end to end and dealt out one by one.
_STRATIFIED = """
train_rows AS (
  SELECT *, min(position) OVER (PARTITION BY ad_client_id, paid) AS class_start FROM interleaved WHERE is_test = 0),
dealt AS (
  SELECT *, row_number() OVER (PARTITION BY ad_client_id ORDER BY class_start, src_invoice_id, line_no) - 1 AS place,
    row_number() OVER (PARTITION BY ad_client_id, paid ORDER BY src_invoice_id, line_no) - 1 AS rank_in_class
  FROM train_rows),
fold_size AS (
  SELECT ad_client_id, paid, place % 5 AS fold, count(*) AS n FROM dealt GROUP BY 1, 2, 3),
fold_end AS (
  SELECT *, sum(n) OVER (PARTITION BY ad_client_id, paid ORDER BY fold) AS stop FROM fold_size),
stratified AS (
  SELECT d.ad_client_id, d.c_invoice_id, d.paid, min(e.fold) AS fold
  FROM dealt d JOIN fold_end e ON e.ad_client_id = d.ad_client_id AND e.paid = d.paid AND d.rank_in_class < e.stop
  GROUP BY 1, 2, 3)"""


def _imputed(spec: list[str]) -> str:
    numeric = [f"round(coalesce(CAST({c} AS DOUBLE), 0), {4 if c.startswith('std_') else 6}) AS {c}" for c in spec if c in prep.NUMERIC]
    text = [f"coalesce({c}, 'Missing') AS {c}" for c in spec if c in prep.CATEGORICAL]
    return ", ".join(numeric + text)


def _scaled(column: str) -> str:
    value = f"coalesce(CAST({column} AS DOUBLE), 0)"
    over = "OVER (PARTITION BY ad_client_id)"
    fitted = f"CASE WHEN is_test = 0 THEN {value} END"
    spread = f"CASE WHEN max({fitted}) {over} = min({fitted}) {over} THEN 1 ELSE stddev_pop({fitted}) {over} END"
    return f"round(({value} - avg({fitted}) {over}) / ({spread}), 6) + 0.0 AS {column}"


def _hot(column: str) -> str:
    return (
        f"(SELECT string_agg(CASE WHEN v = coalesce({column}, 'Missing') THEN '1' ELSE '0' END, '' ORDER BY v) "
        f"FROM (SELECT DISTINCT coalesce({column}, 'Missing') AS v FROM any_split WHERE is_test = 0)) AS {column}_hot"
    )


def _gram_sql() -> str:
    values = ["'1' AS name, CAST(1 AS DOUBLE) AS v"]
    values += [f"'{c}', coalesce(CAST({c} AS DOUBLE), 0)" for c in prep.NUMERIC]
    values += [f"'{c}=' || coalesce({c}, 'Missing'), 1" for c in prep.CATEGORICAL]
    values += ["'y', CAST(daystosettle AS DOUBLE)"]
    ranks = ["1", *prep.NUMERIC, *[f"{c}=" for c in prep.CATEGORICAL], "y"]
    rank = "CASE " + " ".join(f"WHEN name = '{n}' THEN {i}" for i, n in enumerate(ranks) if not n.endswith("="))
    rank += " " + " ".join(f"WHEN name LIKE '{n}%' THEN {i}" for i, n in enumerate(ranks) if n.endswith("=")) + " END"
    cells = " UNION ALL ".join(
        f"SELECT ad_client_id, fold, c_invoice_id, {v} FROM folded WHERE daystosettle IS NOT NULL" for v in values
    )
    ctes = (
        f"cells AS ({cells})",
        f"placed AS (SELECT *, {rank} AS place FROM cells)",
        "products AS (SELECT a.ad_client_id, a.fold, a.name AS left_name, b.name AS right_name, sum(a.v * b.v) AS value "
        "FROM placed a JOIN placed b ON a.ad_client_id = b.ad_client_id AND a.c_invoice_id = b.c_invoice_id "
        "AND (a.place < b.place OR (a.place = b.place AND a.name <= b.name)) GROUP BY 1, 2, 3, 4)",
        "sizes AS (SELECT ad_client_id, fold, value AS n FROM products WHERE left_name = '1' AND right_name = '1')",
    )
    return statement(
        "SELECT ad_client_id, fold, left_name, right_name, "
        "round(sign(value) * ln(1 + abs(value) / n), 6) AS log_mean FROM products JOIN sizes USING (ad_client_id, fold) "
        "WHERE value <> 0",
        _ALL_MEANS, _FOLDED, *ctes,
    )


ORACLE = {
    "train_status": statement(
        "SELECT ad_client_id, 'classification' AS step, CASE WHEN least(n_paid, n_unpaid) >= 2 AND test_paid > 0 AND test_unpaid > 0 "
        "THEN 1 ELSE 0 END::BIGINT AS ok FROM sizes "
        "UNION ALL SELECT ad_client_id, 'regression', CASE WHEN n_paid >= 4 THEN 1 ELSE 0 END::BIGINT FROM sizes",
        "sizes AS (SELECT ad_client_id, count(*) FILTER (paid = 1) AS n_paid, count(*) FILTER (paid = 0) AS n_unpaid, "
        "count(*) FILTER (paid = 1 AND late_one) AS test_paid, count(*) FILTER (paid = 0 AND late_one) AS test_unpaid FROM "
        "(SELECT ad_client_id, paid, dateinvoiced > max(dateinvoiced) OVER (PARTITION BY ad_client_id) - INTERVAL 365 DAY AS late_one "
        "FROM facts) GROUP BY 1)",
    ),
    "training_rows": statement(
        "SELECT "
        + sql_columns("ad_client_id:i c_invoice_id:x paid:i late:i dayslate:i daystosettle:i grandtotal:m")
        + " FROM facts WHERE ad_client_id = 1"
    ),
    "head_rows": statement(
        "SELECT " + sql_columns("ad_client_id:i src_invoice_id:i line_no:i c_invoice_id:x grandtotal:m")
        + " FROM facts ORDER BY facts.ad_client_id, facts.src_invoice_id, facts.line_no LIMIT 5"
    ),
    "feature_roles": statement(
        " UNION ALL ".join(
            f"SELECT ad_client_id, '{c}' AS feature, '{'numeric' if c in prep.NUMERIC else 'categorical'}' AS role, "
            f"count({c}) AS filled FROM full_facts GROUP BY 1"
            for c in prep.FEATURES
        )
    ),
    "impute_constant": statement(
        f"SELECT ad_client_id, c_invoice_id, {_imputed(prep.FEATURES)} FROM full_facts"
    ),
    "mean_impute": statement(
        "SELECT ad_client_id, c_invoice_id, CAST(is_test AS BIGINT) AS is_test, "
        + sql_columns(
            "paid_late_percent:r paid_late_raport_percent:r late_unpaid_invoices_sum_percent:r avg_paid:r daystosettle:r"
        )
        + " FROM mean_filled",
        _WINDOW, _MEANS,
    ),
    "standard_scale": statement(
        "SELECT ad_client_id, c_invoice_id, " + ", ".join(_scaled(c) for c in SCALED) + " FROM any_split", _WINDOW
    ),
    "one_hot": statement(
        f"SELECT ad_client_id, c_invoice_id, {_hot('paymentrule')}, {_hot('tendertype')} FROM any_split", _WINDOW
    ),
    "time_split": statement(
        "SELECT ad_client_id, c_invoice_id, CAST(365 AS BIGINT) AS n_days, CAST(is_test AS BIGINT) AS is_test FROM paid_split",
        _WINDOW,
    ),
    "time_split_backoff": statement(
        "SELECT ad_client_id, CAST(days AS BIGINT) AS days, count(*) FILTER (paid = 1 AND dateinvoiced > newest - INTERVAL 1 DAY * days) AS test_rows, "
        "CAST(CASE WHEN days = 365 THEN 1 ELSE 0 END AS BIGINT) AS chosen "
        "FROM facts JOIN (SELECT ad_client_id, max(dateinvoiced) AS newest FROM facts GROUP BY 1) USING (ad_client_id) "
        "CROSS JOIN (VALUES (365), (182), (91), (45), (22), (11), (5), (2), (1)) AS t(days) GROUP BY 1, 2, 4"
    ),
    "yearly_split": statement(
        "SELECT ad_client_id, c_invoice_id, CAST(n AS BIGINT) AS n_years, "
        "CASE WHEN dateinvoiced <= newest - INTERVAL 365 DAY * n THEN 'train' ELSE 'test' END AS role "
        "FROM facts JOIN (SELECT ad_client_id, max(dateinvoiced) AS newest FROM facts GROUP BY 1) USING (ad_client_id) "
        "CROSS JOIN (VALUES (1), (2), (3), (4)) AS t(n) WHERE dateinvoiced <= newest - INTERVAL 365 DAY * (n - 1)"
    ),
    "train_all": statement(
        "SELECT ad_client_id, c_invoice_id, " + sql_columns("paid_late_percent:r avg_late_paid:r daystosettle:r")
        + " FROM all_filled",
        _ALL_MEANS,
    ),
    "class_interleave": statement(
        "SELECT ad_client_id, c_invoice_id, "
        + sql_columns("paid:i class_position:i position:i") + " FROM interleaved",
        _WINDOW, _INTERLEAVED,
    ),
    "kfold_assign": statement(
        "SELECT ad_client_id, c_invoice_id, fold FROM folded", _ALL_MEANS, _FOLDED
    ),
    "stratified_kfold": statement(
        "SELECT ad_client_id, c_invoice_id, CAST(paid AS BIGINT) AS paid, fold FROM stratified",
        _WINDOW, _INTERLEAVED, _STRATIFIED,
    ),
    "fold_guard": statement(
        "SELECT *, CASE WHEN 10 >= n THEN n // 2 ELSE 10 END AS k, "
        "CAST(CASE WHEN CASE WHEN 10 >= n THEN n // 2 ELSE 10 END >= 2 THEN 1 ELSE 0 END AS BIGINT) AS enough FROM ("
        "SELECT ad_client_id AS set_id, count(*) AS n, 'tenant' AS level FROM facts GROUP BY 1 UNION ALL "
        "SELECT c_bpartner_id, count(*), 'partner' FROM facts GROUP BY 1)"
    ),
    "cls_metrics": statement(
        "SELECT ad_client_id, tp, tn, fp, fn, "
        "round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END, 6) AS precision, "
        "round(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END, 6) AS recall, "
        "round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6) AS accuracy, "
        "round(CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1, "
        "round((CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END "
        "+ CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / (tn + fp) END) / 2, 6) AS auc FROM confusion",
        _WINDOW, _JUDGED,
    ),
    "roc_curve": statement(
        "SELECT ad_client_id, round(score, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
        "round(CAST(tp AS DOUBLE) / all1, 6) AS tpr, round(CAST(fp AS DOUBLE) / all0, 6) AS fpr FROM ("
        "SELECT ad_client_id, score, sum(h) OVER (PARTITION BY ad_client_id ORDER BY score DESC) AS tp, "
        "sum(a) OVER (PARTITION BY ad_client_id ORDER BY score DESC) AS fp, "
        "sum(h) OVER (PARTITION BY ad_client_id) AS all1, sum(a) OVER (PARTITION BY ad_client_id) AS all0 FROM ("
        "SELECT ad_client_id, score, sum(paid) AS h, sum(1 - paid) AS a FROM judged GROUP BY 1, 2))",
        _WINDOW, _JUDGED,
    ),
    "roc_auc": statement(
        # The chance that a paid row scores above an unpaid one, ties counted half.
        "SELECT ad_client_id, round((sum(CASE WHEN paid = 1 THEN r END) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 6) AS auc "
        "FROM (SELECT ad_client_id, paid, sum(paid) OVER (PARTITION BY ad_client_id) AS n1, "
        "sum(1 - paid) OVER (PARTITION BY ad_client_id) AS n0, "
        "rank() OVER (PARTITION BY ad_client_id ORDER BY score) "
        "+ (count(*) OVER (PARTITION BY ad_client_id, score) - 1) / 2.0 AS r FROM judged) GROUP BY ad_client_id, n1, n0",
        _WINDOW, _JUDGED,
    ),
    "reg_metrics": statement(
        "SELECT ad_client_id, CAST(is_test AS BIGINT) AS is_test, count(*) AS n, "
        "round(avg((daystosettle - avg_days_paid_late) ** 2), 6) AS mse, "
        "round(1 - avg((daystosettle - avg_days_paid_late) ** 2) / var_pop(daystosettle), 6) AS r2 "
        "FROM mean_filled GROUP BY 1, 2",
        _WINDOW, _MEANS,
    ),
    "best_model": statement(
        "SELECT ad_client_id, CAST(cutoff AS BIGINT) AS cutoff, round(accuracy, 6) AS accuracy FROM ("
        "SELECT ad_client_id, cutoff, accuracy, row_number() OVER (PARTITION BY ad_client_id ORDER BY accuracy DESC, cutoff) AS r FROM ("
        "SELECT ad_client_id, cutoff, CAST(count(*) FILTER ((score >= cutoff / 100.0::DOUBLE) = (paid = 1)) AS DOUBLE) / count(*) AS accuracy "
        "FROM judged CROSS JOIN (VALUES (50), (60), (70), (80), (90)) AS t(cutoff) GROUP BY 1, 2)) WHERE r = 1",
        _WINDOW, _JUDGED,
    ),
    "lasso_gram": _gram_sql(),
    "run_status": statement(
        "SELECT ad_client_id, step, CAST(CASE WHEN n > 0 THEN 1 ELSE 0 END AS BIGINT) AS ok, n AS result_rows FROM ("
        "SELECT ad_client_id, 'aggregation' AS step, count(*) AS n FROM facts GROUP BY 1 UNION ALL "
        "SELECT ad_client_id, 'cleaning', least(i.n, p.n, a.n, t.n) FROM "
        "(SELECT ad_client_id, count(*) AS n FROM inv GROUP BY 1) i "
        "JOIN (SELECT ad_client_id, count(*) AS n FROM pay GROUP BY 1) p USING (ad_client_id) "
        "JOIN (SELECT ad_client_id, count(*) AS n FROM alloc GROUP BY 1) a USING (ad_client_id) "
        "JOIN (SELECT ad_client_id, count(*) AS n FROM term GROUP BY 1) t USING (ad_client_id))"
    ),
    "scalar_functions": (
        "SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed, "
        "o_orderdate + INTERVAL 1 DAY * CAST(o_orderkey % 400 AS INT) AS shifted, "
        "date_diff('day', DATE '1998-01-01', CAST(o_orderdate AS DATE)) AS days_since, "
        "CAST(round_even(o_orderkey / 2, 0) AS BIGINT) AS half_even, CAST(ceil(o_orderkey / 7) AS BIGINT) AS ceiling, "
        "o_orderkey // 2 AS halved, concat_ws('_', CAST(o_orderkey AS VARCHAR), CAST(o_orderkey % 3 AS VARCHAR)) AS line_id, "
        "CAST(ends_with(CAST(o_orderkey AS VARCHAR), '7') AS BIGINT) AS ends_in_seven, "
        "CAST(o_orderkey AS VARCHAR) AS last_segment, greatest(o_orderkey % 100 - 50, 0) AS clamped, "
        "CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS finished, "
        "coalesce(nullif(o_orderkey % 5, 0), -1) AS filled, strftime(o_orderdate, '%Y%m%dT%H%M%S') AS stamp FROM orders"
    ),
}
