"""Registered queries: sinks, quality, statistics, incremental loads, registry."""

from __future__ import annotations

import contextlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import clean, features, incremental, ledger, quality, quarantine, stats
from ..schemas import CLEAN_REQUIRED, CLEANING_STATS, FACT_FLAGS, FACT_REQUIRED, KEY, PRIMARY_KEY, SOURCES
from ..sources import derived, registry, tables
from ..sources.lake import Lake
from ..sources.storage import scratch_path
from ..streaming.incremental_stream import arrived, clean_arrivals
from . import nightly
from .oracle_base import statement
from .output import comparable, sql_columns
from .session import cleaned, fact_table, facts, tuned

P = derived.PARAMS
RUN = datetime(2001, 2, 1)
# Loads before this moment count as done, the rest is to be picked up.
LOADED_UNTIL = "2001-01-01"


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return derived.ledger_sources(tuned(spark), sf_dir)


def roundtrip_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned payments written to the lake in two loads and read back."""
    payments = cleaned(spark, sf_dir)["c_payment"]
    path = scratch_path(spark, "payments")
    tables.append_table(payments.where(f"created < '{LOADED_UNTIL}'"), path)
    tables.append_table(payments.where(f"created >= '{LOADED_UNTIL}'"), path)
    return comparable(tables.read_lake(spark, path, payments.schema))


REPLACED_TENANT = 1


def roundtrip_overwrite_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tenants' facts stored, then one tenant's facts replaced."""
    path = scratch_path(spark, "facts")
    lines = facts(spark, sf_dir).select(
        "ad_client_id", "c_invoice_id", "c_bpartner_id", "grandtotal", "allocatedamt", "paid", "late"
    )
    tables.replace_tenants(lines, path)
    stored = tables.read_lake(spark, path, lines.schema)
    paid_only = stored.where((F.col("ad_client_id") == REPLACED_TENANT) & (F.col("paid") == 1))
    second = scratch_path(spark, "replacement")
    paid_only.write.parquet(second)
    tables.replace_tenants(spark.read.schema(lines.schema).parquet(second), path)
    return comparable(tables.read_lake(spark, path, lines.schema))


def tenant_list_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).select("ad_client_id").distinct().orderBy("ad_client_id")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct feature rows exported to CSV and loaded with a schema."""
    rows = (
        facts(spark, sf_dir)
        .select("ad_client_id", "c_invoice_id", "dateinvoiced", "c_bpartner_id", "tendertype", "allocatedamt",
                "dayslate", "late", "paid", "daystosettle")
        .distinct()
    )
    path = scratch_path(spark, "export")
    tables.write_csv(rows, path)
    return comparable(tables.read_csv(spark, rows.schema, path))


def apply_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices whose optional values were left out, written with defaults."""
    partial = cleaned(spark, sf_dir)["c_invoice"].selectExpr(
        "ad_client_id", "c_invoice_id", "nullif(paymentrule, '5') AS paymentrule", "grandtotal",
        "nullif(totalopenamt, 0) AS totalopenamt", "IF(c_cashline_id = 0, paidamt, NULL) AS paidamt",
    )
    return comparable(tables.with_defaults(partial, "c_invoice"))


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints of the cleaned tables and the facts, and nulls in the sources."""
    sources = _sources(spark, sf_dir)
    checks = []
    for name, df in sources.items():
        checks.append(quality.not_null(df, f"source {name}", SOURCES[name].fieldNames()))
    for name, df in clean.clean_all(sources).items():
        checks.append(quality.not_null(df, name, CLEAN_REQUIRED[name]))
        key = [PRIMARY_KEY[name]] if name != "c_paymentterm" else ["ad_client_id", PRIMARY_KEY[name]]
        checks.append(quality.unique_key(df, name, key))
    lines = fact_table(spark, sf_dir)
    checks += [
        quality.not_null(lines, "facts", FACT_REQUIRED),
        quality.unique_key(lines, "facts", ["ad_client_id", "c_invoice_id"]),
        quality.zero_or_one(lines, "facts", FACT_FLAGS),
    ]
    return quality.report(checks)


def cleaning_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = _sources(spark, sf_dir)
    lines = ledger.build_facts(clean.clean_all(sources), P)
    return comparable(stats.cleaning_stats(sources, clean.tenants(sources["ad_client"]), lines, RUN))


def run_history(sources: dict[str, DataFrame]) -> DataFrame:
    """Statistics as monthly runs up to the cut-off would have left them."""
    history = None
    for entity in stats.SUFFIX:
        loaded = sources[entity].where(f"created < '{LOADED_UNTIL}'").withColumn(
            "date_run", F.expr("CAST(add_months(trunc(created, 'MM'), 1) AS TIMESTAMP_NTZ)")
        )
        counts = stats.entity_counts(entity, loaded, ["ad_client_id", "date_run"])
        history = counts if history is None else history.join(counts, ["ad_client_id", "date_run"], "full")
    return history.fillna(0)


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.high_water_marks(run_history(_sources(spark, sf_dir)))


def incremental_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = _sources(spark, sf_dir)
    marks = incremental.high_water_marks(run_history(sources))
    tenants = clean.tenants(sources["ad_client"])
    fresh = clean.clean("c_invoice", incremental.rows_after(sources["c_invoice"], marks, "c_invoice", P, tenants))
    return comparable(fresh.select("ad_client_id", "c_invoice_id", "created", "grandtotal"))


RUNS = [datetime(2000, 12, 31, 23, 59, 59), datetime(2001, 9, 1), datetime(2001, 9, 2)]


def nightly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and marks of three runs: a first load, the rest, and nothing new."""
    sources = _sources(spark, sf_dir)
    lake = scratch_path(spark, "lake")
    early = {k: v.where(f"created < '{LOADED_UNTIL}'") if "created" in v.columns else v for k, v in sources.items()}
    for date_run, rows in zip(RUNS, (early, sources, sources)):
        runs = nightly.run(rows, lake, P, date_run)
    marks = incremental.high_water_marks(runs).groupBy("ad_client_id").pivot("entity", list(stats.SUFFIX)).agg(
        F.first("high_water_mark")
    )
    held = [
        nightly.cleaned_table(Lake(spark, lake), spark, entity)
        .groupBy("ad_client_id")
        .agg(F.count("*").alias(f"held_{suffix}"))
        for entity, suffix in stats.SUFFIX.items()
    ]
    table = runs.select("ad_client_id", "date_run", *[c for c in runs.columns if c.startswith("no_") and "total" not in c])
    marks = marks.select("ad_client_id", *[F.col(e).alias(f"mark_{s}") for e, s in stats.SUFFIX.items()])
    for more in (marks, *held):
        table = table.join(more, "ad_client_id", "left")
    return comparable(table)


class _Stopped(Exception):
    pass


ADDED = 1_000_000_000


def nightly_broken_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lake holds after a run that broke once its facts were written, and after its repetition."""
    sources = _sources(spark, sf_dir)
    root = scratch_path(spark, "lake")
    lake = Lake(spark, root)
    nightly.run(sources, root, P, RUNS[0])
    copies = sources["c_invoice"].withColumns(
        {"c_invoice_id": F.col("c_invoice_id") + ADDED, "created": F.lit(RUNS[1]).cast("timestamp_ntz")}
    )
    more = {**sources, "c_invoice": sources["c_invoice"].unionByName(copies)}

    def stop(step: str) -> None:
        if step == "facts":
            raise _Stopped

    def state(name: str) -> DataFrame:
        counted = lambda df, c: df.groupBy("ad_client_id").agg(F.count("*").alias(c))
        facts_now = counted(lake.read("facts", T.StructType.fromDDL("ad_client_id long, c_invoice_id string")), "fact_rows")
        invoices = counted(nightly.cleaned_table(lake, spark, "c_invoice"), "invoices")
        runs = counted(lake.read("cleaning_stats", CLEANING_STATS), "runs")
        return invoices.join(facts_now, "ad_client_id").join(runs, "ad_client_id").withColumn("state", F.lit(name))

    with contextlib.suppress(_Stopped):
        nightly.run(more, root, P, RUNS[2], stop)
    before = state("broken")
    nightly.run(more, root, P, RUNS[2])
    return comparable(before.unionByName(state("repeated")))


TOO_MUCH = "99999999999999999999"


def nightly_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in which one tenant has amounts beyond all bounds and one has invoices without a key."""
    sources = _sources(spark, sf_dir)
    amount = f"IF(ad_client_id = 2 AND c_payment_id % 100 = 7, {TOO_MUCH}, CAST(payamt AS DECIMAL(38,2)))"
    key = "IF(ad_client_id = 3 AND c_invoice_id % 100 = 9, NULL, c_invoice_id)"
    bad = {
        "c_payment": sources["c_payment"].withColumn("payamt", F.expr(amount)),
        "c_invoice": sources["c_invoice"].withColumn("c_invoice_id", F.expr(key)),
    }
    root = scratch_path(spark, "lake")
    nightly.run({**sources, **bad}, root, P, RUN)
    lake = Lake(spark, root)
    status = lake.read("run_status", T.StructType.fromDDL(nightly.STATUS))
    rejected = lake.read("rejected_rows", T.StructType.fromDDL(quarantine.REJECTS)).groupBy("ad_client_id").agg(
        F.count("*").alias("rejected"), F.max("rule").alias("rule"), F.max("column_name").alias("column_name")
    )
    facts_now = lake.read("facts", T.StructType.fromDDL("ad_client_id long")).groupBy("ad_client_id").agg(F.count("*").alias("fact_rows"))
    joined = status.join(rejected, "ad_client_id", "left").join(facts_now, "ad_client_id", "left")
    return comparable(joined.select("ad_client_id", "step", "ok", "result_rows", "rejected", "rule", "column_name", "fact_rows"))


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices after a load of changed, voided, outdated and new documents."""
    held = _sources(spark, sf_dir)["c_invoice"].withColumn("updated", F.col("created"))
    lake = Lake(spark, scratch_path(spark, "lake"))
    schema = clean.clean("c_invoice", held).schema
    later = "IF(c_invoice_id % 7 <> 0 AND c_invoice_id % 11 <> 0 AND c_invoice_id % 13 = 0, -1, 30)"
    batch = held.where("c_invoice_id % 7 = 0 OR c_invoice_id % 11 = 0 OR c_invoice_id % 13 = 0").withColumns({
        "updated": F.expr(f"created + make_dt_interval({later})"),
        "docstatus": F.expr("IF(c_invoice_id % 7 <> 0 AND c_invoice_id % 11 = 0, 'VO', docstatus)"),
        "grandtotal": F.expr("CAST(grandtotal + 1 AS DECIMAL(18,2))"),
    })
    fresh = held.where("c_invoice_id % 17 = 0").withColumn("c_invoice_id", F.col("c_invoice_id") + ADDED)
    for rows in (held, batch.unionByName(fresh)):
        work = lake.begin()
        incremental.upsert(rows, "c_invoice", work, "invoices", schema, "updated")
        work.commit()
    return comparable(lake.read("invoices", schema).select("ad_client_id", "c_invoice_id", "grandtotal", "updated"))


def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that repeats a month of known rows adds only the unknown ones."""
    invoices = cleaned(spark, sf_dir)["c_invoice"]
    held = invoices.where(f"created < '{LOADED_UNTIL}'")
    batch = invoices.where(f"created >= TIMESTAMP_NTZ '{LOADED_UNTIL} 00:00:00' - INTERVAL 30 DAYS")
    added = incremental.new_rows(batch, held, ["c_invoice_id"])
    both = held.withColumn("load", F.lit("held")).unionByName(added.withColumn("load", F.lit("added")))
    return comparable(both.select("ad_client_id", "c_invoice_id", "load", "grandtotal"))


def stream_clean_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three streamed loads of every entity leave in its table, per tenant.

    The last load repeats all rows of the one before it. Every document also arrives first as a draft, in the first load,
    and terms, whose identifiers repeat between tenants, arrive as they are.
    """
    sources = _sources(spark, sf_dir)
    root = scratch_path(spark, "stream")
    early, late = f"created < '{LOADED_UNTIL}'", f"created >= '{LOADED_UNTIL}'"
    found = None
    for entity in clean.KEPT:
        rows, place = sources[entity], f"{root}/{entity}"
        loads = [rows.where(early), rows.where(late), rows.where(late)]
        if "docstatus" in rows.columns:
            loads[0] = loads[0].unionByName(rows.where(late).withColumn("docstatus", F.lit("DR")))
        for load in loads:
            load.write.mode("append").parquet(f"{place}/arrivals")
            clean_arrivals(spark, entity, f"{place}/arrivals", f"{place}/cleaned", f"{place}/progress").awaitTermination()
        held = arrived(spark, entity, f"{place}/cleaned")
        ids = [c for c in KEY[entity] if c != "ad_client_id"]
        counts = held.groupBy("ad_client_id").agg(
            F.lit(entity).alias("entity"), F.count("*").alias("n_rows"), F.sum(ids[0]).cast("long").alias("id_sum"),
            F.max("created").alias("last_created"),
        )
        found = counts if found is None else found.unionByName(counts)
    return comparable(found)


def model_registry_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of one model per type, tenant and invoiced month."""
    months = facts(spark, sf_dir).selectExpr(
        "ad_client_id", "CAST(date_trunc('MONTH', dateinvoiced) AS TIMESTAMP_NTZ) AS run_ts"
    ).distinct()
    runs = months.selectExpr(
        "explode(array('classification', 'regression')) AS model_type", "*"
    ).withColumn(
        "path",
        F.expr(
            "concat('models/', model_type, '_models/', ad_client_id, '/', date_format(run_ts, \"yyyyMMdd'T'HHmmss\"))"
        ),
    )
    return comparable(registry.with_file_name(registry.latest_models(runs)))


QUERIES = {
    "roundtrip_append": roundtrip_append,
    "roundtrip_overwrite_tenant": roundtrip_overwrite_tenant,
    "tenant_list_facts": tenant_list_facts,
    "csv_roundtrip": csv_roundtrip,
    "apply_defaults": apply_defaults,
    "constraint_report": constraint_report,
    "cleaning_stats": cleaning_stats,
    "high_water_mark": high_water_mark,
    "incremental_invoices": incremental_invoices,
    "incremental_merge": incremental_merge,
    "nightly_runs": nightly_runs,
    "nightly_broken_run": nightly_broken_run,
    "nightly_quarantine": nightly_quarantine,
    "incremental_upsert": incremental_upsert,
    "stream_clean_equals_batch": stream_clean_equals_batch,
    "model_registry_latest": model_registry_latest,
}

# ---- oracles ---------------------------------------------------------------

_SQL_TABLE = {"c_invoice": "inv", "c_payment": "pay", "c_allocationline": "alloc", "c_paymentterm": "term"}


def _sql_not_null(table: str, label: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, 'not_null' AS rule, '{c}' AS column_name, "
        f"count(*) FILTER ({c} IS NULL) AS violations FROM {table}"
        for c in columns
    )


def _sql_unique(table: str, label: str, key: list[str]) -> str:
    return (
        f"SELECT '{label}', 'unique_key', '{', '.join(key)}', count(*) FROM "
        f"(SELECT 1 FROM {table} GROUP BY {', '.join(key)} HAVING count(*) > 1)"
    )


def _constraint_sql() -> str:
    parts = [
        _sql_not_null(name, f"source {name}", SOURCES[name].fieldNames()) for name in SOURCES if name != "ad_client"
    ]
    parts.append(_sql_not_null("(SELECT DISTINCT ad_client_id FROM c_paymentterm)", "source ad_client", ["ad_client_id"]))
    for name, table in _SQL_TABLE.items():
        key = [PRIMARY_KEY[name]] if name != "c_paymentterm" else ["ad_client_id", PRIMARY_KEY[name]]
        parts += [_sql_not_null(table, name, CLEAN_REQUIRED[name]), _sql_unique(table, name, key)]
    parts += [
        _sql_not_null("lined", "facts", FACT_REQUIRED),
        _sql_unique("lined", "facts", ["ad_client_id", "c_invoice_id"]),
    ]
    parts += [
        f"SELECT 'facts', 'zero_or_one', '{c}', count(*) FILTER ({c} NOT IN (0, 1)) FROM lined" for c in FACT_FLAGS
    ]
    return statement(" UNION ALL ".join(parts))


def _stats_sql() -> str:
    ctes, joins, columns, percents = [], [], [], {}
    for entity, suffix in stats.SUFFIX.items():
        ctes.append(
            f"n_{suffix} AS (SELECT ad_client_id, count(*) AS seen, count(*) FILTER ({_KEPT[entity]}) AS kept "
            f"FROM {entity} WHERE {_READ[entity]} GROUP BY 1)"
        )
        joins.append(f"LEFT JOIN n_{suffix} USING (ad_client_id)")
        columns += [
            f"coalesce(n_{suffix}.seen, 0) AS no_entries_{suffix}",
            f"coalesce(n_{suffix}.kept, 0) AS no_clean_entries_{suffix}",
        ]
        percents[suffix] = f"CASE WHEN n_{suffix}.kept > 0 THEN n_{suffix}.kept * 100.0::DOUBLE / n_{suffix}.seen ELSE 0 END"
    average = "(" + " + ".join(percents.values()) + ") / 4"
    shown = [f"round({p}, 6) AS {s}_remaining_percent" for s, p in percents.items()]
    body = (
        "SELECT ad_client_id, TIMESTAMP '2001-02-01 00:00:00' AS date_run, CAST(0 AS DOUBLE) AS runtime_in_seconds, "
        f"{', '.join(columns)}, {', '.join(shown)}, round({average}, 6) AS avg_remaining_percent, "
        "coalesce(f.n, 0) AS no_total_aggregated_rows "
        "FROM (SELECT DISTINCT ad_client_id FROM c_paymentterm WHERE ad_client_id <> 0) "
        f"{' '.join(joins)} LEFT JOIN (SELECT ad_client_id, count(*) AS n FROM facts GROUP BY 1) f USING (ad_client_id)"
    )
    return statement(body, *ctes)


_MARKS = "marks AS (" + " UNION ALL ".join(
    f"SELECT ad_client_id, '{entity}' AS entity, "
    "CAST(max(date_trunc('month', created) + INTERVAL 1 MONTH) AS TIMESTAMP) AS high_water_mark "
    f"FROM {table} WHERE created < TIMESTAMP '{LOADED_UNTIL} 00:00:00' GROUP BY 1"
    for entity, table in _SQL_TABLE.items()
) + ")"

_PAYMENTS = sql_columns(
    "c_payment_id:i ad_client_id:i ad_org_id:i datetrx:t c_doctype_id:i c_bpartner_id:i c_invoice_id:i "
    "tendertype:x c_currency_id:i payamt:m isallocated:x duedate:t allocatedamt:m created:t"
)

# Which rows a run reads and keeps, written out apart from the engine.
_READ = {
    "c_invoice": "ad_client_id <> 0 AND issotrx = 'Y'",
    "c_payment": "ad_client_id <> 0",
    "c_allocationline": "ad_client_id <> 0",
    "c_paymentterm": "ad_client_id <> 0",
}
_KEPT = {
    "c_invoice": "docstatus = 'CO' AND isreturntrx = 'N'",
    "c_payment": "isreceipt = 'Y' AND docstatus = 'CO'",
    "c_allocationline": "amount > 0",
    "c_paymentterm": "TRUE",
}


def _runs_sql() -> str:
    first, second, third = (f"TIMESTAMP '{run}'" for run in RUNS)
    ctes, joins, columns = [], [], []
    suffixes = {"c_invoice": "invoices", "c_allocationline": "alloc", "c_payment": "payments", "c_paymentterm": "terms"}
    for entity, s in suffixes.items():
        # Of each tenant: rows before the cut, after the first and after the second run.
        spans = {"a": f"created < '{LOADED_UNTIL}'", "b": f"created > {first}", "c": f"created > {second}", "n": "TRUE"}
        counts = ", ".join(
            f"count(*) FILTER ({span}) AS r{k}, count(*) FILTER (({span}) AND ({_KEPT[entity]})) AS k{k}" for k, span in spans.items()
        )
        ctes.append(f"n_{s} AS (SELECT ad_client_id, {counts} FROM {entity} WHERE {_READ[entity]} GROUP BY 1)")
        # A run starts after the last one that kept rows.
        ctes.append(
            f"two_{s} AS (SELECT *, CASE WHEN ka > 0 THEN rb ELSE rn END AS r2, "
            f"CASE WHEN ka > 0 THEN kb ELSE kn END AS k2 FROM n_{s})"
        )
        ctes.append(
            f"t_{s} AS (SELECT ad_client_id, ka + k2 AS held, unnest([{first}, {second}, {third}]) AS date_run, "
            "unnest([ra, r2, CASE WHEN k2 > 0 THEN rc WHEN ka > 0 THEN rb ELSE rn END]) AS seen, "
            "unnest([ka, k2, CASE WHEN k2 > 0 THEN kc WHEN ka > 0 THEN kb ELSE kn END]) AS kept, "
            f"CASE WHEN k2 > 0 THEN {second} WHEN ka > 0 THEN {first} END AS mark FROM two_{s})"
        )
        joins.append(f"LEFT JOIN t_{s} USING (ad_client_id, date_run)")
        columns += [
            f"coalesce(t_{s}.seen, 0) AS no_entries_{s}",
            f"coalesce(t_{s}.kept, 0) AS no_clean_entries_{s}",
            f"t_{s}.mark AS mark_{s}",
            f"t_{s}.held AS held_{s}",
        ]
    tenants = (
        "(SELECT DISTINCT ad_client_id FROM c_paymentterm WHERE ad_client_id <> 0) "
        f"CROSS JOIN (SELECT unnest([{first}, {second}, {third}]) AS date_run)"
    )
    return statement(f"SELECT ad_client_id, date_run, {', '.join(columns)} FROM {tenants} {' '.join(joins)}", *ctes)


ORACLE = {
    "nightly_runs": _runs_sql(),
    "nightly_broken_run": statement(
        "SELECT i.ad_client_id, 'broken' AS state, i.invoices, f.fact_rows, CAST(1 AS BIGINT) AS runs FROM held i JOIN made f USING (ad_client_id) "
        "UNION ALL SELECT i.ad_client_id, 'repeated', 2 * i.invoices, f.fact_rows + coalesce(o.n, 0), CAST(2 AS BIGINT) "
        "FROM held i JOIN made f USING (ad_client_id) LEFT JOIN opened o USING (ad_client_id)",
        "held AS (SELECT ad_client_id, count(*) AS invoices FROM inv GROUP BY 1)",
        "made AS (SELECT ad_client_id, count(*) AS fact_rows FROM facts GROUP BY 1)",
        # Of the copies, which no payment or allocation names, only open invoices become lines.
        "opened AS (SELECT ad_client_id, count(*) AS n FROM inv WHERE paidamt = 0 AND dateinvoiced <= duedate "
        "AND grandtotal > 0 AND c_currency_id = 346 GROUP BY 1)",
    ),
    "nightly_quarantine": statement(
        "SELECT t.ad_client_id, s.step, CASE WHEN b.rejected IS NULL THEN 1 ELSE 0 END::BIGINT AS ok, "
        "CASE WHEN b.rejected IS NOT NULL THEN 0 WHEN s.step = 'cleaning' THEN least(i.n, p.n, a.n, m.n) ELSE f.n END AS result_rows, "
        "b.rejected, b.rule, b.column_name, CASE WHEN b.rejected IS NULL THEN f.n END AS fact_rows "
        "FROM (SELECT DISTINCT ad_client_id FROM c_paymentterm WHERE ad_client_id <> 0) t CROSS JOIN (VALUES ('cleaning'), ('aggregation')) s(step) "
        "LEFT JOIN bad b USING (ad_client_id) JOIN n_inv i USING (ad_client_id) JOIN n_pay p USING (ad_client_id) "
        "JOIN n_alloc a USING (ad_client_id) JOIN n_term m USING (ad_client_id) JOIN n_facts f USING (ad_client_id)",
        "bad AS (SELECT ad_client_id, count(*) AS rejected, 'type' AS rule, 'payamt' AS column_name FROM c_payment "
        "WHERE ad_client_id = 2 AND c_payment_id % 100 = 7 GROUP BY 1 UNION ALL "
        "SELECT ad_client_id, count(*), 'not_null', 'c_invoice_id' FROM inv WHERE ad_client_id = 3 AND c_invoice_id % 100 = 9 GROUP BY 1)",
        *[f"n_{t} AS (SELECT ad_client_id, count(*) AS n FROM {t} GROUP BY 1)" for t in ("inv", "pay", "alloc", "term", "facts")],
    ),
    "incremental_upsert": statement(
        "SELECT ad_client_id, c_invoice_id, round(CAST(CASE WHEN c_invoice_id % 7 = 0 THEN grandtotal + 1 ELSE grandtotal END AS DOUBLE), 2) AS grandtotal, "
        "CAST(CASE WHEN c_invoice_id % 7 = 0 THEN created + INTERVAL 30 DAY ELSE created END AS TIMESTAMP) AS updated "
        "FROM inv WHERE c_invoice_id % 7 = 0 OR c_invoice_id % 11 <> 0 "
        f"UNION ALL SELECT ad_client_id, c_invoice_id + {ADDED}, round(CAST(grandtotal AS DOUBLE), 2), CAST(created AS TIMESTAMP) FROM inv WHERE c_invoice_id % 17 = 0"
    ),
    "roundtrip_append": statement(f"SELECT {_PAYMENTS} FROM pay"),
    "roundtrip_overwrite_tenant": statement(
        "SELECT "
        + sql_columns("ad_client_id:i c_invoice_id:x c_bpartner_id:i grandtotal:m allocatedamt:m paid:i late:i")
        + f" FROM facts WHERE ad_client_id <> {REPLACED_TENANT} OR paid = 1"
    ),
    "tenant_list_facts": statement("SELECT DISTINCT ad_client_id FROM facts"),
    "csv_roundtrip": statement(
        "SELECT DISTINCT "
        + sql_columns(
            "ad_client_id:i c_invoice_id:x dateinvoiced:t c_bpartner_id:i tendertype:x allocatedamt:m dayslate:i "
            "late:i paid:i daystosettle:i"
        )
        + " FROM facts"
    ),
    "apply_defaults": statement(
        "SELECT ad_client_id, c_invoice_id, coalesce(nullif(paymentrule, '5'), 'P') AS paymentrule, "
        "round(CAST(grandtotal AS DOUBLE), 2) AS grandtotal, round(CAST(totalopenamt AS DOUBLE), 2) AS totalopenamt, "
        "round(CAST(CASE WHEN c_cashline_id = 0 THEN paidamt ELSE 0 END AS DOUBLE), 2) AS paidamt FROM inv"
    ),
    "constraint_report": _constraint_sql(),
    "cleaning_stats": _stats_sql(),
    "high_water_mark": statement("SELECT * FROM marks", _MARKS),
    "incremental_invoices": statement(
        "SELECT i.ad_client_id, c_invoice_id, created, round(CAST(grandtotal AS DOUBLE), 2) AS grandtotal "
        "FROM inv i LEFT JOIN marks m ON m.ad_client_id = i.ad_client_id AND m.entity = 'c_invoice' "
        "WHERE m.high_water_mark IS NULL OR i.created > m.high_water_mark",
        _MARKS,
    ),
    "incremental_merge": statement(
        "SELECT ad_client_id, c_invoice_id, CASE WHEN created < TIMESTAMP '2001-01-01 00:00:00' THEN 'held' "
        "ELSE 'added' END AS load, round(CAST(grandtotal AS DOUBLE), 2) AS grandtotal FROM inv"
    ),
    "stream_clean_equals_batch": statement(
        " UNION ALL ".join(
            f"SELECT ad_client_id, '{e}' AS entity, count(*) AS n_rows, sum({PRIMARY_KEY[e]})::BIGINT AS id_sum, "
            f"CAST(max(created) AS TIMESTAMP) AS last_created FROM {e} WHERE {_READ[e]} AND {_KEPT[e]} GROUP BY 1"
            for e in _SQL_TABLE
        )
    ),
    "model_registry_latest": statement(
        "SELECT model_type, ad_client_id, run_ts, 'models/' || model_type || '_models/' || ad_client_id || '/' "
        "|| strftime(run_ts, '%Y%m%dT%H%M%S') AS path, strftime(run_ts, '%Y%m%dT%H%M%S') AS file_name "
        "FROM (SELECT ad_client_id, CAST(max(date_trunc('month', dateinvoiced)) AS TIMESTAMP) AS run_ts FROM facts "
        "GROUP BY 1) CROSS JOIN (VALUES ('classification'), ('regression')) AS t(model_type)"
    ),
}
