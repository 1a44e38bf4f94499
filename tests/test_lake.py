"""Sinks, incremental loads, streaming, registry, quality and scoring."""

from datetime import datetime
from decimal import Decimal

import making
import pytest
from pyspark.sql import functions as F, types as T

from duecast.operators import clean, incremental, quality, quarantine, score
from duecast.params import Params
from duecast.plans import nightly
from duecast.schemas import CLEANING_STATS, REQUEST
from duecast.sources import derived, registry, tables
from duecast.sources.lake import BUCKETS, Lake
from duecast.streaming.incremental_stream import arrived, clean_arrivals


def test_two_nightly_runs_load_each_row_once(spark, small, tmp_path):
    sources = derived.ledger_sources(spark, small)
    root = str(tmp_path / "lake")
    lake = Lake(spark, root)
    held = lambda entity: nightly.cleaned_table(lake, spark, entity).count()
    cut = "created < '2001-01-01'"
    early = {k: v.where(cut) if "created" in v.columns else v for k, v in sources.items()}
    nightly.run(early, root, derived.PARAMS, datetime(2001, 1, 1))
    before = held("c_invoice")
    stats = nightly.run(sources, root, derived.PARAMS, datetime(2001, 9, 1))
    assert stats.select("date_run").distinct().count() == 2
    loaded = held("c_invoice")
    assert before < loaded == clean.clean("c_invoice", sources["c_invoice"]).count()
    # A third run finds nothing and changes nothing.
    nightly.run(sources, root, derived.PARAMS, datetime(2001, 9, 2))
    assert held("c_invoice") == loaded
    assert lake.read("facts", T.StructType.fromDDL("ad_client_id long, c_invoice_id string")).count() == 1465
    assert held("c_paymentterm") == 15


VALUES = T.StructType().add("id", "long").add("v", "string")


def _put(spark, lake, rows, instead=False):
    work = lake.begin()
    work.put("t", spark.createDataFrame(rows, VALUES), ["id"], instead)
    return work


def test_a_run_is_seen_once_it_is_committed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.read("t", VALUES).count() == 0
    first = _put(spark, lake, [(1, "a"), (2, "b")])
    assert lake.read("t", VALUES).count() == 0
    late = _put(spark, lake, [(3, "c")])
    first.commit()
    assert lake.read("t", VALUES).count() == 2
    with pytest.raises(RuntimeError):
        late.commit()
    # A manifest that was not finished is passed over, and its number is not used again.
    (tmp_path / "lake" / "manifests" / "number=000000000002").mkdir()
    assert lake.numbers() == [1]
    _put(spark, lake, [(3, "c")]).commit()
    assert lake.numbers() == [1, 3] and lake.read("t", VALUES).count() == 3
    _put(spark, lake, []).commit()
    assert lake.read("t", VALUES).count() == 3


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    schema = T.StructType.fromDDL("ad_client_id long, c_paymentterm_id long, netdays long, created timestamp_ntz")
    rows = lambda ids, days, day: spark.createDataFrame([(1, i, days, datetime(2020, 1, day)) for i in ids], schema)

    def load(df):
        work = lake.begin()
        incremental.upsert(df, "c_paymentterm", work, "t", schema, "created")
        work.commit()
        return {(b, p) for _, b, p in lake.entries()}

    first = load(rows(range(1, 1000), 10, 5))
    second = load(rows([7, 7], 20, 6).unionByName(rows([7], 30, 4)))
    assert len(first) == BUCKETS and len(first - second) == len(second - first) == 1
    assert load(rows([7], 40, 3)) != second  # rewritten, but the held row is later
    got = {r["c_paymentterm_id"]: r["netdays"] for r in lake.read("t", schema).collect()}
    assert len(got) == 999 and got[7] == 20 and got[8] == 10
    assert load(rows([], 0, 1)) and lake.read("t", schema).count() == 999


def test_a_nightly_run_follows_changes(spark, tmp_path):
    """Marked by change, a second run replaces changed invoices and drops voided ones."""
    params = Params(change_column="updated", as_of=datetime(2021, 1, 31))
    sources = {k: v if k == "ad_client" else v.withColumn("updated", F.col("created")) for k, v in making.hand_sources(spark).items()}
    root = str(tmp_path / "lake")
    nightly.run(sources, root, params, datetime(2020, 6, 1))
    lake = Lake(spark, root)
    held = lambda: {r["c_invoice_id"]: r["grandtotal"] for r in nightly.cleaned_table(lake, spark, "c_invoice").collect()}
    before = held()
    first, second = sorted(before)[:2]
    later = sources["c_invoice"].where(F.col("c_invoice_id").isin(first, second)).withColumns({
        "updated": F.lit(datetime(2020, 7, 1)).cast("timestamp_ntz"),
        "docstatus": F.expr(f"IF(c_invoice_id = {second}, 'VO', docstatus)"),
        "grandtotal": F.expr("CAST(grandtotal + 5 AS DECIMAL(18,2))"),
    })
    nightly.run({**sources, "c_invoice": sources["c_invoice"].unionByName(later)}, root, params, datetime(2020, 8, 1))
    after = held()
    assert after == {k: v + 5 if k == first else v for k, v in before.items() if k != second}


def test_rejects_name_rule_and_value(spark):
    sources = making.hand_sources(spark)
    wide = sources["c_payment"].withColumn("payamt", F.expr("CASE c_payment_id % 3 WHEN 0 THEN 'much' WHEN 1 THEN '1e15' ELSE '5' END"))
    rows = quarantine.conformed("c_payment", wide.withColumn("tendertype", F.lit(None).cast("string")))
    found = quarantine.rejects("c_payment", rows).collect()
    ids = {r["c_payment_id"]: r["isreceipt"] == "Y" and r["docstatus"] == "CO" for r in sources["c_payment"].collect()}
    want = {(str(i), "type", "payamt", "much") for i in ids if i % 3 == 0} | {(str(i), "amount", "payamt", "1e15") for i in ids if i % 3 == 1}
    want |= {(str(i), "not_null", "tendertype", None) for i, kept in ids.items() if kept}
    want |= {(str(i), "not_null", "payamt", None) for i, kept in ids.items() if kept and i % 3 == 0}
    assert {(r["row_key"], r["rule"], r["column_name"], r["value"]) for r in found} == want
    assert quarantine.rejects("c_payment", quarantine.conformed("c_payment", sources["c_payment"])).count() == 0


def test_marks_ignore_runs_that_kept_nothing(spark):
    empty = {f.name: None for f in CLEANING_STATS}
    rows = [
        {**empty, "ad_client_id": 1, "date_run": datetime(2020, 1, 1), "no_clean_entries_invoices": 5},
        {**empty, "ad_client_id": 1, "date_run": datetime(2020, 2, 1), "no_clean_entries_invoices": 0},
    ]
    marks = incremental.high_water_marks(spark.createDataFrame(rows, CLEANING_STATS)).collect()
    assert [(r["entity"], r["high_water_mark"]) for r in marks] == [("c_invoice", datetime(2020, 1, 1))]


def test_replacing_one_tenant_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "ad_client_id long, v long")
    tables.replace_tenants(rows, path)
    tables.replace_tenants(spark.createDataFrame([(1, 99)], "ad_client_id long, v long"), path)
    got = tables.read_lake(spark, path, rows.schema).collect()
    assert sorted((r["ad_client_id"], r["v"]) for r in got) == [(1, 99), (2, 20)]


def test_csv_nulls_survive(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.createDataFrame([(1, None, "x"), (2, 3, None)], "a long, b long, c string")
    tables.write_csv(rows, path)
    assert sorted(map(tuple, tables.read_csv(spark, rows.schema, path).collect())) == [(1, None, "x"), (2, 3, None)]
    kept = tables.read_csv(spark, rows.schema.fromJson(rows.schema.jsonValue()), path, null_text=None)
    assert {r["c"] for r in kept.collect()} == {"x", "\\N"}


def test_constraint_report_finds_what_is_wrong(spark):
    rows = spark.createDataFrame([(1, None, 0), (1, 2, 3), (2, 2, None)], "id long, v long, flag int")
    found = quality.report(
        [quality.not_null(rows, "t", ["id", "v"]), quality.unique_key(rows, "t", ["id"]), quality.zero_or_one(rows, "t", ["flag"])]
    ).collect()
    assert {(r["rule"], r["column_name"]): r["violations"] for r in found} == {
        ("not_null", "id"): 0, ("not_null", "v"): 1, ("unique_key", "id"): 1, ("zero_or_one", "flag"): 1,
    }


def test_stream_restarts_without_repeats(spark, tmp_path):
    sources = making.hand_sources(spark)
    arrivals, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def load(rows):
        rows.write.mode("append").parquet(arrivals)
        clean_arrivals(spark, "c_payment", arrivals, target, progress).awaitTermination()

    load(sources["c_payment"].where("c_payment_id < 900"))
    load(sources["c_payment"])
    assert arrived(spark, "c_payment", target).count() == sources["c_payment"].count()


def test_newest_model_of_the_exact_tenant(spark):
    data = [
        ("regression", 100, datetime(2020, 1, 2), "a"), ("regression", 100, datetime(2020, 3, 1), "b"),
        ("regression", 1000, datetime(2021, 1, 1), "c"), ("classification", 100, datetime(2022, 1, 1), "d"),
    ]
    got = registry.latest_models(spark.createDataFrame(data, registry.REGISTRY)).collect()
    assert {(r["model_type"], r["ad_client_id"]): r["path"] for r in got} == {
        ("regression", 100): "b", ("regression", 1000): "c", ("classification", 100): "d",
    }


def _request(spark, **values):
    base = dict(row_id=1, ad_client_id=1, c_invoice_id=5, ad_org_id=1, dateinvoiced=datetime(2020, 1, 10),
                c_bpartner_id=1, c_bpartner_location_id=1, paymentrule="P", grandtotal=Decimal(10),
                duedate=datetime(2020, 1, 1), totalopenamt=Decimal(4), tendertype=None)
    rows = [tuple({**base, **v}[n] for n in REQUEST.fieldNames()) for v in values["rows"]]
    return spark.createDataFrame(rows, REQUEST)


def test_join_check_sees_missing_and_ambiguous_rows(spark):
    requests = _request(spark, rows=[{"row_id": 1}, {"row_id": 2, "c_bpartner_id": 2}, {"row_id": 3, "c_bpartner_id": 3}])
    snapshot = spark.createDataFrame([(1, 1, 1, 1), (1, 1, 2, 1), (1, 1, 2, 1)],
                                     "ad_client_id long, ad_org_id long, c_bpartner_id long, c_bpartner_location_id long")
    found = {r["row_id"]: r["violation"] for r in score.join_violations(requests, snapshot).collect()}
    assert found == {2: "ambiguous", 3: "missing"}


def test_days_are_rounded_half_to_even_and_dropped_when_unpaid(spark):
    requests = _request(spark, rows=[{"row_id": i} for i in range(4)])
    guesses = spark.createDataFrame([(0, 1, 2.5), (1, 1, 3.5), (2, 0, 9.0)], "row_id long, prediction int, days double")
    for unpaid, shown in ((0, 0.0), (None, None)):
        answer = score.postprocess(requests, guesses, guesses, unpaid).orderBy("row_id").collect()
        assert [r["daystosettle_prediction"] for r in answer] == [2.0, 4.0, shown, None]
    assert score.predicted_unpaid(score.postprocess(requests, guesses, guesses)).count() == 1


def test_request_lateness_runs_from_due_to_invoice_date(spark):
    rows = _request(spark, rows=[{}]).withColumns(
        {"paidamt": F.lit(6).cast("decimal(18,2)"), "unpaid_invoices_late_sum": F.lit(1), "unpaid_invoices_sum": F.lit(0)}
    )
    got = score.request_features(rows).first()
    assert (got["dayslate"], got["late"], got["paid"]) == (9, 1, 0)
    assert got["late_unpaid_invoices_sum_percent"] is None


def test_requests_from_json_and_csv(spark, tmp_path):
    requests = _request(spark, rows=[{"row_id": 1, "tendertype": "A"}, {"row_id": 2}])
    tables.write_records(requests, str(tmp_path / "json"))
    requests.write.option("header", True).csv(str(tmp_path / "csv"))
    for kind in ("json", "csv"):
        got = tables.read_requests(spark, str(tmp_path / kind), kind)
        assert got.exceptAll(requests).count() == 0 and got.count() == 2


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    from duecast.sources import storage

    class Context:
        master = "spark://head:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(_key, default):
                return default

    with pytest.raises(ValueError):
        storage.shared_dir(Session())
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_defaults_fill_only_nulls(spark):
    rows = spark.createDataFrame([(None, None), ("A", Decimal("5.00"))], "tendertype string, payamt decimal(18,2)")
    assert [tuple(r) for r in tables.with_defaults(rows, "c_payment").collect()] == [("K", Decimal("0.00")), ("A", Decimal("5.00"))]


def test_tenants_without_a_mark_are_read_whole(spark):
    day = datetime(2020, 1, 1)
    rows = spark.createDataFrame([(1, 1, day), (1, 2, datetime(2020, 5, 1)), (2, 3, day), (3, 4, day)],
                                 "ad_client_id long, id long, created timestamp_ntz")
    marks = spark.createDataFrame([(1, "c_invoice", datetime(2020, 3, 1)), (3, "c_invoice", datetime(2019, 1, 1))],
                                  "ad_client_id long, entity string, high_water_mark timestamp_ntz")
    tenants = rows.select("ad_client_id").distinct()
    for known in (None, tenants):
        got = incremental.rows_after(rows, marks, "c_invoice", Params(), known)
        assert sorted(r["id"] for r in got.collect()) == [2, 3, 4]


def test_marks_take_any_change_column(spark):
    rows = spark.createDataFrame([(1, 1, datetime(2020, 1, 1), datetime(2020, 6, 1))],
                                 "ad_client_id long, id long, created timestamp_ntz, updated timestamp_ntz")
    marks = spark.createDataFrame([(1, "c_invoice", datetime(2020, 3, 1))],
                                  "ad_client_id long, entity string, high_water_mark timestamp_ntz")
    assert incremental.rows_after(rows, marks, "c_invoice", Params()).count() == 0
    assert incremental.rows_after(rows, marks, "c_invoice", Params(change_column="updated")).count() == 1


def test_requests_are_answered_whole_or_refused(spark):
    from duecast.plans import scoring

    requests = _request(spark, rows=[{"row_id": 1}, {"row_id": 2, "ad_client_id": 2}, {"row_id": 3, "ad_client_id": 2, "c_bpartner_id": 9},
                                     {"row_id": 4, "ad_client_id": 3}])
    snapshot = spark.createDataFrame([(t, 1, 1, 1) for t in (1, 2, 3)],
                                     "ad_client_id long, ad_org_id long, c_bpartner_id long, c_bpartner_location_id long")
    known = spark.createDataFrame([("classification", t, datetime(2020, 1, 1), "p") for t in (1, 2)], registry.REGISTRY)
    got = {r["ad_client_id"]: r["reason"] for r in scoring.refusals(requests, snapshot, known).collect()}
    assert got == {2: "1 rows do not meet exactly one feature row", 3: "no classifier has been trained"}


def test_only_keys_that_come_again_are_compared(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (2, 5, "c"), (None, 4, "d"), (None, 3, "e")], "id long, created long, v string")
    seen, last_of = [], incremental.last_of
    monkeypatch.setattr(incremental, "last_of", lambda df, *a: seen.append(df.count()) or last_of(df, *a))
    assert {tuple(r) for r in incremental.newest(rows, ["id"], "created").collect()} == {(1, 6, "b"), (2, 5, "c"), (None, 4, "d")}
    assert incremental.newest(rows.where("id = 2"), ["id"], "created").count() == 1
    assert seen == [4]


def test_a_first_load_is_not_looked_up_in_an_empty_table(spark, tmp_path, monkeypatch):
    asked, new_rows = [], incremental.new_rows
    monkeypatch.setattr(incremental, "new_rows", lambda batch, held, *a: asked.append(held) or new_rows(batch, held, *a))
    sources = derived.ledger_sources(spark, "/root/testdata/sf0.001")
    nightly.run(sources, str(tmp_path / "lake"), derived.PARAMS, datetime(2001, 2, 1))
    assert asked == [None] * 4
