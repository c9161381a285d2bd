import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, recon, suites
from tidemark.sinks.history_table import HistoryTable
from tidemark.testbed.catalog import QUERIES

AT = dt.datetime(2024, 6, 1, 12)


def test_good_row_passes(spark):
    df = spark.createDataFrame(
        [("t1", "a", "c", "DEBIT", Decimal("12.50"), "USD", "POSTED", AT, AT, "DINING", "US", 20)],
        "transaction_id string, account_id string, customer_id string, transaction_type string, transaction_amount decimal(18,2), "
        "currency_code string, transaction_status string, event_timestamp timestamp, processing_timestamp timestamp, "
        "merchant_category string, country_code string, risk_score int")
    results = suites.evaluate_suite(df, "transactions_bronze")
    assert results.count() == 8 and results.filter("not success").count() == 0
    summary = suites.summarize(results, "transactions_bronze", "transactions", "bronze", AT)
    row = suites.enforce(summary, "raise")[0]
    assert row.success and row.success_percent == 100 and row.run_identifier == "transactions_bronze-20240601T120000Z"
    assert suites.failure_metric(summary).head().value == 0


def test_each_rule(spark):
    df = spark.createDataFrame([("a", 1, "x@y.z"), ("a", 200, "bad"), (None, None, None), ("b", 5, "p@q.r")], "id string, n int, mail string")
    rules = [
        {"kind": suites.COLUMNS, "columns": ["id", "n"]},
        {"kind": suites.NOT_NULL, "column": "id", "mostly": 0.75},
        {"kind": suites.UNIQUE, "column": "id", "mostly": 0.34},
        {"kind": suites.IN_SET, "column": "id", "values": ["a"]},
        {"kind": suites.BETWEEN, "column": "n", "min": 0, "max": suites.parameter("top")},
        {"kind": suites.REGEX, "column": "mail", "pattern": "^[^@]+@"},
        {"kind": suites.NOT_NULL, "column": "absent"},
    ]
    got = {r.position: (r.tested, r.unexpected, r.success) for r in suites.evaluate_suite(df, rules, {"top": 100}).collect()}
    assert got == {0: (2, 1, False), 1: (4, 1, True), 2: (3, 2, False), 3: (3, 1, False), 4: (3, 1, False), 5: (3, 1, False), 6: (0, 1, False)}
    rules[2]["mostly"] = 0.33
    assert suites.evaluate_suite(df, rules[2:3]).head().success
    with pytest.raises(KeyError):
        suites.evaluate_suite(df, rules)


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "id string")
    results = suites.evaluate_suite(df, [{"kind": suites.UNIQUE, "column": "id"}, {"kind": suites.NOT_NULL, "column": "id"}])
    assert results.filter("not success").count() == 0


def test_failed_suite_raises(spark):
    df = spark.createDataFrame([("a",), ("a",)], "customer_id string")
    summary = suites.summarize(suites.evaluate_suite(df, "customers_bronze"), "customers_bronze", "customers", "bronze")
    assert suites.enforce(summary)[0].success is False
    with pytest.raises(suites.ValidationFailed):
        suites.enforce(summary, "raise")


def test_upsert(spark, rows):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], "k string, at int, v string")
    landing = spark.createDataFrame([("a", 2, "mid"), ("a", 3, "new"), ("c", 1, "in"), (None, 1, "n")], "k string, at int, v string")
    assert rows(history.upsert(target, landing, "k", ["at"])) == [("a", 3, "new"), ("b", 1, "keep"), ("c", 1, "in"), (None, 1, "n")]


def test_snapshot(spark, rows):
    def day(n):
        return F.lit(f"2024-01-0{n}").cast("timestamp")

    def load(*r):
        return spark.createDataFrame(list(r), "id string, name string, score int")

    h = history.start_history(load(("a", "A", 1), ("b", None, 2), ("c", "C", 3)), "id", day(1))
    h = history.apply_snapshot(h, load(("a", "A", 9), ("b", None, 2), ("d", "D", 4)), "id", ["name", "score"], day(2))
    h = history.apply_snapshot(h, load(("a", "A", 9), ("b", "B", 2), ("d", "D", 4)), "id", ["name", "score"], day(3))
    got = rows(h.select("id", "name", "score", F.dayofmonth("valid_from"), F.dayofmonth("valid_to")))
    assert got == [("a", "A", 1, 1, 2), ("a", "A", 9, 2, None), ("b", "B", 2, 3, None), ("b", None, 2, 1, 3),
                   ("c", "C", 3, 1, None), ("d", "D", 4, 2, None)]
    assert h.select("scd_id").distinct().count() == 6


def test_snapshot_without_changes_is_stable(spark, rows):
    day = F.lit("2024-01-01").cast("timestamp")
    data = spark.createDataFrame([("a", None, 1)], "id string, name string, score int")
    h = history.start_history(data, "id", day)
    again = history.apply_snapshot(h, data, "id", ["name", "score"], F.lit("2024-02-01").cast("timestamp"))
    assert rows(again) == rows(h)


def test_reconciliation_result(spark):
    schema = "id string, amount decimal(18,2)"
    source = spark.createDataFrame([("a", Decimal(5)), ("b", Decimal(7)), ("c", None)], schema)
    target, rejected = source.filter("id = 'a'"), source.filter("id <> 'a'")
    ok = recon.reconciliation_result("x", source, target, rejected, "id", "amount").head()
    assert (ok.status, ok.row_count_difference, ok.amount_difference, ok.details) == ("OK", 2, Decimal(7), "2 rejected, 0 duplicated")
    bad = recon.reconciliation_result("x", source, target.union(target), rejected, "id", "amount").head()
    assert (bad.status, bad.duplicate_identifier_count) == ("MISMATCH", 1)


def test_empty_reconciliation(spark):
    none = spark.createDataFrame([], "id string, transaction_amount decimal(18,2)")
    r = recon.row_count_reconciliation("x", none, none).head()
    assert (r.raw_row_count, r.row_count_difference) == (0, 0)
    assert recon.amount_reconciliation("x", none, none).head().amount_difference == 0


def test_freshness(spark):
    df = spark.createDataFrame([(AT,)], "ingestion_timestamp timestamp")
    now = F.lit("2024-06-01 13:00:00").cast("timestamp")
    r = recon.freshness({"t": df}, now, "30 minutes").head()
    assert (r.age_seconds, r.is_fresh) == (3600, False)
    empty = recon.freshness({"t": df.limit(0)}, now, "2 hours")
    assert recon.freshness_metric(empty).head().value == 1


def test_lines_of_existing_suppliers_are_no_orphans(spark, tmp_path):
    spark.createDataFrame([(1,), (1,), (2,), (9,)], "l_suppkey long").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, -50.0), (2, 4000.0)], "s_suppkey long, s_acctbal double").write.parquet(
        str(tmp_path / "supplier.parquet"))
    got = QUERIES["q11_relationships_all_suppliers"](spark, str(tmp_path)).collect()
    assert [r["id"] for r in got] == ["SEC-9"]


def test_history_in_storage_rewrites_open_versions_only(spark, tmp_path, rows):
    schema = "id string, name string, score int"
    at = lambda d: F.lit(d).cast("timestamp")
    data = lambda *r: spark.createDataFrame(list(r), schema)
    days = [("2024-01-01", data(*[(f"k{i}", "n", i) for i in range(40)])),
            ("2024-02-01", data(("k1", None, 1), ("k2", "n", 2), ("new", "n", 0))),
            ("2024-03-01", data(("k1", "n", 1), ("k2", "n", 2), ("new", "n", 0))),
            ("2024-04-01", data(("k2", "n", 2)))]
    table = HistoryTable(spark, str(tmp_path / "h"), "id", ["name", "score"], buckets=8)
    plain = history.start_history(days[0][1], "id", at(days[0][0]))
    table.snapshot(days[0][1], at(days[0][0]))
    for day, df in days[1:]:
        closed, opened = set(table.closed_versions().inputFiles()), set(table.open_versions().inputFiles())
        bytes_before = {f: (tmp_path / f.split(str(tmp_path) + "/")[1]).read_bytes() for f in closed}
        table.snapshot(df, at(day))
        plain = history.apply_snapshot(plain, df, "id", ["name", "score"], at(day))
        assert rows(table.read().select(*plain.columns)) == rows(plain)
        assert closed <= set(table.closed_versions().inputFiles())
        assert all((tmp_path / f.split(str(tmp_path) + "/")[1]).read_bytes() == b for f, b in bytes_before.items())
        assert opened & set(table.open_versions().inputFiles())
    assert table.open_versions().filter("valid_to is not null").count() == 0
    assert table.closed_versions().filter("valid_to is null").count() == 0


def test_unique_columns_of_several_types_share_one_shuffle(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", None), (2, "a", float("nan")), (None, "c", float("nan"))], "i int, s string, d double")
    rules = [{"kind": suites.UNIQUE, "column": c} for c in "isd"] + [{"kind": suites.UNIQUE, "column": "i", "mostly": 0.3}]
    results = suites.evaluate_suite(df, rules)
    got = {r.position: (r.column_name, r.tested, r.unexpected, r.success) for r in results.collect()}
    assert got == {0: ("i", 3, 2, False), 1: ("s", 4, 2, False), 2: ("d", 3, 2, False), 3: ("i", 3, 2, True)}
    counts = suites.unique_counts(df, {0: "i", 1: "s", 2: "d"})
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "Union" not in plan
    none = suites.evaluate_suite(df.limit(0), rules).collect()
    assert [(r.tested, r.unexpected, r.success) for r in none] == [(0, 0, True)] * 4
