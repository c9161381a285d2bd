import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators.suites import ValidationFailed
from tidemark.plans import balances, batch, marts, reports
from tidemark.schemas import CANONICAL


def test_daily_balances_golden(spark, rows):
    accounts = spark.createDataFrame(
        [("acct-1", "c", "USD", "200.00", dt.datetime(2026, 1, 2)), ("acct-2", "c", "USD", "9.50", dt.datetime(2026, 1, 3, 5))],
        "account_id string, customer_id string, currency_code string, current_balance string, opened_at timestamp")
    txns = spark.createDataFrame(
        [("acct-1", "DEBIT", Decimal("20.00"), dt.datetime(2026, 8, 10, 9)), ("acct-1", "CREDIT", Decimal("50.00"), dt.datetime(2026, 8, 11, 9)),
         ("ghost", "DEBIT", Decimal("1.00"), dt.datetime(2026, 8, 11)), (None, "DEBIT", Decimal("1.00"), dt.datetime(2026, 8, 11))],
        "account_id string, transaction_type string, transaction_amount decimal(18,2), event_timestamp timestamp")
    got = rows(balances.daily_account_balances(accounts, txns), "balance_id", "opening_balance", "closing_balance")
    assert got == [
        ("acct-1-2026-08-10", Decimal("170.00"), Decimal("150.00")),
        ("acct-1-2026-08-11", Decimal("150.00"), Decimal("200.00")),
        ("acct-2-2026-01-03", Decimal("9.50"), Decimal("9.50"))]


FACT = "transaction_id string, customer_id string, account_id string, transaction_type string, transaction_amount decimal(18,2), risk_score int, processing_date date, event_timestamp timestamp"
DAY = dt.date(2026, 8, 10)
TS = dt.datetime(2026, 8, 10, 1)


def facts(spark, *items):
    return spark.createDataFrame([(i, c, "a", t, Decimal(a), r, DAY, TS) for i, c, t, a, r in items], FACT)


def test_regulatory_reconciliation(spark):
    r = marts.regulatory_reconciliation(facts(spark, ("1", "c", "DEBIT", "30", 1), ("2", "c", "CREDIT", "10", 1), ("3", "c", "FEE", "99", 1))).head()
    assert (r.transaction_count, r.debit_total, r.credit_total, r.debit_credit_difference, r.net_flow_imbalance_ratio) == (3, Decimal(30), Decimal(10), Decimal(20), 0.5)
    none = marts.regulatory_reconciliation(facts(spark, ("3", "c", "FEE", "99", 1))).head()
    assert none.net_flow_imbalance_ratio is None and none.debit_total == 0


def test_customer_risk_counts_zero(spark, rows):
    people = spark.createDataFrame([("c", "n", "US", 5), ("d", "m", "GB", 85)], "customer_id string, full_name string, country_code string, risk_score int")
    mart = marts.customer_risk(people, facts(spark, ("1", "c", "DEBIT", "0.10", 90), ("2", "c", "DEBIT", "0.15", 3)))
    got = rows(reports.with_risk_flag(mart), "customer_id", "transaction_count", "avg_transaction_amount", "max_transaction_risk_score", "high_risk_customer_flag")
    assert got == [("c", 2, Decimal("0.13"), 90, "High"), ("d", 0, None, None, "High")]


def test_stream_reconciliation_variants(spark, rows):
    trades = spark.createDataFrame([(DAY, Decimal("5.00"))], "processing_date date, transaction_amount decimal(18,2)")
    rejected = spark.createDataFrame([(DAY,), (dt.date(2026, 8, 11),)], "processing_date date")
    assert len(rows(marts.stream_reconciliation(trades, rejected))) == 1
    full = rows(marts.stream_reconciliation(trades, rejected, "full"))
    assert full[1] == (dt.date(2026, 8, 11), 0, None, 1, 1.0)


def write_bronze(root, dataset, records, name=None):
    folder = root / "bronze" / dataset
    folder.mkdir(parents=True, exist_ok=True)
    (folder / (name or f"{dataset}_20260815T000000Z.json")).write_text(json.dumps(records))


def txn(i, **over):
    return {"transaction_id": i, "account_id": "a1", "customer_id": "c1", "transaction_type": "DEBIT", "transaction_amount": "10.00",
            "currency_code": "USD", "transaction_status": "POSTED", "event_timestamp": "2026-08-10T10:00:00Z",
            "processing_timestamp": "2026-08-10T10:05:00Z", "merchant_category": "DINING", "country_code": "US", "risk_score": 10, **over}


def test_batch_end_to_end(spark, tmp_path, rows):
    for dataset in CANONICAL:
        write_bronze(tmp_path, dataset, [])
    write_bronze(tmp_path, "customers", [{"customer_id": "c1", "full_name": "N", "risk_score": 3, "created_at": "2026-01-01T00:00:00Z"}])
    write_bronze(tmp_path, "customers", [{"customer_id": "c1", "full_name": "Newer"}], "customers_20260816T000000Z.json")
    write_bronze(tmp_path, "daily_account_balances", [{"balance_id": "b", "account_id": "a1", "opening_balance": "1.005", "closing_balance": "oops"}])
    write_bronze(tmp_path, "transactions", [
        txn("t1"), txn("t1", processing_timestamp="2026-08-10T11:00:00Z", transaction_amount="12.00"), txn("t1"),
        txn("t2", transaction_type="CREDIT"), txn(None), txn(None), txn("t3", currency_code="ZZZ"),
        txn("t4", transaction_amount="-5"), txn("t5", risk_score=999), txn("t6", transaction_amount="abc"), txn("t7", risk_score=None)])
    options = batch.Options(run_at=F.lit("2026-08-15 02:00:00").cast("timestamp"))
    out = batch.run_batch(spark, str(tmp_path), options)
    counts = out["transactions"]["counts"].iloc[0]
    assert (counts.valid_rows, counts.rejected_rows) == (2, 7)
    assert rows(spark.read.parquet(str(tmp_path / "gold/fact_transaction")), "transaction_id", "transaction_amount") == [("t1", Decimal("12.00")), ("t2", Decimal("10.00"))]
    reasons = rows(spark.read.parquet(str(tmp_path / "rejected/transactions")), "transaction_id", "rejection_reason")
    assert reasons == [("t3", "invalid_currency"), ("t4", "negative_amount"), ("t5", "validation_failed"), ("t6", "validation_failed"),
                       ("t7", "validation_failed"), (None, "transaction_id_null"), (None, "transaction_id_null")]
    # The newer file wins for reference data.
    assert rows(spark.read.parquet(str(tmp_path / "gold/dim_customer")), "customer_id", "full_name") == [("c1", "Newer")]
    assert rows(spark.read.parquet(str(tmp_path / "gold/fact_daily_account_balance")), "opening_balance", "closing_balance") == [(Decimal("1.01"), None)]
    gold = out["transactions"]["gold_summary"][0]
    assert gold.suite_name == "gold_load_validation" and not gold.success
    # The same load again leaves the same tables.
    batch.run_batch(spark, str(tmp_path), options)
    assert spark.read.parquet(str(tmp_path / "gold/fact_transaction")).count() == 2
    options.on_fail = "raise"
    try:
        batch.run_batch(spark, str(tmp_path), options)
    except ValidationFailed as error:
        assert "gold_load_validation" in str(error)
    else:
        raise AssertionError("a failing suite must stop the load")
