import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.mapping import SPECS, Context, apply_mapping, contract_issues, mapping_issues
from tidemark.schemas import LINEAGE_FIELDS
from tidemark.sources import bank_feed, listing_feed, market_feed

AT = dt.datetime(2024, 6, 1, 12)
NOW = lambda: F.lit("2024-06-01 12:00:00").cast("timestamp")


def bank(spark, **fields):
    schema = f"customer_id string, country_code string, r {bank_feed.TRANSACTION_PAYLOAD}"
    record = {"transaction_id": "t", "account_id": "a", "amount": 10.0, **fields}
    text = json.dumps({"customer_id": "c", "country_code": "GB", "r": record})
    df = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", schema).alias("x"))
    return bank_feed.map_transactions(df.select("x.customer_id", "x.country_code", "x.r.*"), loaded_at=NOW()).head()


@pytest.mark.parametrize(
    "fields, kind",
    [
        ({"amount": 100, "personal_finance_category": {"primary": "PAYROLL"}}, "CREDIT"),
        ({"personal_finance_category": {"primary": "loan_payments"}}, "WIRE"),
        ({"name": "a refund of fee"}, "CREDIT"),
        ({"name": "wire fee"}, "WIRE"),
        ({"name": "late fee"}, "FEE"),
        ({"name": "shop", "amount": -3}, "CREDIT"),
        ({"name": "shop"}, "DEBIT"),
        ({}, "DEBIT"),
    ],
)
def test_transaction_type(spark, fields, kind):
    assert bank(spark, **fields).transaction_type == kind


@pytest.mark.parametrize(
    "fields, category",
    [
        ({"name": "Utility Electric Bill"}, "UTILITIES"),
        ({"name": "x", "personal_finance_category": {"primary": "food"}}, "FOOD"),
        ({"merchant_name": "Corner Shop", "name": "y"}, "CORNER SHOP"),
        ({"merchant_name": "", "name": "y"}, "Y"),
        ({}, "UNKNOWN"),
    ],
)
def test_merchant_category(spark, fields, category):
    assert bank(spark, **fields).merchant_category == category


@pytest.mark.parametrize(
    "fields, risk",
    [({}, 20), ({"amount": 1000.01}, 40), ({"amount": -6000, "pending": True}, 70),
     ({"amount": 6000, "pending": True, "location": {"country": "DE"}}, 85), ({"location": {"country": "US"}}, 20)],
)
def test_transaction_risk(spark, fields, risk):
    assert bank(spark, **fields).risk_score == risk


def test_transaction_times_and_fallbacks(spark):
    r = bank(spark, authorized_datetime="2026-08-10T10:00:00Z", date="2026-08-01", pending=True, amount=-12.5)
    assert r.event_timestamp == dt.datetime(2026, 8, 10, 10) and r.transaction_status == "PENDING"
    assert r.transaction_amount == "12.50" and r.currency_code == "USD" and r.country_code == "GB"
    assert bank(spark, date="2026-08-01").event_timestamp == dt.datetime(2026, 8, 1)
    assert bank(spark).event_timestamp == AT


def test_bundles(spark):
    text = json.dumps({
        "customer_id": "c", "country_code": "US",
        "accounts": [{"account_id": "a", "type": "depository", "subtype": "Savings plus", "balances": {"current": "5.5"}}],
        "responses": [{"added": [{"transaction_id": "t1", "account_id": "a", "amount": 1}]},
                      {"added": []}, {"added": [{"transaction_id": "t2", "account_id": "zz", "amount": 2}]}]})
    df = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", bank_feed.BUNDLE_PAYLOAD).alias("x")).select("x.*")
    out = bank_feed.map_bundles(df, NOW())
    account = out["accounts"].head()
    assert (account.account_type, account.currency_code, account.current_balance, account.status) == ("SAVINGS", "USD", "5.5", "OPEN")
    assert sorted(r.transaction_id for r in out["transactions"].collect()) == ["t1", "t2"]


def market(spark, **fields):
    df = spark.createDataFrame([(json.dumps({"T": "t", **fields}),)], "j string")
    parsed = market_feed.parse_messages(df, "j")
    return market_feed.map_trade_messages(parsed, F.lit("A"), F.lit("C"), F.lit("US"), F.lit(20), NOW()).head()


def test_trade_message(spark):
    r = market(spark, S="AAPL", i=628, x="K", p=162.92, s=3, t="2026-08-15T12:00:00Z", c=["@"], z="C")
    assert (r.trade_id, r.security_id, r.transaction_amount) == ("ALPACA-AAPL-K-628", "SEC-AAPL", "488.76")
    assert (r.event_id, r.side, r.risk_score) == ("EVT-ALPACA-AAPL-K-628", "SELL", 20)
    assert r.event_timestamp == dt.datetime(2026, 8, 15, 12)


def test_trade_rules(spark):
    assert market(spark, S="a", i=0, t="2026-08-15T12:00:00Z").trade_id == "ALPACA-A-UNK-2026-08-15T12:00:00Z"
    assert market(spark, S="a").trade_id == "ALPACA-A-UNK-NOID"
    assert market(spark, S="a", tks="b").side == "BUY"
    assert market(spark, S="a", tks="S", c=["B"]).side == "SELL"
    assert market(spark, S="a", c=["x", "cb"]).side == "BUY"
    assert market(spark, S="a", s=100, p=100, z="?").risk_score == 50
    assert market(spark, S="a", s=99.9, p=1000, z="a").risk_score == 35
    assert market(spark, T="q", S="a") is None


def test_securities(spark, rows):
    df = spark.createDataFrame(
        [(" aapl ", "Apple", " nyse", None), ("x", "", "", "mutual fund"), (" ", "n", "e", "Stock"), ("s", "n", "e", "Stock")],
        "symbol string, name string, exchange string, assetType string")
    got = rows(listing_feed.map_securities(df))
    assert got == [("SEC-AAPL", "AAPL", "Apple", "EQUITY", "NYSE", "USD"), ("SEC-S", "S", "n", "EQUITY", "E", "USD"),
                   ("SEC-X", "X", "X", "MUTUAL_FUND", "UNKNOWN", "USD")]


def test_daily_prices(spark, rows):
    text = json.dumps({"Time Series (Daily)": {
        "2026-08-14": {"1. open": "1.0", "2. high": "2.0", "3. low": "None", "4. close": "", "5. volume": "12"},
        "2026-08-13": {"1. open": "3.0"}}})
    df = spark.createDataFrame([("ibm", text)], "symbol string, t string")
    payload = f"struct<`{listing_feed.SERIES_KEY}`: map<string, map<string, string>>>"
    df = df.select("symbol", F.from_json("t", f"`{listing_feed.SERIES_KEY}` map<string, map<string, string>>").alias("payload"))
    got = rows(listing_feed.map_daily_prices(df))
    assert got[1] == ("SEC-IBM", "IBM", "2026-08-14", "1.0", "2.0", "0", "0", 12, "alpha_vantage") and payload
    assert got[0][2:4] == ("2026-08-13", "3.0") and got[0][7] == 0


def test_mappings_meet_the_contract():
    for provider in SPECS:
        assert mapping_issues(provider) == []
    broken = {"trades": {"trade_id": ("id", "direct"), "bogus": ("x", "direct")}, "nothing": {}}
    issues = mapping_issues("market", broken)
    assert ("market", "nothing", "*", "unknown canonical entity") in issues
    assert ("market", "trades", "bogus", "mapped target field not in canonical contract") in issues
    assert ("market", "trades", "account_id", "required field missing and derivation not allowed") in issues
    assert not any(i[2] == "side" for i in issues)


def test_apply_mapping_accounts(spark):
    df = spark.createDataFrame(
        [("a1", ("c1",), "credit", ("7.125", ""), None, None)],
        "account_id string, owner struct<customer_id: string>, type string, "
        "balances struct<current: string, iso_currency_code: string>, created_at string, status string")
    r = apply_mapping(df, "bank", "accounts", Context(NOW())).head()
    assert (r.account_type, r.current_balance, r.currency_code, r.opened_at, r.status) == ("CHECKING", "7.13", "USD", AT, "OPEN")


def test_contract_issues(spark, rows):
    df = spark.createDataFrame([("c1", "n", None, "x"), (None, "n", "e", "7")], "customer_id string, full_name string, email string, risk_score string")
    assert rows(contract_issues(df, "customers")) == [
        ("customer_id", "null in required field", 1), ("email", "null in required field", 1), ("risk_score", "not a integer", 1)]


def test_lineage_has_the_required_fields(spark):
    df = spark.createDataFrame([("c", 1), ("d", 2)], "customer_id string, n int")
    out = bank_feed.lineage(df, "bank", "accounts", F.col("customer_id"), NOW())
    assert sorted(out.columns) == sorted(LINEAGE_FIELDS)
    assert out.select("raw_payload_checksum").distinct().count() == 2
