"""Canonical tables derived from the given tables, with the anomalies real feeds carry.

Each view is one projection over a scan; re-sent copies are an ``explode`` of the same scan, so the
work grows with the tables and nothing is read twice. ``ctes`` holds the same expressions as SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import pick
from tidemark.operators.clean import (
    latest_per_key, rejected_rows, tag_dataset, to_money, valid_rows,
)
from tidemark.plans import balances, model
from tidemark.schemas import (
    CANONICAL, COUNTRIES, CURRENCIES, MERCHANT_CATEGORIES, MONEY, PAYMENT_STATUSES, SECURITY_TYPES,
    STREAM_EVENT, TRANSACTION_STATUSES, TRANSACTION_TYPES,
)
from tidemark.sources.files import dealt
from tidemark.streaming import events as ev

EXCHANGES = ["NYSE", "NASDAQ", "ARCA"]


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _later(ts: Column, amount: Column, unit: str) -> Column:
    """Shift in plain interval arithmetic, without touching the session time zone."""
    return ts + F.make_dt_interval(**{unit: amount.cast("int")})


def _money_text(c: Column) -> Column:
    return c.cast(MONEY).cast("string")


def _ts(c: str) -> Column:
    return F.col(c).cast("timestamp")


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- reference data ------------------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            _id("CUST-", k).alias("customer_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit(""))), F.lit("@example.com")).alias(
                "email"
            ),
            pick(COUNTRIES, F.col("c_nationkey") % 6).alias("country_code"),
            (k % 101).cast("int").alias("risk_score"),
            _later(F.lit("2020-01-01").cast("timestamp"), k % 1000, "days").alias("created_at"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        k, segment = F.col("c_custkey"), F.col("c_mktsegment")
        return self.table("customer").select(
            _id("ACCT-", k).alias("account_id"),
            _id("CUST-", k).alias("customer_id"),
            F.when(segment == "MACHINERY", "BROKERAGE")
            .when(segment.isin("BUILDING", "HOUSEHOLD"), "SAVINGS")
            .otherwise("CHECKING")
            .alias("account_type"),
            F.lit("USD").alias("currency_code"),
            _money_text(F.col("c_acctbal")).alias("current_balance"),
            _later(F.lit("1990-01-01").cast("timestamp"), k % 365, "days").alias("opened_at"),
            F.when(k % 4 == 3, "CLOSED").when(k % 4 == 2, "SUSPENDED").otherwise("OPEN").alias(
                "status"
            ),
        )

    @cached_property
    def securities(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            _id("SEC-", k).alias("security_id"),
            _id("TK", k).alias("ticker"),
            F.col("p_name").alias("security_name"),
            pick(SECURITY_TYPES, F.col("p_size") % 4).alias("security_type"),
            pick(EXCHANGES, k % 3).alias("exchange_code"),
            F.lit("USD").alias("currency_code"),
        )

    # ---- transactional data --------------------------------------------------------------------
    @cached_property
    def orders_sent(self) -> DataFrame:
        """Orders, with a second copy of every fiftieth."""
        copies = F.when(F.col("o_orderkey") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        return self.table("orders").withColumn("copy", F.explode(copies))

    def _order_columns(self) -> dict[str, Column]:
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        price = F.col("o_totalprice")
        return {
            "account_id": _id("ACCT-", c),
            "customer_id": _id("CUST-", c),
            "transaction_amount": _money_text(F.when(k % 89 == 0, -price).otherwise(price)),
            "currency_code": F.when(k % 83 == 0, "ZZZ").otherwise(pick(CURRENCIES, c % 6)),
            "event_timestamp": _ts("o_orderdate"),
            "processing_timestamp": _later(
                _ts("o_orderdate"), k % 60 + F.col("copy") * 5, "mins"
            ),
            "country_code": pick(COUNTRIES, c % 6),
            "risk_score": F.when(k % 73 == 0, 150)
            .when(k % 71 == 0, F.lit(None))
            .otherwise((k * 7) % 101)
            .cast("int"),
        }

    @cached_property
    def transactions_keyed(self) -> DataFrame:
        """Raw transactions with the order key they come from."""
        k = F.col("o_orderkey")
        status = (
            F.when(F.col("copy") == 1, "REVERSED")
            .when(F.col("o_orderstatus") == "F", "POSTED")
            .when(F.col("o_orderstatus") == "O", "PENDING")
            .otherwise("FAILED")
        )
        columns = self._order_columns() | {
            "transaction_id": F.when(k % 97 != 0, _id("TXN-", k)),
            "transaction_type": pick(TRANSACTION_TYPES, k % 6),
            "transaction_status": status,
            "merchant_category": pick(MERCHANT_CATEGORIES, k % 7),
        }
        return self.orders_sent.select(
            "o_orderkey", *[columns[n].alias(n) for n in CANONICAL["transactions"].fieldNames()]
        )

    @cached_property
    def transactions_raw(self) -> DataFrame:
        return self.transactions_keyed.drop("o_orderkey")

    @cached_property
    def payments_raw(self) -> DataFrame:
        k = F.col("o_orderkey")
        columns = self._order_columns() | {
            "payment_id": F.when(k % 97 != 0, _id("PAY-", k)),
            "transaction_status": pick([*PAYMENT_STATUSES, "UNKNOWN"], k % 5),
            "counterparty_account_id": _id("ACCT-", F.col("o_custkey") + 1),
        }
        return self.orders_sent.select(
            [columns[n].alias(n) for n in CANONICAL["payments"].fieldNames()]
        )

    @cached_property
    def trades_raw(self) -> DataFrame:
        p, s = F.col("l_partkey"), F.col("l_suppkey")
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        per_unit = F.floor(cents / F.col("l_quantity"))
        at = _later(_ts("l_shipdate"), p % 1440, "mins")
        key = F.concat_ws("-", F.lit("TRD"), "l_orderkey", "l_linenumber")
        columns = {
            "trade_id": F.when(p % 101 != 0, key),
            "account_id": _id("ACCT-", F.col("o_custkey")),
            "customer_id": _id("CUST-", F.col("o_custkey")),
            "security_id": _id("SEC-", p),
            "quantity": _money_text(F.col("l_quantity")),
            "price": _money_text(per_unit / 100.0),
            "transaction_amount": _money_text(F.col("l_extendedprice")),
            "currency_code": F.when(s % 61 == 0, "ZZZ").otherwise(pick(CURRENCIES, s % 6)),
            "side": F.when(F.col("l_returnflag") == "A", "BUY")
            .when(F.col("l_returnflag") == "R", "SELL")
            .otherwise("HOLD"),
            "transaction_status": F.when(F.col("l_linestatus") == "O", "PENDING").otherwise("POSTED"),
            "event_timestamp": at,
            "processing_timestamp": _later(at, s % 60, "mins"),
            "country_code": pick(COUNTRIES, F.col("o_custkey") % 6),
            "risk_score": ((p * 3 + F.col("l_linenumber")) % 101).cast("int"),
        }
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        joined = self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.select([columns[n].alias(n) for n in CANONICAL["trades"].fieldNames()])

    @staticmethod
    def with_metadata(df: DataFrame) -> DataFrame:
        """Load metadata fixed by the data: the load day is the day of processing."""
        at = F.col("processing_timestamp")
        return df.withColumns(
            {
                "ingestion_timestamp": at,
                "source_file": F.lit("bronze"),
                "processing_date": F.to_date(at),
            }
        )

    def _tagged(self, raw: DataFrame, dataset: str, *amounts: str) -> DataFrame:
        kept = latest_per_key(
            to_money(raw, *amounts), CANONICAL[dataset].fieldNames()[0], "processing_timestamp"
        )
        return self.with_metadata(tag_dataset(kept, dataset))

    @cached_property
    def transactions_tagged(self) -> DataFrame:
        return self._tagged(self.transactions_raw, "transactions", "transaction_amount")

    @cached_property
    def payments_tagged(self) -> DataFrame:
        return self._tagged(self.payments_raw, "payments", "transaction_amount")

    @cached_property
    def trades_tagged(self) -> DataFrame:
        return self._tagged(
            self.trades_raw, "trades", "quantity", "price", "transaction_amount"
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return valid_rows(self.transactions_tagged)

    @cached_property
    def payments(self) -> DataFrame:
        return valid_rows(self.payments_tagged)

    @cached_property
    def trades(self) -> DataFrame:
        return valid_rows(self.trades_tagged)

    @cached_property
    def transactions_rejected(self) -> DataFrame:
        return rejected_rows(self.transactions_tagged)

    # ---- models --------------------------------------------------------------------------------
    @cached_property
    def balances(self) -> DataFrame:
        money = to_money(
            balances.daily_account_balances(self.accounts, self.transactions),
            "opening_balance", "closing_balance",
        )
        at = F.col("balance_date")
        return money.withColumns(
            {
                "ingestion_timestamp": at,
                "source_file": F.lit("bronze"),
                "processing_date": F.to_date(at),
            }
        )

    @cached_property
    def fct_transactions(self) -> DataFrame:
        return model.transaction_enrichment(
            model.staging(self.transactions, "transactions"), self.accounts
        )

    # ---- stream events -------------------------------------------------------------------------
    @cached_property
    def envelopes(self) -> DataFrame:
        """The events table as stream records: JSON payloads, some broken, some sent twice."""
        k, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
        event_type = (
            F.when(kind.isin("purchase", "signup"), "trade")
            .when(kind == "click", "transaction")
            .when(kind == "view", "payment")
            .otherwise("error")
        )
        copies = F.when(k % 37 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        base = dealt(self.table("events"), f"{self.sf_dir}/events.parquet").withColumns(
            {
                "at": _ts("ts"),
                "kind": event_type,
                "copy": F.explode(copies),
            }
        )
        kind = F.col("kind")
        is_txn, is_pay, is_trade = kind == "transaction", kind == "payment", kind == "trade"
        value = F.col("value")
        amount = F.when(k % 211 == 0, "abc").otherwise(
            _money_text(F.when(k % 89 == 0, -value).otherwise(value))
        )
        columns = {
            "event_id": F.when(k % 113 != 0, _id("EVT-", k)),
            "event_type": kind,
            "partition_key": _id("SEC-", k % 50),
            "transaction_id": F.when(is_txn, _id("TXN-E", k)),
            "payment_id": F.when(is_pay, _id("PAY-E", k)),
            "trade_id": F.when(is_trade & (k % 43 != 0), _id("TRD-E", k)),
            "account_id": _id("ACCT-", user),
            "customer_id": _id("CUST-", user),
            "security_id": F.when(is_trade, _id("SEC-", k % 50)),
            "transaction_type": F.when(is_txn, pick(TRANSACTION_TYPES, k % 6)),
            "transaction_amount": amount,
            "currency_code": F.when(k % 83 == 0, "ZZZ").otherwise(pick(CURRENCIES, user % 6)),
            "transaction_status": F.when(is_pay, pick(PAYMENT_STATUSES, k % 4)).otherwise(
                pick(TRANSACTION_STATUSES, k % 4)
            ),
            "event_timestamp": F.col("at"),
            "processing_timestamp": _later(F.col("at"), k % 60, "secs"),
            "merchant_category": F.when(is_txn, pick(MERCHANT_CATEGORIES, k % 7)),
            "country_code": pick(COUNTRIES, user % 6),
            "risk_score": F.when(k % 73 == 0, 150)
            .when(k % 71 == 0, F.lit(None))
            .otherwise(k % 101)
            .cast("int"),
            "counterparty_account_id": F.when(is_pay, _id("ACCT-", user + 1)),
            "quantity": F.when(is_trade, F.get_json_object("props", "$.k")),
            "price": F.when(is_trade, _money_text(value)),
            "side": F.when(
                is_trade,
                F.when(k % 31 == 0, "HOLD").when(k % 2 == 0, "BUY").otherwise("SELL"),
            ),
            "duplicate_flag": k % 37 == 0,
            "late_arrival_flag": k % 41 == 0,
        }
        text = F.to_json(
            F.struct(*[columns[n].alias(n) for n in STREAM_EVENT.fieldNames()]),
            {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
        )
        broken = F.when(k % 101 == 0, F.left(text, F.lit(30))).otherwise(text)
        delay = F.when(k % 41 == 0, 3 * 86400).otherwise(5)
        return base.select(
            _id("U", user).alias("partitionKey"),
            F.concat_ws("-", k.cast("string"), F.col("copy").cast("string")).alias("sequenceNumber"),
            _later(F.col("at"), delay, "secs").alias("approximateArrivalTimestamp"),
            broken.cast("binary").alias("data"),
        )

    @cached_property
    def parsed(self) -> DataFrame:
        return ev.parse_envelope(self.envelopes)

    @cached_property
    def events_tagged(self) -> DataFrame:
        """Unique events, tagged, with load metadata fixed by the data."""
        good = self.parsed.filter("not parse_failed").drop(*ev.ENVELOPE_COLUMNS)
        kept = latest_per_key(good, "event_id", "processing_timestamp")
        stamped = ev.with_stream_metadata(kept).withColumns(
            {
                "ingestion_timestamp": F.col("processing_timestamp"),
                "processing_date": F.to_date("processing_timestamp"),
            }
        )
        return ev.tag_events(stamped)

    @cached_property
    def events_valid(self) -> DataFrame:
        return valid_rows(self.events_tagged)

    @cached_property
    def events_rejected(self) -> DataFrame:
        return rejected_rows(self.events_tagged)

    @cached_property
    def stream_trades(self) -> DataFrame:
        return ev.route(self.events_valid, "trade")

    @cached_property
    def fct_stream_trades(self) -> DataFrame:
        return model.fct_stream_trades(self.stream_trades)
