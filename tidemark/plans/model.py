"""Dimensions, facts, staging and intermediate models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import risk_band
from tidemark.schemas import CANONICAL, GOLD_TABLES, LOAD_METADATA


def gold(df: DataFrame, dataset: str) -> DataFrame:
    """The gold table of a canonical dataset: its own columns plus load metadata."""
    return df.select(*CANONICAL[dataset].fieldNames(), *LOAD_METADATA)


def gold_name(dataset: str) -> str:
    return GOLD_TABLES[dataset]


def staging(df: DataFrame, dataset: str) -> DataFrame:
    """Canonical columns with load metadata; timestamp fields as timestamps."""
    stamps = {
        f.name for f in CANONICAL[dataset].fields if f.dataType.typeName() == "timestamp"
    } | {"ingestion_timestamp"}
    names = [*CANONICAL[dataset].fieldNames(), *LOAD_METADATA]
    return df.select(
        [F.col(c).cast("timestamp").alias(c) if c in stamps else F.col(c) for c in names]
    )


def model_dimension(staged: DataFrame, dataset: str) -> DataFrame:
    return staged.select(*CANONICAL[dataset].fieldNames())


def transaction_enrichment(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions with their account type and risk band.

    One row per account on the right. Spark broadcasts it when its size allows; otherwise adaptive
    execution splits the rows of a hot account.
    """
    kinds = accounts.select("account_id", "account_type")
    return transactions.join(kinds, "account_id", "left").select(
        "transaction_id",
        "account_id",
        "customer_id",
        "account_type",
        *[c for c in CANONICAL["transactions"].fieldNames()[3:]],
        risk_band("risk_score").alias("risk_band"),
        "processing_date",
    )


def account_daily_balance(balances: DataFrame) -> DataFrame:
    change = F.col("closing_balance") - F.col("opening_balance")
    return balances.select(
        *CANONICAL["daily_account_balances"].fieldNames()[:6],
        change.cast("decimal(18,2)").alias("net_balance_change"),
        "currency_code",
        "processing_date",
    )


FCT_STREAM_TRADE = [
    "event_id", *CANONICAL["trades"].fieldNames(), "ingestion_timestamp",
]


def fct_stream_trades(staged: DataFrame) -> DataFrame:
    at = F.col("event_timestamp")
    return staged.select(
        *FCT_STREAM_TRADE,
        F.to_date(at).alias("trade_date"),
        F.date_trunc("minute", at).alias("trade_minute"),
        "processing_date",
    )
