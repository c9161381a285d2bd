"""Reporting marts. All aggregates combine map-side, so hot groups cost no extra shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import safe_divide
from tidemark.schemas import MONEY

AMOUNT = "transaction_amount"


def total(c: Column | str) -> Column:
    return F.sum(c).cast(MONEY)


def average(c: Column | str) -> Column:
    """Mean of a money column, kept in money precision (rounded once, half up)."""
    return F.try_divide(F.sum(c), F.count(c)).cast(MONEY)


def financial_performance(facts: DataFrame) -> DataFrame:
    return facts.groupBy(
        "processing_date",
        F.to_date("event_timestamp").alias("transaction_date"),
        "currency_code",
        "merchant_category",
        "transaction_type",
    ).agg(
        total(AMOUNT).alias("total_transaction_amount"),
        F.count("*").alias("transaction_count"),
        average(AMOUNT).alias("avg_transaction_amount"),
    )


def per_key_then_join(dimension: DataFrame, facts: DataFrame, key: str, *aggregates) -> DataFrame:
    """Dimension rows with aggregates of their facts.

    Facts are reduced to one row per key before the join: the join then moves keys, not facts, and a
    customer with a third of all rows is one row on either side.
    """
    reduced = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggregates)
    return dimension.join(reduced, key, "left")


def customer_risk(customers: DataFrame, facts: DataFrame) -> DataFrame:
    joined = per_key_then_join(
        customers.select(
            "customer_id", "full_name", "country_code", F.col("risk_score").alias("customer_risk_score")
        ),
        facts,
        "customer_id",
        F.count("transaction_id").alias("_n"),
        total(AMOUNT).alias("total_transaction_amount"),
        average(AMOUNT).alias("avg_transaction_amount"),
        F.max("risk_score").alias("max_transaction_risk_score"),
    )
    return joined.select(
        "customer_id", "full_name", "country_code", "customer_risk_score",
        F.coalesce("_n", F.lit(0)).alias("transaction_count"),
        "total_transaction_amount", "avg_transaction_amount", "max_transaction_risk_score",
    )


def regulatory_reconciliation(facts: DataFrame, by: str | Column = "processing_date") -> DataFrame:
    def flow(*kinds: str) -> Column:
        return total(F.when(F.col("transaction_type").isin(*kinds), F.col(AMOUNT)).otherwise(0))

    sums = facts.groupBy(by).agg(
        F.count("*").alias("transaction_count"),
        flow("DEBIT").alias("debit_total"),
        flow("CREDIT").alias("credit_total"),
    )
    gap = F.abs(F.col("debit_total") - F.col("credit_total")).cast(MONEY)
    volume = F.col("debit_total") + F.col("credit_total")
    return sums.withColumns(
        {
            "debit_credit_difference": gap,
            "net_flow_imbalance_ratio": safe_divide(gap.cast("double"), volume.cast("double")),
        }
    )


def stream_trade_performance(trades: DataFrame) -> DataFrame:
    return trades.groupBy(
        "processing_date", "trade_date", "security_id", "currency_code", "side"
    ).agg(
        total(AMOUNT).alias("total_notional_amount"),
        total("quantity").alias("total_quantity"),
        F.count("*").alias("trade_count"),
        average("price").alias("avg_trade_price"),
        F.avg("risk_score").alias("avg_risk_score"),
    )


def trade_minute_metrics(trades: DataFrame) -> DataFrame:
    minute = F.date_trunc("minute", F.col("event_timestamp")).alias("trade_minute")
    return trades.groupBy("security_id", "currency_code", "side", minute, "processing_date").agg(
        F.count("*").alias("trade_count"),
        total("quantity").alias("total_quantity"),
        total(AMOUNT).alias("total_transaction_amount"),
        average("price").alias("avg_trade_price"),
        F.max("risk_score").alias("max_risk_score"),
    )


def customer_trade_exposure(trades: DataFrame) -> DataFrame:
    """Exposure per customer, account, security, currency and day. Any side but BUY counts negative,
    so apply it to trades whose side has been checked."""
    buys, quantity = F.col("side") == "BUY", F.col("quantity")
    return trades.groupBy(
        "customer_id", "account_id", "security_id", "currency_code", "processing_date"
    ).agg(
        F.count_if(buys).alias("buy_trade_count"),
        F.count_if(F.col("side") == "SELL").alias("sell_trade_count"),
        total(F.when(buys, quantity).otherwise(-quantity)).alias("net_quantity"),
        total(AMOUNT).alias("gross_notional_amount"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.max("event_timestamp").alias("latest_event_timestamp"),
    )


def stream_reconciliation(trades: DataFrame, rejected: DataFrame, how: str = "left") -> DataFrame:
    """Accepted against rejected per load day. The default keeps days with accepted trades only;
    ``how='full'`` also shows days on which everything was rejected."""
    accepted = trades.groupBy("processing_date").agg(
        F.count("*").alias("_accepted"), total(AMOUNT).alias("accepted_notional_amount")
    )
    refused = rejected.groupBy("processing_date").agg(F.count("*").alias("_rejected"))
    ok, bad = F.coalesce("_accepted", F.lit(0)), F.coalesce("_rejected", F.lit(0))
    return accepted.join(refused, "processing_date", how).select(
        "processing_date",
        ok.alias("accepted_trade_count"),
        "accepted_notional_amount",
        bad.alias("rejected_event_count"),
        safe_divide(bad.cast("double"), ok + bad).alias("rejection_ratio"),
    )
