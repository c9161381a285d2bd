"""Ad-hoc reports and dashboard fields over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import safe_divide
from tidemark.operators.recon import one_row
from tidemark.plans.marts import AMOUNT, average, per_key_then_join, total



def _day():
    return F.to_date("event_timestamp").alias("transaction_date")


def _count():
    return F.count("*").alias("transaction_count")


def _total():
    return total(AMOUNT).alias("total_transaction_amount")


def _average():
    return average(AMOUNT).alias("avg_transaction_amount")


def daily_totals(facts: DataFrame) -> DataFrame:
    out = facts.groupBy(_day(), "currency_code").agg(_total(), _count())
    return out.orderBy(F.desc("transaction_date"), "currency_code")


def daily_status(facts: DataFrame) -> DataFrame:
    out = facts.groupBy(_day(), "transaction_status").agg(_count(), _total())
    return out.orderBy(F.desc("transaction_date"), "transaction_status")


def high_risk(facts: DataFrame, at_least: int = 30) -> DataFrame:
    return (
        facts.filter(F.col("risk_score") >= at_least)
        .select(
            "transaction_id", "account_id", "customer_id", AMOUNT, "currency_code",
            "merchant_category", "transaction_status", "risk_score", "event_timestamp",
        )
        .orderBy(F.desc("risk_score"), F.desc(AMOUNT), F.desc("event_timestamp"))
    )


def latest_balances(balances: DataFrame) -> DataFrame:
    return balances.groupBy("account_id").agg(
        F.max("balance_date").alias("latest_balance_date"),
        F.max_by("closing_balance", "balance_date").alias("latest_closing_balance"),
    )


def account_balances(balances: DataFrame) -> DataFrame:
    return (
        balances.groupBy("account_id")
        .agg(
            F.max("balance_date").alias("latest_balance_date"),
            F.max_by("closing_balance", "balance_date").alias("latest_closing_balance"),
            average("closing_balance").alias("avg_closing_balance"),
        )
        .orderBy(F.desc("latest_closing_balance"))
    )


def merchant_distribution(facts: DataFrame) -> DataFrame:
    out = facts.groupBy("merchant_category").agg(_count(), _total(), _average())
    return out.orderBy(F.desc("total_transaction_amount"))


def cross_table_summary(facts: DataFrame, balances: DataFrame) -> DataFrame:
    """One row over two tables, merged by an aggregate instead of a join without a key."""
    return one_row(
        facts.agg(_count(), total(AMOUNT).alias("transaction_amount_sum")),
        balances.agg(
            F.count("*").alias("balance_count"),
            average("closing_balance").alias("avg_closing_balance"),
        ),
    )


def status_breakdown(facts: DataFrame) -> DataFrame:
    out = facts.groupBy("transaction_status").agg(_count(), _total(), _average())
    return out.orderBy(F.desc("transaction_count"))


def customer_summary(customers: DataFrame, facts: DataFrame) -> DataFrame:
    people = customers.select(
        "customer_id", "full_name", "email", F.col("risk_score").alias("customer_risk_score")
    )
    joined = per_key_then_join(
        people, facts, "customer_id",
        F.count("transaction_id").alias("_n"), _total(), _average(),
        F.max("event_timestamp").alias("latest_transaction_timestamp"),
    )
    return joined.select(
        *people.columns,
        F.coalesce("_n", F.lit(0)).alias("transaction_count"),
        "total_transaction_amount", "avg_transaction_amount", "latest_transaction_timestamp",
    ).orderBy(F.desc_nulls_last("total_transaction_amount"))


def account_activity(accounts: DataFrame, balances: DataFrame, facts: DataFrame) -> DataFrame:
    """Accounts with their latest balance and activity: both sides are one row per account before
    they are joined, so the account key is shuffled as aggregates only."""
    joined = per_key_then_join(
        accounts.select("account_id", "account_type", "status").join(
            latest_balances(balances), "account_id", "left"
        ),
        facts, "account_id", F.count("transaction_id").alias("_n"), _total(),
    )
    return joined.select(
        "account_id", "account_type", "status", "latest_balance_date", "latest_closing_balance",
        F.coalesce("_n", F.lit(0)).alias("transaction_count"), "total_transaction_amount",
    ).orderBy(F.desc_nulls_last("total_transaction_amount"))


def cashflow_trend(facts: DataFrame) -> DataFrame:
    out = facts.groupBy(_day(), "transaction_type").agg(_count(), _total())
    return out.orderBy(F.desc("transaction_date"), "transaction_type")


def top_trade_minutes(metrics: DataFrame, n: int = 200) -> DataFrame:
    """Newest minutes. Rows equal in the report's order are separated by the remaining group keys."""
    shown = [
        "trade_minute", "security_id", "side", "trade_count", "total_quantity",
        "total_transaction_amount", "avg_trade_price",
    ]
    order = [F.desc("trade_minute"), "security_id", "side", "currency_code", "processing_date"]
    return metrics.orderBy(*order).limit(n).select(*shown)


def top_exposure(exposure: DataFrame, n: int = 200) -> DataFrame:
    shown = [
        "customer_id", "account_id", "security_id", "buy_trade_count", "sell_trade_count",
        "net_quantity", "gross_notional_amount", "avg_risk_score", "latest_event_timestamp",
    ]
    order = [
        F.desc("gross_notional_amount"), F.desc("latest_event_timestamp"),
        "customer_id", "account_id", "security_id", "currency_code", "processing_date",
    ]
    return exposure.orderBy(*order).limit(n).select(*shown)


def rejected_events(rejected: DataFrame) -> DataFrame:
    return (
        rejected.groupBy("processing_date", "rejection_reason")
        .agg(F.count("*").alias("rejected_event_count"))
        .orderBy(F.desc("processing_date"), F.desc("rejected_event_count"))
    )


def newest_trade_days(trades: DataFrame, n: int = 10) -> DataFrame:
    return (
        trades.groupBy("processing_date")
        .agg(F.count("*").alias("trade_count"), total(AMOUNT).alias("total_notional"))
        .orderBy(F.desc("processing_date"))
        .limit(n)
    )


# ---- dashboard fields --------------------------------------------------------------------------
def ticket_size(performance: DataFrame, *groups: str) -> DataFrame:
    ticket = safe_divide(
        F.sum("total_transaction_amount").cast("double"), F.sum("transaction_count").cast("double")
    )
    return performance.groupBy(*groups).agg(ticket.alias("average_ticket_size"))


def with_risk_flag(risk: DataFrame) -> DataFrame:
    high = (F.col("customer_risk_score") >= 80) | (F.col("max_transaction_risk_score") >= 80)
    return risk.withColumn("high_risk_customer_flag", F.when(high, "High").otherwise("Normal"))


def with_health(reconciliation: DataFrame) -> DataFrame:
    gap, ratio = F.col("debit_credit_difference"), F.col("net_flow_imbalance_ratio")
    return reconciliation.withColumns(
        {
            "reconciliation_gap_flag": F.when(gap > 1000, "Investigate").otherwise("Normal"),
            "batch_health_status": F.when(ratio > 0.75, "Critical")
            .when(ratio > 0.40, "Warning")
            .otherwise("Healthy"),
        }
    )
