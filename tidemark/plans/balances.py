"""Daily balances from current balances and transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.schemas import MONEY

# Types that add to a balance; all others take from it.
CREDITING_TYPES = ["CREDIT", "REFUND"]


def daily_account_balances(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Opening and closing balance per account and active day, back-computed from today's balance.

    Transactions are first summed per account and day, so the running window holds at most one row
    per day of an account, however many transactions the account has. An account without
    transactions has one row on the day it was opened.
    """
    amount = F.col("transaction_amount")
    added = F.upper(F.coalesce("transaction_type", F.lit(""))).isin(CREDITING_TYPES)
    daily = (
        transactions.filter(F.col("account_id").isNotNull())
        .groupBy("account_id", F.to_date("event_timestamp").alias("_day"))
        .agg(F.sum(F.when(added, amount).otherwise(-amount)).alias("_net"))
    )
    account = Window.partitionBy("account_id")
    so_far = account.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = daily.select(
        "account_id",
        "_day",
        "_net",
        F.sum("_net").over(so_far).alias("_running"),
        F.sum("_net").over(account).alias("_total"),
    )
    owner = accounts.select(
        "account_id", "customer_id", "currency_code", "opened_at",
        F.col("current_balance").cast(MONEY).alias("_now"),
    )
    zero = F.lit(0).cast(MONEY)
    day = F.coalesce("_day", F.to_date("opened_at"))
    closing = F.col("_now") - F.coalesce("_total", zero) + F.coalesce("_running", zero)
    return owner.join(running, "account_id", "left").select(
        F.concat_ws("-", "account_id", day.cast("string")).alias("balance_id"),
        "account_id",
        "customer_id",
        day.cast("timestamp").alias("balance_date"),
        (closing - F.coalesce("_net", zero)).cast(MONEY).alias("opening_balance"),
        closing.cast(MONEY).alias("closing_balance"),
        "currency_code",
    )
