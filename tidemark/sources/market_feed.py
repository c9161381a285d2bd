"""Market trade messages to canonical trade events, in batch or on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import or_default, plain_decimal

# Fixed values
TRADE_ID_PREFIX = "ALPACA"
KNOWN_TAPES = ["A", "B", "C", "D", "J", "K", "N", "P", "Q", "V", "Z"]

# Message keys. They differ by case only (T and t, S and s), which Spark columns do
# not, so messages are parsed to a map (its keys keep their case) and the columns get full names.
MESSAGE_KEYS = {
    "message_type": "T",
    "symbol": "S",
    "message_id": "i",
    "exchange": "x",
    "price": "p",
    "size": "s",
    "message_time": "t",
    "conditions": "c",
    "tape": "z",
    "taker_side": "tks",
}
_MESSAGE_TYPES = {"price": "double", "size": "double"}


def parse_messages(df: DataFrame, text: str) -> DataFrame:
    """JSON trade messages to columns; one parse per message. Other columns are kept."""
    fields = df.withColumn("_m", F.from_json(text, "map<string, string>"))
    columns = []
    for name, key in MESSAGE_KEYS.items():
        value = F.try_element_at("_m", F.lit(key))
        if name == "conditions":
            value = F.from_json(value, "array<string>")
        elif name in _MESSAGE_TYPES:
            value = value.try_cast(_MESSAGE_TYPES[name])
        columns.append(value.alias(name))
    kept = [c for c in df.columns if c != text]
    return fields.select(*kept, *columns)


def security_id(symbol: Column) -> Column:
    """``SEC-`` and the symbol; null where the symbol is blank, so the row is rejected later."""
    clean = F.upper(F.trim(symbol))
    return F.when(clean != "", F.concat(F.lit("SEC-"), clean))


def trade_id() -> Column:
    """Symbol, exchange and message id; zero and empty values count as absent."""
    key = F.coalesce(
        F.when(~F.col("message_id").isin("", "0"), F.col("message_id")),
        F.nullif(F.col("message_time"), F.lit("")),
        F.lit("NOID"),
    )
    return F.concat_ws(
        "-",
        F.lit(TRADE_ID_PREFIX),
        F.upper(F.trim(or_default("symbol", "UNKNOWN"))),
        F.upper(F.trim(or_default("exchange", "UNK"))),
        key,
    )


def trade_side() -> Column:
    taker = F.upper(F.coalesce(F.col("taker_side"), F.lit("")))
    buyer_mark = F.exists(
        F.coalesce(F.col("conditions"), F.array().cast("array<string>")),
        lambda code: F.coalesce(F.upper(code).contains("B"), F.lit(False)),
    )
    return F.when(taker == "B", "BUY").when(taker == "S", "SELL").when(buyer_mark, "BUY").otherwise(
        "SELL"
    )


def trade_risk(base: Column) -> Column:
    size = F.coalesce(F.col("size").cast("bigint"), F.lit(0))
    price = F.coalesce(F.col("price"), F.lit(0.0))
    tape = F.upper(F.coalesce(F.col("tape"), F.lit("")))
    total = (
        base
        + F.when(size >= 100, 10).otherwise(0)
        + F.when(price * size >= 10000, 15).otherwise(0)
        + F.when(tape.isin(KNOWN_TAPES), 0).otherwise(5)
    )
    return F.least(total, F.lit(100)).cast("int")


def map_trade_messages(
    messages: DataFrame,
    account: Column,
    customer: Column,
    country: Column,
    base_risk: Column,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Parsed trade messages (type ``t``) with their broker context as canonical stream events."""
    at = loaded_at if loaded_at is not None else F.current_timestamp()
    quantity = F.coalesce(F.col("size"), F.lit(0.0)).cast("decimal(18,6)")
    price = F.coalesce(F.col("price"), F.lit(0.0)).cast("decimal(18,6)")
    identity = trade_id()
    security = security_id(F.col("symbol"))
    return messages.filter(F.col("message_type") == "t").select(
        F.concat(F.lit("EVT-"), identity).alias("event_id"),
        F.lit("trade").alias("event_type"),
        security.alias("partition_key"),
        identity.alias("trade_id"),
        account.alias("account_id"),
        customer.alias("customer_id"),
        security.alias("security_id"),
        plain_decimal(quantity).alias("quantity"),
        plain_decimal(price).alias("price"),
        plain_decimal(quantity * price).alias("transaction_amount"),
        F.lit("USD").alias("currency_code"),
        trade_side().alias("side"),
        F.lit("POSTED").alias("transaction_status"),
        F.coalesce(
            F.try_to_timestamp(F.col("message_time")),
            F.when(or_default("message_time", "") == "", at),
        ).alias("event_timestamp"),
        at.alias("processing_timestamp"),
        country.alias("country_code"),
        trade_risk(base_risk).alias("risk_score"),
    )
