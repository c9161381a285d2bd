"""Stream events: parse, tag, route and aggregate. The same functions serve batch frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalars import money
from tidemark.operators.clean import payment_rule, sure, trade_rule, transaction_rule
from tidemark.schemas import (
    CANONICAL, CURRENCIES, RISK_RANGE, STREAM_EVENT, STREAM_OPTIONAL, TRANSACTION_STATUSES,
)

CORRUPT = "_corrupt_record"
_PAYLOAD = T.StructType([*STREAM_EVENT.fields, T.StructField(CORRUPT, T.StringType())])

# Stream timing
WATERMARK = "10 minutes"
TRIGGER = "30 seconds"


def parse_envelope(df: DataFrame) -> DataFrame:
    """Envelope rows to event rows with ``parse_failed``.

    ``from_json`` gives a row of nulls for broken text, so the flag comes from the corrupt-record
    field. Envelope columns get a prefix, because the payload has a partition_key of its own.
    The parsed struct goes through ``inline``: later filters on its fields stay above it, where
    pushing them down would parse every payload once more per filter.
    """
    text = F.col("data").cast("string")
    parsed = F.from_json(
        text, _PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    rows = df.select(
        F.col("partitionKey").alias("envelope_partition_key"),
        F.col("sequenceNumber").alias("sequence_number"),
        F.col("approximateArrivalTimestamp").alias("arrival_timestamp"),
        text.alias("raw_data"),
        F.inline_outer(F.array(parsed)),
    )
    failed = F.col("raw_data").isNull() | F.col(CORRUPT).isNotNull()
    return rows.select(
        "envelope_partition_key", "sequence_number", "arrival_timestamp", "raw_data",
        failed.alias("parse_failed"), *STREAM_EVENT.fieldNames(),
    )


ENVELOPE_COLUMNS = [
    "envelope_partition_key", "sequence_number", "arrival_timestamp", "raw_data", "parse_failed",
]


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter("parse_failed").select(*ENVELOPE_COLUMNS[:4])


def late_events(parsed: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Events that happened more than the delay before they arrived: a stateless side output, so
    rows the watermark may drop stay on record."""
    late = F.col("event_timestamp") < F.col("arrival_timestamp") - F.expr(f"interval {delay}")
    return parsed.filter(~F.col("parse_failed") & sure(late))


def with_optional_columns(df: DataFrame) -> DataFrame:
    absent = [c for c in STREAM_OPTIONAL if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def with_stream_metadata(
    df: DataFrame, run_at: Column | None = None, skip: list[str] = ()
) -> DataFrame:
    """Add load time, load day and ``raw_payload``, the row as JSON (without the ``skip`` columns)."""
    at = run_at if run_at is not None else F.current_timestamp()
    payload = F.to_json(F.struct(*[c for c in df.columns if c not in skip]))
    return df.withColumns(
        {"ingestion_timestamp": at, "processing_date": F.to_date(at), "raw_payload": payload}
    )


def tag_events(df: DataFrame) -> DataFrame:
    """Add ``rejection_reason``: null for a valid event of any kind, else the first broken rule."""
    df = with_optional_columns(df)
    amount = money("transaction_amount")
    currency_ok = F.col("currency_code").isin(CURRENCIES)
    risk_ok = F.col("risk_score").between(*RISK_RANGE)
    kind = F.col("event_type")
    status_ok = F.col("transaction_status").isin(TRANSACTION_STATUSES)
    record_ok = (
        ((kind == "transaction") & F.col("transaction_id").isNotNull() & transaction_rule() & status_ok)
        | ((kind == "payment") & F.col("payment_id").isNotNull() & payment_rule())
        | ((kind == "trade") & F.col("trade_id").isNotNull() & trade_rule() & status_ok)
    )
    valid = currency_ok & risk_ok & (amount >= 0) & record_ok
    reason = (
        F.when(sure(valid), F.lit(None).cast("string"))
        .when(~currency_ok, "invalid_currency")
        .when(~risk_ok, "invalid_risk_score")
        .when(amount < 0, "negative_amount")
        .when(kind == "transaction", "invalid_transaction_record")
        .when(kind == "payment", "invalid_payment_record")
        .otherwise("invalid_trade_record")
    )
    return df.withColumn("rejection_reason", reason)


# Columns of a tagged event as the streaming job stores it.
STORED_COLUMNS = [
    "sequence_number", *STREAM_EVENT.fieldNames(), "ingestion_timestamp", "processing_date",
    "raw_payload", "rejection_reason",
]


def stored_schema() -> T.StructType:
    """Schema of the stored events, with the columns that place them."""
    kinds = {f.name: f.dataType for f in STREAM_EVENT.fields} | {
        "ingestion_timestamp": T.TimestampType(), "processing_date": T.DateType()}
    names = [*STORED_COLUMNS, "identity", "event_month", "route", "batch_key"]
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])


EVENT_KINDS = {"transaction": "transactions", "payment": "payments", "trade": "trades"}


def route(events: DataFrame, kind: str, also: list[str] = ()) -> DataFrame:
    """Events of one kind as rows of their canonical table, with typed money."""
    dataset = EVENT_KINDS[kind]
    amounts = {"transaction_amount", "quantity", "price"}
    columns = [
        money(c).alias(c) if c in amounts else F.col(c) for c in CANONICAL[dataset].fieldNames()
    ]
    return (
        with_optional_columns(events)
        .filter(F.col("event_type") == kind)
        .select("event_id", *columns, "ingestion_timestamp", "processing_date", *also)
    )


def prepare(envelopes: DataFrame, run_at: Column | None = None, delay: str = WATERMARK) -> DataFrame:
    """Parsed, watermarked events without repeats of an event_id.

    The state of an id is dropped once the watermark passes it, so state is bounded by the delay; a
    repeat that comes later than the delay is let through again. An event without an id is a copy of
    nothing: its record's sequence number takes the id's place. The payload text is made of the rows that
    stay, behind the shuffle: it is not sent, and the tasks of the state share its work.
    """
    parsed = parse_envelope(envelopes).filter("not parse_failed")
    sequence = F.concat(F.lit("sequence:"), F.col("sequence_number"))
    good = parsed.withColumn("_identity", F.coalesce("event_id", sequence))
    once = (
        good.drop(*ENVELOPE_COLUMNS[3:])
        .withWatermark("event_timestamp", delay)
        .dropDuplicatesWithinWatermark(["_identity"])
        .drop("_identity")
    )
    return with_stream_metadata(once, run_at)


def minute_windows(trades: DataFrame) -> DataFrame:
    """One-minute tumbling windows over a watermarked stream (or a batch) of typed trades."""
    window = F.window("event_timestamp", "1 minute")
    return (
        trades.groupBy("security_id", "currency_code", "side", window.alias("_w"))
        .agg(
            F.count("*").alias("trade_count"),
            F.sum("quantity").cast("decimal(18,2)").alias("total_quantity"),
            F.sum("transaction_amount").cast("decimal(18,2)").alias("total_transaction_amount"),
            F.avg("price").cast("decimal(18,2)").alias("avg_trade_price"),
            F.max("risk_score").alias("max_risk_score"),
        )
        .withColumn("trade_minute", F.col("_w.start"))
        .drop("_w")
    )
