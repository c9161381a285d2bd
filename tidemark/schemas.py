"""Canonical tables, value domains and data policies."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
}


def struct(spec: str) -> T.StructType:
    """Build a StructType from ``"name type, name! type"``; ``!`` marks a non-nullable field."""
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name.rstrip("!"), _TYPES[kind], not name.endswith("!")))
    return T.StructType(fields)


MONEY = "decimal(18,2)"

# ---- Fixed values: domains -------------------------------------------------------------------
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "AUD"]
INVALID_CURRENCY = "ZZZ"
TRANSACTION_STATUSES = ["PENDING", "POSTED", "FAILED", "REVERSED"]
TRANSACTION_TYPES = ["DEBIT", "CREDIT", "FEE", "REFUND", "WIRE", "ACH"]
PAYMENT_STATUSES = ["PENDING", "SETTLED", "FAILED", "CANCELLED"]
TRADE_SIDES = ["BUY", "SELL"]
COUNTRIES = ["US", "GB", "DE", "CA", "AU", "JP"]
MERCHANT_CATEGORIES = [
    "GROCERY", "TRAVEL", "UTILITIES", "DINING", "PAYROLL", "BROKERAGE", "HEALTHCARE",
]
SECURITY_TYPES = ["EQUITY", "ETF", "BOND", "OPTION"]
ACCOUNT_TYPES = ["CHECKING", "SAVINGS", "BROKERAGE"]
ACCOUNT_STATUSES = ["OPEN", "SUSPENDED", "CLOSED"]
RISK_RANGE = (0, 100)

# ---- Fixed values: the seven canonical tables (money arrives as text) -------------------------
CANONICAL = {
    "customers": struct(
        "customer_id! string, full_name string, email string, country_code string, "
        "risk_score int, created_at timestamp"
    ),
    "accounts": struct(
        "account_id! string, customer_id! string, account_type string, currency_code string, "
        "current_balance string, opened_at timestamp, status string"
    ),
    "securities": struct(
        "security_id! string, ticker string, security_name string, security_type string, "
        "exchange_code string, currency_code string"
    ),
    "transactions": struct(
        "transaction_id string, account_id string, customer_id string, transaction_type string, "
        "transaction_amount string, currency_code string, transaction_status string, "
        "event_timestamp timestamp, processing_timestamp timestamp, merchant_category string, "
        "country_code string, risk_score int"
    ),
    "payments": struct(
        "payment_id string, account_id string, customer_id string, transaction_amount string, "
        "currency_code string, transaction_status string, event_timestamp timestamp, "
        "processing_timestamp timestamp, counterparty_account_id string, country_code string, "
        "risk_score int"
    ),
    "trades": struct(
        "trade_id string, account_id string, customer_id string, security_id string, "
        "quantity string, price string, transaction_amount string, currency_code string, "
        "side string, transaction_status string, event_timestamp timestamp, "
        "processing_timestamp timestamp, country_code string, risk_score int"
    ),
    "daily_account_balances": struct(
        "balance_id string, account_id string, customer_id string, balance_date timestamp, "
        "opening_balance string, closing_balance string, currency_code string"
    ),
}

KEYS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "securities": "security_id",
    "transactions": "transaction_id",
    "payments": "payment_id",
    "trades": "trade_id",
    "daily_account_balances": "balance_id",
}

MONEY_COLUMNS = {
    "accounts": ["current_balance"],
    "transactions": ["transaction_amount"],
    "payments": ["transaction_amount"],
    "trades": ["quantity", "price", "transaction_amount"],
    "daily_account_balances": ["opening_balance", "closing_balance"],
}

# Gold table built from each canonical table.
GOLD_TABLES = {
    "customers": "dim_customer",
    "accounts": "dim_account",
    "securities": "dim_security",
    "transactions": "fact_transaction",
    "payments": "fact_payment",
    "trades": "fact_trade",
    "daily_account_balances": "fact_daily_account_balance",
}

LOAD_METADATA = ["ingestion_timestamp", "source_file", "processing_date"]

# ---- Fixed values: stream event (union of the three event kinds) and its envelope -------------
STREAM_EVENT = struct(
    "event_id string, event_type string, partition_key string, transaction_id string, "
    "payment_id string, trade_id string, account_id string, customer_id string, "
    "security_id string, transaction_type string, transaction_amount string, "
    "currency_code string, transaction_status string, event_timestamp timestamp, "
    "processing_timestamp timestamp, merchant_category string, country_code string, "
    "risk_score int, counterparty_account_id string, quantity string, price string, "
    "side string, duplicate_flag boolean, late_arrival_flag boolean"
)
STREAM_ENVELOPE = struct(
    "partitionKey string, sequenceNumber string, approximateArrivalTimestamp timestamp, data binary"
)
STREAM_OPTIONAL = [
    "transaction_id", "transaction_type", "payment_id", "merchant_category",
    "counterparty_account_id",
]

# ---- Fixed values: canonical contract ---------------------------------------------------------
# Logical type of every canonical field that is not text, and the fields that may be derived.
CONTRACT_TYPES = {
    "risk_score": "integer",
    "created_at": "datetime", "opened_at": "datetime", "balance_date": "datetime",
    "event_timestamp": "datetime", "processing_timestamp": "datetime",
    "current_balance": "decimal", "transaction_amount": "decimal", "quantity": "decimal",
    "price": "decimal", "opening_balance": "decimal", "closing_balance": "decimal",
}
CONTRACT_DERIVABLE = {
    "customers": ["country_code", "risk_score", "created_at"],
    "accounts": ["account_type", "currency_code", "current_balance", "opened_at", "status"],
    "transactions": [
        "transaction_type", "currency_code", "transaction_status", "processing_timestamp",
        "merchant_category", "country_code", "risk_score",
    ],
    "payments": [
        "currency_code", "transaction_status", "processing_timestamp",
        "counterparty_account_id", "country_code", "risk_score",
    ],
    "securities": ["security_name", "security_type", "exchange_code", "currency_code"],
    "trades": [
        "transaction_amount", "currency_code", "side", "transaction_status",
        "processing_timestamp", "country_code", "risk_score",
    ],
    "daily_account_balances": ["opening_balance", "currency_code"],
}
LINEAGE_FIELDS = [
    "source_system", "source_mode", "source_endpoint_or_file", "source_record_id",
    "ingestion_timestamp", "processing_timestamp", "ingestion_id", "raw_payload_checksum",
    "raw_payload_location", "schema_version", "mapping_version",
]

# ---- Fixed values: sensitive fields (field, classification, treatment) -------------------------
SENSITIVE_FIELDS = [
    ("full_name", "PII", "hash_or_mask_in_logs"),
    ("email", "PII", "mask_in_logs_hash_for_exports"),
    ("customer_id", "Confidential", "hash_when_shared_outside_platform"),
    ("account_id", "Confidential", "hash_when_shared_outside_platform"),
]


def contract(entity: str) -> list[tuple[str, str, bool]]:
    """(field, logical type, derivable) for every field of a canonical entity."""
    if entity not in CANONICAL:
        raise KeyError(f"unknown canonical entity: {entity}")
    derivable = set(CONTRACT_DERIVABLE[entity])
    return [
        (f.name, CONTRACT_TYPES.get(f.name, "string"), f.name in derivable)
        for f in CANONICAL[entity].fields
    ]
