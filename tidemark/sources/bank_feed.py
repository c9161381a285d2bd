"""Bank provider payloads (accounts and paged transactions) to canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import blank_to_null, or_default, plain_decimal

# ---- Fixed values ------------------------------------------------------------------------------
ACCOUNT_TYPE_MAP = {
    "depository": "CHECKING",
    "credit": "CHECKING",
    "loan": "CHECKING",
    "investment": "BROKERAGE",
    "brokerage": "BROKERAGE",
}
CREDIT_WORDS = ["PAYROLL", "REFUND", "REVERSAL", "REWARD", "REIMBURSEMENT"]
WIRE_WORDS = ["TRANSFER", "WIRE", "ACH"]
FEE_WORDS = ["FEE", "SERVICE CHARGE"]
# Checked in this order; the first word found decides.
MERCHANT_WORDS = {
    "PAYROLL": "PAYROLL",
    "GROCERY": "GROCERY",
    "COMMISSARY": "GROCERY",
    "FUEL": "TRAVEL",
    "AIRLINE": "TRAVEL",
    "TRAVEL": "TRAVEL",
    "UTILITY": "UTILITIES",
    "WATER": "UTILITIES",
    "ELECTRIC": "UTILITIES",
    "DINING": "DINING",
    "CAFE": "DINING",
    "HEALTH": "HEALTHCARE",
    "CLINIC": "HEALTHCARE",
    "BROKERAGE": "BROKERAGE",
    "TRANSFER": "BROKERAGE",
}

ACCOUNT_PAYLOAD = (
    "struct<account_id: string, type: string, subtype: string, "
    "balances: struct<current: string, iso_currency_code: string>>"
)
TRANSACTION_PAYLOAD = (
    "struct<transaction_id: string, account_id: string, amount: double, "
    "iso_currency_code: string, pending: boolean, authorized_datetime: string, "
    "datetime: string, date: string, merchant_name: string, name: string, "
    "original_description: string, personal_finance_category: struct<primary: string>, "
    "location: struct<country: string>>"
)
BUNDLE_PAYLOAD = (
    f"customer_id string, country_code string, accounts array<{ACCOUNT_PAYLOAD}>, "
    f"responses array<struct<added: array<{TRANSACTION_PAYLOAD}>>>"
)


def _has_any(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(words))


def search_text() -> Column:
    """Merchant, name, description and category in upper case; absent parts leave their space."""
    parts = ["merchant_name", "name", "original_description", "personal_finance_category.primary"]
    return F.upper(F.concat_ws(" ", *[F.coalesce(F.col(p), F.lit("")) for p in parts]))


def transaction_type() -> Column:
    category = F.upper(F.coalesce(F.col("personal_finance_category.primary"), F.lit("")))
    text = search_text()
    return (
        F.when(category.contains("PAYROLL"), "CREDIT")
        .when(_has_any(category, ["TRANSFER", "LOAN"]), "WIRE")
        .when(_has_any(text, CREDIT_WORDS), "CREDIT")
        .when(_has_any(text, WIRE_WORDS), "WIRE")
        .when(_has_any(text, FEE_WORDS), "FEE")
        .when(F.col("amount") < 0, "CREDIT")
        .otherwise("DEBIT")
    )


def transaction_risk() -> Column:
    size = F.abs(F.coalesce(F.col("amount"), F.lit(0.0)))
    country = F.col("location.country")
    extra = [
        F.when(size > 1000, 20).otherwise(0),
        F.when(size > 5000, 20).otherwise(0),
        F.when(F.col("pending"), 10).otherwise(0),
        F.when(country != "US", 15).otherwise(0),
    ]
    return F.least(sum(extra, F.lit(20)), F.lit(100)).cast("int")


def merchant_category() -> Column:
    text = search_text()
    by_word = F.lit(None).cast("string")
    for word, category in reversed(MERCHANT_WORDS.items()):
        by_word = F.when(text.contains(word), category).otherwise(by_word)
    return F.coalesce(
        F.upper(blank_to_null("personal_finance_category.primary")),
        by_word,
        F.upper(blank_to_null("merchant_name")),
        F.upper(blank_to_null("name")),
        F.lit("UNKNOWN"),
    )


def event_time(loaded_at: Column) -> Column:
    """Authorized time, else time, else date (midnight UTC), else the load time."""
    raw = F.coalesce(*[blank_to_null(c) for c in ("authorized_datetime", "datetime", "date")])
    full = F.when(raw.contains("T"), raw).otherwise(F.concat(raw, F.lit("T00:00:00Z")))
    return F.coalesce(F.try_to_timestamp(full), F.when(raw.isNull(), loaded_at))


def map_accounts(payload: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """``payload``: customer_id plus the account record's fields."""
    at = loaded_at if loaded_at is not None else F.current_timestamp()
    kinds = F.create_map(*[F.lit(v) for pair in ACCOUNT_TYPE_MAP.items() for v in pair])
    by_type = F.coalesce(
        F.try_element_at(kinds, F.lower(F.coalesce(F.col("type"), F.lit("")))), F.lit("CHECKING")
    )
    savings = F.lower(F.coalesce(F.col("subtype"), F.lit(""))).contains("savings")
    return payload.select(
        "account_id",
        "customer_id",
        F.when(savings, "SAVINGS").otherwise(by_type).alias("account_type"),
        or_default("balances.iso_currency_code", "USD").alias("currency_code"),
        F.coalesce(F.col("balances.current").cast("string"), F.lit("0")).alias("current_balance"),
        at.alias("opened_at"),
        F.lit("OPEN").alias("status"),
    )


def map_transactions(
    payload: DataFrame, accounts: DataFrame | None = None, loaded_at: Column | None = None
) -> DataFrame:
    """``payload``: customer_id and country_code of the context plus the transaction's fields.

    ``accounts`` (account_id, customer_id) overrides the context's customer. An account listed more
    than once counts once, with its least customer. Spark broadcasts the list when small and splits
    hot accounts when not.
    """
    at = loaded_at if loaded_at is not None else F.current_timestamp()
    owner = F.col("customer_id")
    if accounts is not None:
        known = accounts.groupBy("account_id").agg(F.min("customer_id").alias("_owner"))
        payload = payload.join(known, "account_id", "left")
        owner = F.coalesce(F.col("_owner"), owner)
    return payload.select(
        "transaction_id",
        "account_id",
        owner.alias("customer_id"),
        transaction_type().alias("transaction_type"),
        plain_decimal(F.abs(F.coalesce(F.col("amount"), F.lit(0.0)))).alias("transaction_amount"),
        or_default("iso_currency_code", "USD").alias("currency_code"),
        F.when(F.col("pending"), "PENDING").otherwise("POSTED").alias("transaction_status"),
        event_time(at).alias("event_timestamp"),
        at.alias("processing_timestamp"),
        merchant_category().alias("merchant_category"),
        F.coalesce(blank_to_null("location.country"), F.col("country_code")).alias("country_code"),
        transaction_risk().alias("risk_score"),
    )


def bundle_accounts(bundles: DataFrame) -> DataFrame:
    return bundles.select("customer_id", F.inline("accounts"))


def bundle_transactions(bundles: DataFrame) -> DataFrame:
    """Every record of ``responses[].added[]``, with the customer context of its bundle."""
    pages = bundles.select("customer_id", "country_code", F.explode("responses").alias("page"))
    return pages.select("customer_id", "country_code", F.inline("page.added"))


def map_bundles(bundles: DataFrame, loaded_at: Column | None = None) -> dict[str, DataFrame]:
    """Accounts and transactions of many customers' bundles.

    A bundle's transactions belong to the customer it was fetched for, whatever other bundles say
    about the account, so nothing is joined.
    """
    return {
        "accounts": map_accounts(bundle_accounts(bundles), loaded_at),
        "transactions": map_transactions(bundle_transactions(bundles), loaded_at=loaded_at),
    }


def lineage(
    bundles: DataFrame,
    source_system: str,
    endpoint: str,
    record_id: Column,
    loaded_at: Column | None = None,
    mode: str = "batch",
) -> DataFrame:
    """The lineage columns of a load; the checksum covers the whole payload as JSON."""
    at = loaded_at if loaded_at is not None else F.current_timestamp()
    stamp = F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")
    return bundles.select(
        F.lit(source_system).alias("source_system"),
        F.lit(mode).alias("source_mode"),
        F.lit(endpoint).alias("source_endpoint_or_file"),
        record_id.alias("source_record_id"),
        at.alias("ingestion_timestamp"),
        at.alias("processing_timestamp"),
        F.concat_ws("-", F.lit(source_system), record_id, stamp).alias("ingestion_id"),
        F.sha2(F.to_json(F.struct(*sorted(bundles.columns))), 256).alias("raw_payload_checksum"),
        F.lit(f"raw/{source_system}/").alias("raw_payload_location"),
        F.lit(1).alias("schema_version"),
        F.lit(1).alias("mapping_version"),
    )
