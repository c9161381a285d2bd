"""Declarative source-to-canonical mappings and the contract check on their output."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import blank_to_null, money, or_default
from tidemark.schemas import CANONICAL, contract
from tidemark.sources import bank_feed, listing_feed, market_feed


@dataclass(frozen=True)
class Context:
    """Values a load injects: its time and, for market data, the broker's account."""

    loaded_at: Column
    account_id: Column | None = None
    customer_id: Column | None = None
    country_code: Column | None = None
    base_risk: Column | None = None


Transform = Callable[[Context, list[Column]], Column]
TRANSFORMS: dict[str, Transform] = {}


def transform(name: str):
    def register(fn: Transform) -> Transform:
        TRANSFORMS[name] = fn
        return fn

    return register


def _simple(name: str, fn: Callable[..., Column]) -> None:
    TRANSFORMS[name] = lambda ctx, cols: fn(*cols)


_simple("direct", lambda c: c)
_simple("decimal_cast", lambda c: money(c).cast("string"))
_simple("absolute_decimal_cast", lambda c: F.abs(money(c)).cast("string"))
_simple("fallback_to_usd_if_missing", lambda c: or_default(c, "USD"))
_simple("derive_usd_for_us_listing", lambda c: F.lit("USD"))
_simple("boolean_to_pending_posted", lambda c: F.when(c, "PENDING").otherwise("POSTED"))
_simple("posted", lambda *c: F.lit("POSTED"))
_simple("normalize_asset_type", listing_feed.asset_type)
_simple("resolve_symbol_to_security_id", market_feed.security_id)
_simple("multiply_quantity_by_price", lambda q, p: money(
    q.try_cast("decimal(18,6)") * p.try_cast("decimal(18,6)")).cast("string"))
_simple("normalize_buy_sell", lambda c: F.when(F.upper(c).isin("B", "BUY"), "BUY").when(
    F.upper(c).isin("S", "SELL"), "SELL").otherwise(F.upper(c)))
_simple("default_open", lambda c: F.upper(or_default(c, "OPEN")))
_simple("prefix_with_cik", lambda c: F.concat(F.lit("SEC-CIK-"), c.cast("string")))
_simple("placeholder_email", lambda c: or_default(c, "investor-relations@example.com"))
_simple("normalize_country_code", lambda c: F.upper(F.trim(or_default(c, "US"))))
_simple("account_type", lambda kind: F.coalesce(
    *[F.when(F.lower(kind) == k, v) for k, v in bank_feed.ACCOUNT_TYPE_MAP.items()],
    F.lit("CHECKING")))


@transform("ingestion_time")
def _ingestion_time(ctx, cols):
    return ctx.loaded_at


@transform("time_or_ingestion")
def _time_or_ingestion(ctx, cols):
    return F.coalesce(F.try_to_timestamp(cols[0].cast("string")), ctx.loaded_at)


@transform("fallback_to_date_midnight_utc")
def _bank_time(ctx, cols):
    return bank_feed.event_time(ctx.loaded_at)


@transform("category_to_transaction_type")
def _bank_type(ctx, cols):
    return bank_feed.transaction_type()


@transform("merchant_category")
def _bank_category(ctx, cols):
    return bank_feed.merchant_category()


@transform("transaction_risk")
def _bank_risk(ctx, cols):
    return bank_feed.transaction_risk()


@transform("fallback_to_account_country")
def _country(ctx, cols):
    fallback = ctx.country_code if ctx.country_code is not None else F.lit("US")
    return F.coalesce(blank_to_null(cols[0]), fallback)


@transform("broker_account")
def _broker_account(ctx, cols):
    return ctx.account_id


@transform("broker_customer")
def _broker_customer(ctx, cols):
    return ctx.customer_id


# Exchanges by the country they are in. The feed's one-letter codes are US venues.
EXCHANGES = {
    "US": ["NYSE", "NASDAQ", "ARCA", "AMEX", "CBOE", "BATS", "IEX", "NYSE ARCA", "NYSE MKT"],
    "GB": ["LSE", "LON"],
    "DE": ["XETRA", "FRA", "ETR"],
    "CA": ["TSX", "TSXV"],
    "AU": ["ASX"],
    "JP": ["TSE", "TYO", "JPX"],
}


@transform("country_of_exchange")
def _country_of_exchange(ctx, cols):
    """The country of a known exchange, else the account's country."""
    code = F.upper(F.trim(cols[0]))
    found = F.when(code.rlike("^[A-Z]$"), "US")
    for country, names in EXCHANGES.items():
        found = found.when(code.isin(names), country)
    return F.coalesce(found, ctx.country_code) if ctx.country_code is not None else found


@transform("trade_risk")
def _trade_risk(ctx, cols):
    return market_feed.trade_risk(ctx.base_risk)


@transform("public_entity_risk")
def _public_risk(ctx, cols):
    return F.coalesce(cols[0].try_cast("int"), ctx.base_risk).cast("int")


# ---- Fixed values: the four provider mappings: target <- (source fields, transform) ------------
SPECS: dict[str, dict[str, dict[str, tuple[str, str]]]] = {
    "bank": {
        "accounts": {
            "account_id": ("account_id", "direct"),
            "customer_id": ("owner.customer_id", "direct"),
            "account_type": ("type", "account_type"),
            "current_balance": ("balances.current", "decimal_cast"),
            "currency_code": ("balances.iso_currency_code", "fallback_to_usd_if_missing"),
            "opened_at": ("created_at", "time_or_ingestion"),
            "status": ("status", "default_open"),
        },
        "transactions": {
            "transaction_id": ("transaction_id", "direct"),
            "account_id": ("account_id", "direct"),
            "customer_id": ("owner.customer_id", "direct"),
            "transaction_type": (
                "personal_finance_category.primary", "category_to_transaction_type"),
            "transaction_amount": ("amount", "absolute_decimal_cast"),
            "currency_code": ("iso_currency_code", "fallback_to_usd_if_missing"),
            "transaction_status": ("pending", "boolean_to_pending_posted"),
            "event_timestamp": ("authorized_datetime", "fallback_to_date_midnight_utc"),
            "processing_timestamp": ("", "ingestion_time"),
            "merchant_category": ("merchant_name", "merchant_category"),
            "country_code": ("location.country", "fallback_to_account_country"),
            "risk_score": ("", "transaction_risk"),
        },
    },
    "market": {
        "securities": {
            "security_id": ("id", "direct"),
            "ticker": ("symbol", "direct"),
            "security_name": ("name", "direct"),
            "security_type": ("class", "normalize_asset_type"),
            "exchange_code": ("exchange", "direct"),
            "currency_code": ("currency", "fallback_to_usd_if_missing"),
        },
        "trades": {
            "trade_id": ("id", "direct"),
            "account_id": ("", "broker_account"),
            "customer_id": ("", "broker_customer"),
            "security_id": ("symbol", "resolve_symbol_to_security_id"),
            "quantity": ("size", "decimal_cast"),
            "price": ("price", "decimal_cast"),
            "transaction_amount": ("size,price", "multiply_quantity_by_price"),
            "currency_code": ("currency", "fallback_to_usd_if_missing"),
            "side": ("side", "normalize_buy_sell"),
            "transaction_status": ("trade_condition", "posted"),
            "event_timestamp": ("timestamp", "time_or_ingestion"),
            "processing_timestamp": ("", "ingestion_time"),
            "country_code": ("exchange", "country_of_exchange"),
            "risk_score": ("", "trade_risk"),
        },
    },
    "listing": {
        "securities": {
            "security_id": ("symbol", "resolve_symbol_to_security_id"),
            "ticker": ("symbol", "direct"),
            "security_name": ("name", "direct"),
            "security_type": ("assetType", "normalize_asset_type"),
            "exchange_code": ("exchange", "direct"),
            "currency_code": ("assetType", "derive_usd_for_us_listing"),
        },
    },
    "filings": {
        "customers": {
            "customer_id": ("cik", "prefix_with_cik"),
            "full_name": ("entityName", "direct"),
            "email": ("investorRelationsEmail", "placeholder_email"),
            "country_code": ("country", "normalize_country_code"),
            "risk_score": ("risk_model.public_filer_score", "public_entity_risk"),
            "created_at": ("created_at", "time_or_ingestion"),
        },
    },
}


def apply_mapping(df: DataFrame, provider: str, entity: str, context: Context) -> DataFrame:
    """Project source rows to a canonical entity through its declared mapping."""
    columns = []
    for target, (source, name) in SPECS[provider][entity].items():
        inputs = [F.col(s) for s in source.split(",")] if source else []
        value = TRANSFORMS[name](context, inputs)
        kind = CANONICAL[entity][target].dataType if target in CANONICAL[entity].names else None
        columns.append((value.cast(kind) if kind is not None else value).alias(target))
    return df.select(columns)


def mapping_issues(provider: str, specs: dict | None = None) -> list[tuple[str, str, str, str]]:
    """(provider, entity, field, issue) for a mapping that breaks the canonical contract."""
    out = []
    for entity, fields in (specs or SPECS[provider]).items():
        if entity not in CANONICAL:
            out.append((provider, entity, "*", "unknown canonical entity"))
            continue
        known = {name: derivable for name, _, derivable in contract(entity)}
        for name, derivable in known.items():
            if name not in fields and not derivable:
                issue = "required field missing and derivation not allowed"
                out.append((provider, entity, name, issue))
        for name in fields:
            if name not in known:
                out.append((provider, entity, name, "mapped target field not in canonical contract"))
    return out


_CASTS = {"integer": "int", "decimal": "decimal(18,2)", "datetime": "timestamp"}


def contract_issues(df: DataFrame, entity: str) -> DataFrame:
    """Check rows against the contract in one pass: (field, issue, row_count), issues only.

    A missing column counts for every row; a derivable field may be absent or null.
    """
    present = set(df.columns)
    aggregates, cells = [F.count("*").alias("_rows")], []

    def cell(field: str, issue: str, n: Column) -> Column:
        return F.struct(
            F.lit(field).alias("field_name"), F.lit(issue).alias("issue"), n.alias("row_count")
        )

    for name, kind, derivable in contract(entity):
        if name not in present:
            if not derivable:
                issue = "required field missing and derivation not allowed"
                cells.append(cell(name, issue, F.greatest(F.col("_rows"), F.lit(1))))
            continue
        if not derivable:
            aggregates.append(F.count_if(F.col(name).isNull()).alias(f"_null_{name}"))
            cells.append(cell(name, "null in required field", F.col(f"_null_{name}")))
        if kind in _CASTS:
            text = F.col(name).cast("string")
            bad = text.isNotNull() & text.try_cast(_CASTS[kind]).isNull()
            aggregates.append(F.count_if(bad).alias(f"_bad_{name}"))
            cells.append(cell(name, f"not a {kind}", F.col(f"_bad_{name}")))
    known = {name for name, _, _ in contract(entity)}
    for name in sorted(present - known):
        cells.append(cell(name, "field not in canonical contract", F.col("_rows")))
    return df.agg(*aggregates).select(F.inline(F.array(*cells))).filter("row_count > 0")
