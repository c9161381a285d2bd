"""Reference feed: listings, security overviews and daily price series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import blank_to_null, col, or_default
from tidemark.sources.market_feed import security_id

# Keys of a daily series payload
SERIES_KEY = "Time Series (Daily)"
BAR_KEYS = {
    "open_price": "1. open",
    "high_price": "2. high",
    "low_price": "3. low",
    "close_price": "4. close",
}
VOLUME_KEY = "5. volume"
SERIES_PAYLOAD = f"symbol string, payload struct<`{SERIES_KEY}`: map<string, map<string, string>>>"


def asset_type(c: Column | str) -> Column:
    clean = F.upper(F.trim(F.coalesce(col(c), F.lit(""))))
    return F.when(clean.isin("", "STOCK"), "EQUITY").otherwise(
        F.replace(clean, F.lit(" "), F.lit("_"))
    )


def map_securities(listings: DataFrame) -> DataFrame:
    """Listing rows to canonical securities; rows without a symbol are left out."""
    ticker = F.upper(F.trim("symbol"))
    return listings.filter(ticker != "").select(
        security_id(F.col("symbol")).alias("security_id"),
        ticker.alias("ticker"),
        F.trim(F.coalesce(blank_to_null("name"), ticker)).alias("security_name"),
        asset_type("assetType").alias("security_type"),
        F.upper(F.trim(or_default("exchange", "UNKNOWN"))).alias("exchange_code"),
        F.lit("USD").alias("currency_code"),
    )


def number_text(c: Column) -> Column:
    """Numeric text, with 0 for null, empty and the word None."""
    return F.when(c.isNull() | c.isin("", "None"), "0").otherwise(c)


def map_overviews(overviews: DataFrame) -> DataFrame:
    """``overviews``: symbol and ``fields``, a map of provider field to text."""

    def field(name: str) -> Column:
        return F.try_element_at(F.col("fields"), F.lit(name))

    def text(name: str, default: str) -> Column:
        return or_default(field(name), default)

    def code(name: str, default: str) -> Column:
        return F.upper(F.trim(text(name, default)))

    ticker = F.upper(F.trim("symbol"))
    return overviews.filter(F.size("fields") > 0).select(
        security_id(F.col("symbol")).alias("security_id"),
        ticker.alias("ticker"),
        F.coalesce(blank_to_null(field("Name")), ticker).alias("security_name"),
        text("Description", "").alias("description"),
        code("Exchange", "UNKNOWN").alias("exchange_code"),
        code("Currency", "USD").alias("currency_code"),
        code("Country", "US").alias("country"),
        text("Sector", "UNKNOWN").alias("sector"),
        text("Industry", "UNKNOWN").alias("industry"),
        number_text(field("MarketCapitalization")).alias("market_cap"),
        number_text(field("PERatio")).alias("pe_ratio"),
        number_text(field("DividendYield")).alias("dividend_yield"),
        number_text(field("Beta")).alias("beta"),
        text("FiscalYearEnd", "").alias("fiscal_year_end"),
        text("LatestQuarter", "").alias("latest_quarter"),
    )


def map_daily_prices(series: DataFrame, source_system: str = "alpha_vantage") -> DataFrame:
    """``series``: symbol and payload (``SERIES_PAYLOAD``). One row per day and symbol.

    Rows come unsorted; order them where they are shown, not in the transform.
    """
    days = series.select("symbol", F.explode(F.col(f"payload.`{SERIES_KEY}`")).alias("day", "bar"))

    def value(key: str) -> Column:
        return F.try_element_at(F.col("bar"), F.lit(key))

    return days.filter(F.col("bar").isNotNull()).select(
        security_id(F.col("symbol")).alias("security_id"),
        F.upper(F.trim("symbol")).alias("ticker"),
        F.col("day").alias("price_date"),
        *[number_text(value(key)).alias(name) for name, key in BAR_KEYS.items()],
        or_default(value(VOLUME_KEY), "0").cast("bigint").alias("volume"),
        F.lit(source_system).alias("source_system"),
    )
