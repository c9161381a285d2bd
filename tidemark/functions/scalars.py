"""Scalar helpers: money, keys, hashing, masking, arithmetic, geography."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import MONEY, SENSITIVE_FIELDS

# Fixed values
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
EARTH_RADIUS_MI = 3961
KM_PER_MI = 1.60934


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def or_default(c: Column | str, default: str) -> Column:
    """The text, or ``default`` where it is null or empty."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def plain_decimal(c: Column) -> Column:
    """A number as decimal text: at least two digits behind the point, and all others up to twelve."""
    return F.regexp_replace(c.cast("decimal(38,12)").cast("string"), r"(\.\d\d\d*?)0+$", "$1")


def money(c: Column | str) -> Column:
    """Text or number to decimal(18,2); text that is no number gives null instead of an error."""
    return col(c).try_cast(MONEY)


def cents_to_amount(c: Column | str) -> Column:
    return col(c) / F.lit(100.0)


def salted_hash(c: Column | str, salt: str) -> Column:
    """SHA-256 of ``salt:value``. The salt belongs to the deployment, so it has no default."""
    return F.sha2(F.concat(F.lit(salt + ":"), col(c)), 256)


def mask_email(c: Column | str) -> Column:
    """Keep the first and last letter before the first ``@``; short names are fully starred."""
    text = col(c)
    at = F.instr(text, "@")
    local = F.substring(text, F.lit(1), at - 1)
    domain = F.substring(text, at + 1, F.length(text))
    size = F.length(local)
    starred = F.when(size <= 2, F.repeat(F.lit("*"), size)).otherwise(
        F.concat(F.left(local, F.lit(1)), F.repeat(F.lit("*"), size - 2), F.right(local, F.lit(1)))
    )
    return F.when(text.isNull(), None).when((at == 0) | (domain == ""), F.lit("***")).otherwise(
        F.concat(starred, F.lit("@"), domain)
    )


def protect(df: DataFrame, salt: str, purpose: str = "logs") -> DataFrame:
    """Apply the sensitive-field policy: mask for ``logs``, hash for ``exports``."""
    if purpose not in ("logs", "exports"):
        raise ValueError("purpose must be 'logs' or 'exports'")
    changes = {}
    for field, _, treatment in SENSITIVE_FIELDS:
        if field not in df.columns:
            continue
        if field == "email" and purpose == "logs":
            changes[field] = mask_email(field)
        elif purpose == "exports" or treatment == "hash_or_mask_in_logs":
            changes[field] = salted_hash(field, salt)
    return df.withColumns(changes) if changes else df


def surrogate_key(*fields: Column | str, nulls_as_empty: bool = False) -> Column:
    filler = F.lit("" if nulls_as_empty else SURROGATE_NULL)
    return F.md5(F.concat_ws("-", *[F.coalesce(col(f).cast("string"), filler) for f in fields]))


def safe_add(*fields: Column | str) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(col(f), F.lit(0)) for f in fields])


def safe_subtract(*fields: Column | str) -> Column:
    return reduce(lambda a, b: a - b, [F.coalesce(col(f), F.lit(0)) for f in fields])


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    return F.try_divide(col(numerator), col(denominator))


def width_bucket(value: Column | str, low, high, buckets: int) -> Column:
    """Histogram bucket 1..n, n+1 above the range; a value on a bucket edge moves up by one.

    This is the portable formula, which differs from Spark's own ``width_bucket`` far below ``low``,
    on multiples of the bin above ``high`` and where ``low`` is no multiple of the bin.
    """
    v, low, high = col(value), F.lit(low), F.lit(high)
    size = (high - low) / F.lit(buckets)
    on_edge = F.when(
        F.try_mod(v.try_cast("decimal(28,6)"), size.try_cast("decimal(28,6)")) == 0, 1
    ).otherwise(0)
    return (on_edge + F.least(F.ceil((v - low) / size), F.lit(buckets + 1).cast("bigint"))).cast("int")


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit}")
    lat1, lon1, lat2, lon2 = (col(c) for c in (lat1, lon1, lat2, lon2))
    chord = F.pow(F.sin(F.radians((lat2 - lat1) / 2)), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians((lon2 - lon1) / 2)), 2)
    miles = F.lit(2 * EARTH_RADIUS_MI) * F.asin(F.sqrt(chord))
    return miles * F.lit(1.0 if unit == "mi" else KM_PER_MI)


def risk_band(c: Column | str) -> Column:
    return F.when(col(c) >= 80, "HIGH").when(col(c) >= 50, "MEDIUM").otherwise("LOW")


def pick(values: list[str], index: Column) -> Column:
    """The value at a 0-based position of a short fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)
