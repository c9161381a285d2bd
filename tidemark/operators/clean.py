"""Load metadata, money casts, latest-row dedup and the valid/rejected split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.scalars import money
from tidemark.schemas import (
    ACCOUNT_STATUSES, ACCOUNT_TYPES, COUNTRIES, CURRENCIES, PAYMENT_STATUSES, RISK_RANGE,
    TRADE_SIDES, TRANSACTION_STATUSES, TRANSACTION_TYPES,
)


def with_load_metadata(
    df: DataFrame, source: Column | str | None = None, run_at: Column | None = None
) -> DataFrame:
    """Add source_file, ingestion_timestamp and processing_date.

    ``source`` is a literal label; left out, it is the file each row came from. ``run_at`` fixes the
    load time, so a rerun of the same load writes the same partition.
    """
    at = run_at if run_at is not None else F.current_timestamp()
    if source is None:
        source = F.col("_metadata.file_path")
    elif isinstance(source, str):
        source = F.lit(source)
    return df.withColumns(
        {"source_file": source, "ingestion_timestamp": at, "processing_date": F.to_date(at)}
    )


def to_money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: money(c) for c in columns})


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


_COPIES = 4_096


def latest_per_key(
    df: DataFrame,
    keys: str | list[str],
    newest: list[str] | str,
    keep_null_keys: bool = True,
    tiebreak: bool = True,
) -> DataFrame:
    """Keep the newest row of every key; rows with a null key are no copies of each other and stay.

    ``newest`` lists the ordering columns, latest first wins; the remaining columns (maps have no
    order and are left out) follow as a tie-break, so the survivor does not depend on row order.

    One scan and one shuffle: the newest row is the greatest row struct of its key, so every task
    sends one row per key, however many rows a hot key has, and a filter on the key reaches the scan.
    Rows with a null key group by all their columns, so they spread over the tasks; equal ones travel
    as one row and a count and are repeated afterwards.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest = [newest] if isinstance(newest, str) else list(newest)
    values = [c for c in df.columns if c not in keys]
    ordered = [f.name for f in df.schema.fields if f.name in values and _sortable(f.dataType)]
    place = [*newest, *[c for c in ordered if tiebreak and c not in newest]]
    if set(values) <= set(place):
        best = F.max(F.struct(*place, F.lit(0).alias("_")))
    else:
        best = F.max_by(F.struct(*values), F.struct(*place))
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    whole = [F.col(f"_row.{c}").alias(c) if c in values else F.col(c) for c in df.columns]
    if not keep_null_keys:
        return df.filter(~has_null).groupBy(*keys).agg(best.alias("_row")).select(*whole)
    same = F.struct(F.lit(0), *[
        F.col(c) if c in ordered else F.to_json(F.struct(c)).alias(c) for c in values])
    rows = df.withColumn("_same", F.when(has_null, same)).groupBy(*keys, "_same").agg(
        best.alias("_row"), F.count("*").alias("_n"))
    # copies are repeated in parts, so that no task holds an array of all of them
    parts = F.when(has_null, F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / _COPIES))
                   ).otherwise(F.array(F.lit(0).cast("long")))
    copies = F.when(has_null, F.least(F.lit(_COPIES), F.col("_n") - F.col("_part") * _COPIES)
                    ).otherwise(F.lit(1)).cast("int")
    return rows.select(*keys, "_row", "_n", F.explode(parts).alias("_part")).select(
        *keys, F.explode(F.array_repeat("_row", copies)).alias("_row")).select(*whole)


def sure(condition: Column) -> Column:
    """A condition that is false, not null, when its inputs are null."""
    return F.coalesce(condition, F.lit(False))


def tag_rejections(
    df: DataFrame,
    id_column: str,
    statuses: list[str],
    extra: Column | None = None,
    amount: str = "transaction_amount",
    status: str = "transaction_status",
) -> DataFrame:
    """Add ``rejection_reason``: null for a valid row, else the first rule it breaks.

    Every row is either valid or rejected; a null currency, amount, status or risk is rejected.
    """
    currency_ok = F.col("currency_code").isin(CURRENCIES)
    status_ok = F.col(status).isin(statuses)
    valid = (
        F.col(id_column).isNotNull()
        & currency_ok
        & (F.col(amount) >= 0)
        & status_ok
        & F.col("risk_score").between(*RISK_RANGE)
    )
    if extra is not None:
        valid = valid & extra
    reason = (
        F.when(sure(valid), F.lit(None).cast("string"))
        .when(F.col(id_column).isNull(), f"{id_column}_null")
        .when(~currency_ok, "invalid_currency")
        .when(F.col(amount) < 0, "negative_amount")
        .when(~status_ok, "invalid_status")
        .otherwise("validation_failed")
    )
    return df.withColumn("rejection_reason", reason)


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("rejection_reason").isNull()).drop("rejection_reason")


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("rejection_reason").isNotNull())


def transaction_rule() -> Column:
    return F.col("transaction_type").isin(TRANSACTION_TYPES)


def payment_rule() -> Column:
    return F.col("transaction_status").isin(PAYMENT_STATUSES)


def trade_rule() -> Column:
    return F.col("side").isin(TRADE_SIDES)


# Per transactional table: id column, allowed statuses, extra rule.
TRANSACTIONAL = {
    "transactions": ("transaction_id", TRANSACTION_STATUSES, transaction_rule),
    "payments": ("payment_id", PAYMENT_STATUSES, payment_rule),
    "trades": ("trade_id", TRANSACTION_STATUSES, trade_rule),
}


def tag_dataset(df: DataFrame, dataset: str) -> DataFrame:
    id_column, statuses, rule = TRANSACTIONAL[dataset]
    return tag_rejections(df, id_column, statuses, rule())


def record_rules(entity: str) -> dict[str, Column]:
    """Domain rules of a canonical record: rule name to a condition that must hold."""
    c = F.col
    risk = {"risk_score": c("risk_score").between(*RISK_RANGE)}
    country = {"country_code": c("country_code").isin(COUNTRIES)}
    currency = {"currency_code": c("currency_code").isin(CURRENCIES)}
    status = {"transaction_status": c("transaction_status").isin(TRANSACTION_STATUSES)}
    return {
        "customers": country | risk,
        "accounts": {
            "account_type": c("account_type").isin(ACCOUNT_TYPES),
            **currency,
            "status": c("status").isin(ACCOUNT_STATUSES),
        },
        "securities": currency,
        "transactions": {
            "transaction_type": transaction_rule(), **currency, **status, **country, **risk,
        },
        "payments": {**currency, "transaction_status": payment_rule(), **country, **risk},
        "trades": {**currency, "side": trade_rule(), **status, **country, **risk},
        "daily_account_balances": currency,
    }[entity]


def broken_rules(df: DataFrame, entity: str) -> DataFrame:
    """Add ``broken_rules``: the names of the record rules a row does not satisfy."""
    checks = [
        F.when(~sure(rule), F.lit(name)) for name, rule in sorted(record_rules(entity).items())
    ]
    return df.withColumn("broken_rules", F.array_compact(F.array(*checks)))
