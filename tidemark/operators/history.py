"""Upserts and versioned history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.clean import latest_per_key


def upsert(
    target: DataFrame, landing: DataFrame, key: str, newest: list[str], insert_null_keys: bool = True
) -> DataFrame:
    """Target rows with the newest landing row per key put in their place, new keys added.

    A null key never matches, so such landing rows are inserts. The source is reduced to one row per
    key before the anti join, so neither side of the shuffle carries copies.
    """
    source = latest_per_key(landing, key, newest, keep_null_keys=insert_null_keys)
    source = source.select(*target.columns)
    return target.join(source.select(key), key, "left_anti").select(*target.columns).unionByName(source)


def merge_into(spark, target_table: str, landing: DataFrame, key: str, newest: list[str]) -> None:
    """The same upsert as MERGE INTO, for table formats that support it."""
    latest_per_key(landing, key, newest).createOrReplaceTempView("_merge_source")
    spark.sql(
        f"MERGE INTO {target_table} t USING _merge_source s ON t.{key} = s.{key} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def _differs(left: str, right: str, columns: list[str]) -> Column:
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns],
    )


def row_signature(columns: list[str]) -> Column:
    """Digest of the named columns, nulls included: equal exactly when all values are."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def start_history(incoming: DataFrame, key: str, as_of: Column) -> DataFrame:
    """First versions: everything is open from ``as_of`` on."""
    return _stamp(incoming, key, as_of)


def _stamp(df: DataFrame, key: str, as_of: Column) -> DataFrame:
    at = as_of.cast("timestamp_ntz").cast("string")
    return df.withColumns(
        {
            "scd_id": F.md5(F.concat_ws("|", F.col(key).cast("string"), at)),
            "updated_at": as_of,
            "valid_from": as_of,
            "valid_to": F.lit(None).cast("timestamp"),
        }
    )


def apply_snapshot(
    history: DataFrame, incoming: DataFrame, key: str, check_columns: list[str], as_of: Column
) -> DataFrame:
    """Next state of a versioned table (check strategy).

    An open version whose checked columns changed (null-safe) is closed at ``as_of`` and a new one
    opened; unseen keys are opened; keys missing from the input stay open. One join on the key
    covers all three cases; closed versions pass through untouched.
    """
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())
    data = incoming.columns
    pairs = current.select(F.struct(*history.columns).alias("old")).join(
        incoming.select(F.struct(*data).alias("new")),
        F.col(f"old.{key}") == F.col(f"new.{key}"),
        "full",
    )
    is_new = F.col(f"old.{key}").isNull()
    changed = F.col(f"old.{key}").isNotNull() & F.col(f"new.{key}").isNotNull() & _differs(
        "old", "new", check_columns
    )
    kept = pairs.filter(~is_new).select(
        *[F.col(f"old.{c}").alias(c) for c in history.columns if c != "valid_to"],
        F.when(changed, as_of).cast("timestamp").alias("valid_to"),
    )
    opened = _stamp(
        pairs.filter(is_new | changed).select(*[F.col(f"new.{c}").alias(c) for c in data]), key, as_of
    )
    return closed.unionByName(kept).unionByName(opened)
