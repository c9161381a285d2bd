"""Reconciliation between layers, audit rows, inventory and freshness.

Single-row summaries meet through a union and one more aggregate, so no join without a key is
planned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import MONEY


def one_row(*parts: DataFrame) -> DataFrame:
    """Merge one-row frames with distinct columns into one row."""
    names = [c for p in parts for c in p.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast(MONEY)


def row_count_reconciliation(dataset: str, raw: DataFrame, staging: DataFrame) -> DataFrame:
    return one_row(
        raw.agg(F.count("*").alias("raw_row_count")),
        staging.agg(F.count("*").alias("staging_row_count")),
    ).select(
        F.lit(dataset).alias("dataset_name"),
        "raw_row_count",
        "staging_row_count",
        F.abs(F.col("raw_row_count") - F.col("staging_row_count")).alias("row_count_difference"),
    )


def amount_reconciliation(
    dataset: str, raw: DataFrame, staging: DataFrame, amount: str = "transaction_amount"
) -> DataFrame:
    return one_row(
        raw.agg(_total(amount).alias("raw_amount_sum")),
        staging.agg(_total(amount).alias("staging_amount_sum")),
    ).select(
        F.lit(dataset).alias("dataset_name"),
        "raw_amount_sum",
        "staging_amount_sum",
        F.abs(F.col("raw_amount_sum") - F.col("staging_amount_sum"))
        .cast(MONEY)
        .alias("amount_difference"),
    )


def duplicate_identifiers(df: DataFrame, key: str) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("duplicate_count"))
        .filter("duplicate_count > 1")
        .orderBy(F.desc("duplicate_count"), F.asc_nulls_last(key))
    )


def reconciliation_result(
    dataset: str,
    source: DataFrame,
    target: DataFrame,
    rejected: DataFrame,
    key: str,
    amount: str,
    checked_at: Column | None = None,
) -> DataFrame:
    """The audit row of a load: counts, sums, differences, duplicates, rejects and status.

    The row is OK when counts balance (source = target + rejected), the target has no duplicates and
    the difference in sums is explained by the rejected rows alone.
    """
    at = checked_at if checked_at is not None else F.current_timestamp()
    parts = [
        df.select(F.lit(part).alias("_part"), id_.alias("_id"), F.col(amount).alias("_amount"))
        for part, df, id_ in (("source", source, F.lit(None).cast("string")),
                              ("target", target, F.col(key).cast("string")),
                              ("rejected", rejected, F.lit(None).cast("string")))
    ]
    # one shuffle: ids of the target are counted, the rest is one row per part and task
    per_id = reduce(lambda a, b: a.unionByName(b), parts).groupBy("_part", "_id").agg(
        F.count("*").alias("_n"), F.sum("_amount").alias("_sum"))

    def rows(part: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_part") == part, F.col("_n"))), F.lit(0))

    def amounts(part: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_part") == part, F.col("_sum"))), F.lit(0)).cast(MONEY)

    facts = per_id.agg(
        rows("source").alias("source_row_count"), amounts("source").alias("source_amount_sum"),
        rows("target").alias("target_row_count"), amounts("target").alias("target_amount_sum"),
        F.count_if(F.col("_id").isNotNull() & (F.col("_n") > 1)).alias("duplicate_identifier_count"),
        rows("rejected").alias("rejected_record_count"), amounts("rejected").alias("_rejected_sum"),
    )
    count_gap = F.abs(F.col("source_row_count") - F.col("target_row_count"))
    sum_gap = (F.col("source_amount_sum") - F.col("target_amount_sum")).cast(MONEY)
    explained = (
        (count_gap == F.col("rejected_record_count"))
        & (sum_gap == F.col("_rejected_sum"))
        & (F.col("duplicate_identifier_count") == 0)
    )
    return facts.select(
        F.concat_ws("-", F.lit(dataset), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")).alias(
            "reconciliation_id"
        ),
        F.lit(dataset).alias("dataset_name"),
        "source_row_count",
        "target_row_count",
        count_gap.alias("row_count_difference"),
        "source_amount_sum",
        "target_amount_sum",
        F.abs(sum_gap).alias("amount_difference"),
        "duplicate_identifier_count",
        "rejected_record_count",
        at.alias("checked_at"),
        F.when(explained, "OK").otherwise("MISMATCH").alias("status"),
        F.concat(
            F.col("rejected_record_count").cast("string"), F.lit(" rejected, "),
            F.col("duplicate_identifier_count").cast("string"), F.lit(" duplicated"),
        ).alias("details"),
    )


def rejected_record_audit(results: DataFrame) -> DataFrame:
    return (
        results.filter("rejected_record_count > 0")
        .select("dataset_name", "rejected_record_count", "checked_at", "status", "details")
        .orderBy(F.desc("checked_at"), "dataset_name")
    )


def load_history_report(history: DataFrame) -> DataFrame:
    return history.select(
        "load_id", "target_table", "status", "rows_loaded", "error_count", "first_error",
        "load_finished_at",
    ).orderBy(F.desc("load_finished_at"), "load_id")


def load_metrics(key: str, accepted: Column | None = None) -> list[Column]:
    """Counts and sums of a load's tagged rows, to aggregate or to observe while they are written."""
    ok = accepted if accepted is not None else F.col("rejection_reason").isNull()

    def total(kind: str) -> Column:
        wanted = ok & (F.col("transaction_type") == kind)
        amount = F.when(wanted, F.col("transaction_amount"))
        return F.coalesce(F.sum(amount), F.lit(0)).cast(MONEY)

    return [
        F.count(key).alias("_kept_keys"),
        F.count_if(ok).alias("source_row_count"),
        F.count_if(~ok).alias("_rejected"),
        total("DEBIT").alias("debit_total"),
        total("CREDIT").alias("credit_total"),
    ]


def gold_measures(facts: DataFrame) -> DataFrame:
    """The eight load measures from one row of counts and sums."""
    copies = F.col("_raw_keys") - F.col("_kept_keys")
    inputs = F.col("source_row_count") + F.col("_rejected")
    return facts.select(
        "source_row_count",
        "target_row_count",
        F.abs(F.col("source_row_count") - F.col("target_row_count")).alias("row_count_difference"),
        "debit_total",
        "credit_total",
        F.abs(F.col("debit_total") - F.col("credit_total")).cast(MONEY).alias(
            "debit_credit_difference"
        ),
        (copies / F.greatest(F.col("_raw_keys"), F.lit(1))).alias("duplicate_rate"),
        (F.col("_rejected") / F.greatest(inputs, F.lit(1))).alias("rejected_rate"),
    )


def gold_reconciliation(raw: DataFrame, tagged: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """The eight load measures of a transactional table, all from data.

    ``raw`` is the input before dedup, ``tagged`` the deduplicated rows with their rejection reason.
    """
    return gold_measures(one_row(
        raw.agg(F.count(key).alias("_raw_keys")),
        tagged.agg(*load_metrics(key)),
        gold.agg(F.count("*").alias("target_row_count")),
    ))


def observed_reconciliation(observed: dict, gold: DataFrame) -> DataFrame:
    """The same measures, with the counts of raw and tagged rows as their write observed them and the
    rows of the gold table as it is stored."""
    names = ["_raw_keys", "_kept_keys", "source_row_count", "_rejected", "debit_total", "credit_total"]
    return gold_measures(gold.agg(F.count("*").alias("target_row_count")).withColumns(
        {n: F.lit(observed[n]) for n in names}))


def inventory(tables: dict[str, DataFrame], partition: str = "processing_date") -> DataFrame:
    """Per table: newest partition, rows, files and columns, from file metadata of the scan."""
    parts = []
    for name, df in tables.items():
        newest = F.max(F.col(partition).cast("string")) if partition in df.columns else F.lit(None)
        per_file = df.groupBy(F.col("_metadata.file_path").alias("_file")).agg(
            newest.cast("string").alias("_newest"), F.count("*").alias("_rows")
        )
        parts.append(
            per_file.agg(
                F.max("_newest").alias("latest_partition"),
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
                F.count("*").alias("file_count"),
            ).select(
                F.lit(name).alias("table_name"), "latest_partition", "row_count", "file_count",
                F.lit(",".join(df.columns)).alias("column_names"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def freshness(
    tables: dict[str, DataFrame],
    as_of: Column,
    max_age: str,
    column: str = "ingestion_timestamp",
) -> DataFrame:
    """Newest load time per table, its age in seconds and whether it is within ``max_age``."""
    parts = [df.agg(F.max(column).alias("newest")).select(F.lit(n).alias("table_name"), "newest")
             for n, df in tables.items()]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    age = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))
    fresh = F.coalesce(F.col("newest") >= as_of - F.expr(f"interval {max_age}"), F.lit(False))
    return rows.withColumns({"age_seconds": age, "is_fresh": fresh})


# Platform metric names
RECONCILIATION_MISMATCHES = "ReconciliationMismatches"
FRESHNESS_VIOLATIONS = "DataFreshnessViolations"


def mismatch_metric(results: DataFrame) -> DataFrame:
    """Reconciliation results that did not balance, per dataset."""
    return results.groupBy("dataset_name").agg(
        F.lit(RECONCILIATION_MISMATCHES).alias("metric_name"),
        F.count_if(F.col("status") != "OK").cast("double").alias("value"),
    )


def freshness_metric(report: DataFrame) -> DataFrame:
    """Stale tables: one metric row per table."""
    return report.select(
        F.col("table_name").alias("dataset_name"),
        F.lit(FRESHNESS_VIOLATIONS).alias("metric_name"),
        F.when(F.col("is_fresh"), 0).otherwise(1).cast("double").alias("value"),
    )


def stage_counts(tagged: dict[str, DataFrame]) -> DataFrame:
    """Valid and rejected rows per dataset: one pass over each tagged frame."""
    accepted = F.col("rejection_reason").isNull()
    parts = [
        df.agg(
            F.count_if(accepted).alias("valid_rows"), F.count_if(~accepted).alias("rejected_rows")
        ).select(F.lit(name).alias("dataset_name"), "valid_rows", "rejected_rows")
        for name, df in tagged.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
