"""The batch job: bronze files to silver, rejected and gold tables with checks and reconciliation."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.operators import recon, suites
from tidemark.operators.clean import (
    TRANSACTIONAL, latest_per_key, rejected_rows, tag_dataset, to_money, valid_rows,
    with_load_metadata,
)
from tidemark.plans import model
from tidemark.schemas import CANONICAL, KEYS, LOAD_METADATA, MONEY_COLUMNS
from tidemark.sinks.tables import append_audit, observed, write_table
from tidemark.sources.files import read_bronze

REFERENCE = ["customers", "accounts", "securities"]


@dataclass
class Layout:
    """Table folders below one root: ``<root>/<layer>/<table>``."""

    root: str

    def at(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


@dataclass
class Options:
    run_at: Column | None = None
    fmt: str = "parquet"
    validate: bool = True
    on_fail: str = "report"
    # Bronze keeps all files of all days, so a load computes the whole table and replaces it. Set this
    # only when the bronze folder holds one day's files and the table one partition per day's load.
    replace_partitions_only: bool = False
    thresholds: dict = field(default_factory=lambda: dict(suites.GOLD_THRESHOLDS))


def newest_first(dataset: str) -> list[str]:
    """Columns that say which row of a key is the newest. Reference data and balances carry no
    processing time: the load time and then the file, whose name holds its timestamp, decide."""
    return ["processing_timestamp"] if dataset in TRANSACTIONAL else [
        "ingestion_timestamp", "source_file"]


def clean_dataset(raw: DataFrame, dataset: str) -> DataFrame:
    """Cast money and keep the newest row per key. Account balances stay text, as delivered."""
    amounts = [] if dataset == "accounts" else MONEY_COLUMNS.get(dataset, [])
    return latest_per_key(
        to_money(raw, *amounts) if amounts else raw, KEYS[dataset], newest_first(dataset))


def read_dataset(spark: SparkSession, paths: Layout, dataset: str, options: Options) -> DataFrame:
    return with_load_metadata(
        read_bronze(spark, f"{paths.root}/bronze", dataset), run_at=options.run_at
    )


def _write(df: DataFrame, path: str, options: Options) -> None:
    write_table(df, path, "processing_date", fmt=options.fmt,
                replace_partitions_only=options.replace_partitions_only)


def _kept(summary: DataFrame, paths: Layout, table: str, options: Options) -> list:
    """Append the summary rows to the audit table, then stop the load if it is to stop."""
    spark = summary.sparkSession
    rows = summary.collect()
    append_audit(spark.createDataFrame(rows, summary.schema), paths.at("audit", table))
    return suites.enforce(spark.createDataFrame(rows, summary.schema), options.on_fail)


def load_reference(spark: SparkSession, paths: Layout, dataset: str, options: Options) -> None:
    """Silver and gold of a table without rejects. Gold is projected from the silver table just
    written, so files are parsed and deduplicated once."""
    silver_path = paths.at("silver", dataset)
    cleaned = clean_dataset(read_dataset(spark, paths, dataset, options), dataset)
    _write(cleaned, silver_path, options)
    # An empty load writes no file, so the schema is given instead of read.
    silver = spark.read.format(options.fmt).schema(cleaned.schema).load(silver_path)
    _write(model.gold(silver, dataset), paths.at("gold", model.gold_name(dataset)), options)


def load_transactional(
    spark: SparkSession, paths: Layout, dataset: str, options: Options
) -> dict[str, DataFrame]:
    """Silver, rejected and gold of a table with rules; returns its summaries.

    The bronze files are read, reduced and tagged once, by one write into a table cut by validity; the
    counts and the rule results come from that write. Silver and rejected are read from its folders,
    gold from silver as stored. A reconciliation row of what is stored ends the load.
    """
    key, suite = KEYS[dataset], suites.SUITE_BY_DATASET[dataset]
    seen_raw, seen = Observation(f"{dataset}-raw"), Observation(f"{dataset}-tagged")
    raw = read_dataset(spark, paths, dataset, options).observe(seen_raw, F.count(key).alias("_raw_keys"))
    tagged = tag_dataset(clean_dataset(raw, dataset), dataset)
    ok = F.col("rejection_reason").isNull()
    plain = [c for c in tagged.columns if c not in (*LOAD_METADATA, "rejection_reason")]
    metrics = recon.load_metrics(key) if dataset == "transactions" else [
        F.count_if(ok).alias("source_row_count"), F.count_if(~ok).alias("_rejected")]
    rules = suites.row_metrics(suite, plain, where=ok) if options.validate else []
    staging = paths.at("tagged", dataset)
    metrics = [F.max("processing_date").alias("day"), *metrics, *rules]
    write_table(tagged.withColumn("valid", ok).observe(seen, *metrics), staging, ["valid"])
    counts = observed(seen_raw, ["_raw_keys"]) | observed(seen, tagged.agg(*metrics).columns)
    stored = spark.read.schema(T.StructType(tagged.schema.fields).add("valid", "boolean")).parquet(
        staging)
    silver = stored.filter("valid").drop("valid", "rejection_reason")
    out = {"counts": pd.DataFrame([{
        "dataset_name": dataset, "valid_rows": counts["source_row_count"],
        "rejected_rows": counts["_rejected"]}])}
    if options.validate:
        results = suites.evaluate_suite(silver.select(*plain), suite, observed=counts)
        summary = suites.summarize(results, suite, dataset, "silver_pre_write")
        out["summary"] = _kept(summary, paths, "validation_results", options)
    _write(silver, paths.at("silver", dataset), options)
    _write(stored.filter("not valid").drop("valid"), paths.at("rejected", dataset), options)

    def as_stored(layer: str, table: str, schema: T.StructType) -> DataFrame:
        rows = spark.read.format(options.fmt).schema(schema).load(paths.at(layer, table))
        if options.replace_partitions_only:  # the table holds other loads too
            rows = rows.filter(F.col("processing_date") == F.lit(counts["day"] or None).cast("date"))
        return rows

    kept = as_stored("silver", dataset, silver.schema)
    gold_rows = model.gold(kept, dataset)
    _write(gold_rows, paths.at("gold", model.gold_name(dataset)), options)
    if options.validate and dataset == "transactions":
        gold = as_stored("gold", model.gold_name(dataset), gold_rows.schema)
        results = suites.evaluate_suite(
            recon.observed_reconciliation(counts, gold), "gold_load_validation", options.thresholds)
        summary = suites.summarize(
            results, "gold_load_validation", "gold_reconciliation", "gold_pre_curated_publish"
        )
        out["gold_summary"] = _kept(summary, paths, "validation_results", options)
    refused = as_stored("rejected", dataset, stored.drop("valid").schema)
    out["reconciliation"] = reconcile(spark, paths, dataset, stored, kept, refused, options)
    return out


def reconcile(spark: SparkSession, paths: Layout, dataset: str, source: DataFrame, target: DataFrame,
              rejected: DataFrame, options: Options) -> list:
    """Append the reconciliation row of a load to the audit table."""
    rows = recon.reconciliation_result(
        dataset, source, target, rejected, KEYS[dataset], "transaction_amount", options.run_at)
    found = rows.collect()
    append_audit(spark.createDataFrame(found, rows.schema),
                 paths.at("audit", "reconciliation_results"))
    return found


def run_batch(spark: SparkSession, root: str, options: Options | None = None) -> dict[str, dict]:
    """Load all seven datasets found below ``<root>/bronze``."""
    options, paths, out = options or Options(), Layout(root), {}
    for dataset in CANONICAL:
        if dataset in TRANSACTIONAL:
            out[dataset] = load_transactional(spark, paths, dataset, options)
        else:
            load_reference(spark, paths, dataset, options)
    return out


def table_counts(spark: SparkSession, paths: Layout, tables: dict[str, list[str]], fmt="parquet"):
    """Rows per stored table, from file footers."""
    parts = [
        spark.read.format(fmt).load(paths.at(layer, t)).agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "row_count"
        )
        for layer, names in tables.items() for t in names
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
