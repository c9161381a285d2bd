"""Loads that read only new files.

A load lists the bronze files of a dataset and takes those that the ledger does not hold. It tags
their rows and merges them into the stored table, which keeps the newest row of each key: only the buckets
of the keys that came are read and rewritten. The ledger is a side part of the same table, so the rows and
the list of files they came from switch together: a load that fails is simply run again, and a file is
never loaded twice. The stored table holds valid and rejected rows, cut by validity; silver, rejected
and gold are read from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.operators.clean import TRANSACTIONAL, tag_dataset, to_money, with_load_metadata
from tidemark.plans import model
from tidemark.plans.batch import Layout, Options, newest_first
from tidemark.schemas import CANONICAL, KEYS, MONEY_COLUMNS
from tidemark.sinks.tables import LOAD_HISTORY, append_audit, observed
from tidemark.sinks.versions import KeyedTable, Version
from tidemark.sources.files import SOURCE_FORMATS, list_files, read_files

BUCKETS = 64
LEDGER = "path string, length bigint, modified_at timestamp, load_id string, loaded_at timestamp"


def stored(spark: SparkSession, paths: Layout, dataset: str, buckets: int = BUCKETS) -> KeyedTable:
    split = {"valid": F.col("rejection_reason").isNull()} if dataset in TRANSACTIONAL else {}
    return KeyedTable(spark, paths.at("loaded", dataset), KEYS[dataset], buckets, split)


def layer(spark: SparkSession, paths: Layout, dataset: str, name: str) -> DataFrame:
    """Rows of the silver, rejected or gold layer as the last load left them."""
    table = stored(spark, paths, dataset)
    if dataset not in TRANSACTIONAL:
        return table.read() if name == "silver" else model.gold(table.read(), dataset)
    if name == "rejected":
        return table.with_value("valid", "false")
    silver = table.with_value("valid", "true").drop("rejection_reason")
    return silver if name == "silver" else model.gold(silver, dataset)


def ledger(table: KeyedTable, version: Version | None = None) -> DataFrame:
    """Every file that was loaded, with its load."""
    return table.read_side("ledger-", LEDGER, version)


def bronze_files(spark: SparkSession, paths: Layout, dataset: str) -> DataFrame:
    """Files named for the dataset and a time, or the files in a folder of such a name."""
    kind = SOURCE_FORMATS[dataset]
    name = rf"/{dataset}_\d{{8}}T\d{{6}}Z\.{kind}(/[^/]+)?$"
    return list_files(spark, paths.at("bronze", dataset)).filter(F.col("path").rlike(name))


def new_files(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files that were not loaded yet, or have changed since."""
    return files.join(done, ["path", "length", "modified_at"], "left_anti")


def load_new_files(spark: SparkSession, paths: Layout, dataset: str, options: Options | None = None,
                   buckets: int = BUCKETS) -> dict:
    """Load what has come since the last load; returns its load history row.

    The names of the new files reach the driver, which lists the files of every read anyway.
    """
    options = options or Options()
    table = stored(spark, paths, dataset, buckets)
    base = table.latest()
    load_id = f"{dataset}-{uuid.uuid4().hex[:12]}"
    at = options.run_at if options.run_at is not None else F.current_timestamp()
    started = spark.range(1).select(F.current_timestamp()).first()[0]
    files = new_files(bronze_files(spark, paths, dataset), ledger(table, base)).select(
        "path", "length", "modified_at", F.lit(load_id).alias("load_id"), at.alias("loaded_at"))
    listed = files.collect()
    entry = {
        "load_id": load_id, "source_object": paths.at("bronze", dataset),
        "target_table": paths.at("loaded", dataset), "stage_name": dataset,
        "copy_statement": None, "first_error": None, "load_started_at": started, "error_limit": 0, "rows_loaded": 0, "rows_parsed": 0,
        "error_count": 0, "files_loaded": len(listed), "status": "NOTHING_NEW"}
    seen = Observation(load_id)
    try:
        if listed:
            raw = with_load_metadata(read_files(
                spark, SOURCE_FORMATS[dataset], [r["path"] for r in listed], CANONICAL[dataset]),
                run_at=at)
            amounts = [] if dataset == "accounts" else MONEY_COLUMNS.get(dataset, [])
            rows = to_money(raw, *amounts) if amounts else raw
            rejected = F.lit(0)
            if dataset in TRANSACTIONAL:
                rows = tag_dataset(rows, dataset)
                rejected = F.count_if(F.col("rejection_reason").isNotNull())
            # counted while the rows are written, not by a pass of its own
            rows = rows.observe(seen, F.count("*").alias("parsed"), rejected.alias("rejected"))
            side = table.put(spark.createDataFrame(listed, LEDGER).coalesce(1), "ledger")
            table.keep_newest(rows, newest_first(dataset), side={f"ledger-{load_id}": side},
                              info={"load_id": load_id}, base=base)
            counts = observed(seen, ["parsed", "rejected"])
            entry |= {"status": "LOADED", "rows_parsed": counts["parsed"],
                      "rows_loaded": counts["parsed"], "error_count": counts["rejected"]}
    except Exception as e:
        entry |= {"status": "LOAD_FAILED", "first_error": str(e).splitlines()[0][:500]}
        raise
    finally:
        entry["load_finished_at"] = spark.range(1).select(F.current_timestamp()).first()[0]
        append_audit(spark.createDataFrame([entry], LOAD_HISTORY), paths.at("audit", "load_history"))
    return entry
