"""Writes, table registration and audit appends."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | str | None = "processing_date",
    mode: str = "overwrite",
    fmt: str = "parquet",
    replace_partitions_only: bool = False,
    **options: str,
) -> None:
    """Write a table directory.

    A plain overwrite replaces the whole table. ``replace_partitions_only`` replaces just the
    partitions present in ``df``, which makes the rerun of one day's load idempotent. Rows are
    rebalanced by partition value first: adaptive execution cuts a day that is too big into several
    files and packs small ones, so no task writes a hot day alone.
    """
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if columns:
        df = df.hint("rebalance", *columns)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if columns:
        writer = writer.partitionBy(*columns)
    if replace_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_parquet(df: DataFrame, path: str, partition_by: str | None = "processing_date") -> None:
    write_table(df, path, partition_by, compression="snappy")


def write_bronze_json(df: DataFrame, path: str) -> None:
    """JSON-lines landing files; used to stage derived data for the file sources."""
    df.write.mode("overwrite").json(path)


def register_table(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    location: str,
    partition_by: list[str],
    fmt: str = "parquet",
) -> None:
    """External table over a directory; its columns come from the frame that is written there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt}{layout} LOCATION '{location}'")


def repair_table(spark: SparkSession, table: str) -> None:
    """Register the partition directories found below the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def observed(seen: Observation, names: list[str]) -> dict:
    """The values of an observation whose write is done. Adaptive execution drops the observed part of
    a plan that turns out to have no rows: its counts are 0."""
    try:
        return seen.get
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


# Materialization per layer.
MATERIALIZATION = {
    "staging": "view",
    "intermediate": "view",
    "reporting": "view",
    "dimensions": "table",
    "facts": "table",
}


def materialize(
    df: DataFrame, name: str, layer: str, path: str | None = None, partition_by: list[str] = ()
) -> None:
    """Views for staging, intermediate and reporting models; stored tables for dims and facts."""
    if MATERIALIZATION[layer] == "view":
        df.createOrReplaceTempView(name)
        return
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


LOAD_HISTORY = (
    "load_id string, source_object string, target_table string, stage_name string, "
    "copy_statement string, load_started_at timestamp, load_finished_at timestamp, status string, "
    "rows_loaded bigint, rows_parsed bigint, error_count bigint, error_limit bigint, "
    "first_error string, files_loaded bigint")


def append_audit(df: DataFrame, path: str) -> None:
    """Append audit rows (load history, reconciliation results, validation summaries) as one file.

    The few rows are shuffled to one task; a coalesce would pull the work that makes them into it.
    """
    df.repartition(1).write.mode("append").parquet(path)
