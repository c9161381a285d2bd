"""Registration of queries with their SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.testbed.ctes import with_ctes
from tidemark.testbed.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def count_rows() -> Column:
    return F.count("*").alias("n")


def portable(df: DataFrame) -> DataFrame:
    """Result types both engines share: decimals as doubles, dates as text, timestamps without a
    zone. The library itself keeps decimals and dates."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return df.select(columns)


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register ``fn(views) -> DataFrame`` under ``name``."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The canonical tables are in UTC; results leave without a zone.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(fn(Views(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_ctes(sql, extra)
        return fn

    return register
