"""Versioned history in storage: open versions are rewritten, closed ones only added to.

Open versions lie in parts cut by key, closed ones in parts of their own, one per snapshot. A snapshot
compares one signature per key with the stored one, closes the versions whose signature changed, opens
new ones, and rewrites only the open parts of these keys. Files of closed versions are never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.history import row_signature, start_history
from tidemark.sinks.versions import KeyedTable, Version

SIGNATURE = "row_signature"
CLOSED = "closed-"


class HistoryTable(KeyedTable):
    """``check_columns`` are the columns whose change makes a new version. The input of a snapshot has
    one row per key; a null key is never known again, so it is opened each time."""

    def __init__(self, spark: SparkSession, path: str, key: str, check_columns: list[str],
                 buckets: int = 64):
        super().__init__(spark, path, key, buckets)
        self.key, self.check_columns = key, list(check_columns)

    def open_versions(self, version: Version | None = None) -> DataFrame:
        version = version or self.latest()
        return self.read([p for p in version.parts if not p.startswith(CLOSED)], version)

    def closed_versions(self, version: Version | None = None) -> DataFrame:
        version = version or self.latest()
        return self.read([p for p in version.parts if p.startswith(CLOSED)], version)

    def snapshot(self, incoming: DataFrame, as_of: Column) -> Version:
        """Take in the state of the source at ``as_of``. Keys that are missing stay open."""
        base = self.latest()
        signed = incoming.withColumn(SIGNATURE, row_signature(self.check_columns))
        if base is None:
            return self.replace(start_history(signed, self.key, as_of))
        known = self.open_versions(base).select(self.key, F.col(SIGNATURE).alias("_known"))
        changed = signed.join(known, self.key, "left").filter(
            ~F.col("_known").eqNullSafe(F.col(SIGNATURE))).drop("_known")
        opened = self._landing(start_history(changed, self.key, as_of).select(*base.schema.names))
        touched = self.touched(opened, base)
        stored, keys = self.read(touched, base), opened.select(self.key)
        closing = stored.join(keys, self.key, "left_semi").withColumn(
            "valid_to", as_of.cast("timestamp")).select(*base.schema.names)
        staying = stored.join(keys, self.key, "left_anti").select(*base.schema.names)
        parts = self._written(staying.unionByName(opened), base.schema)
        gone = {p: None for p in touched if p not in parts}
        closed = {f"{CLOSED}{base.number + 1:012d}": self.put(closing, "closed")} if touched else {}
        return self.commit(base, gone | parts | closed, base.schema, {"buckets": self.buckets})
