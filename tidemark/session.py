"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the transforms rely on. Shuffle partitions are left to the cluster (AQE coalesces them);
# the RocksDB state store keeps streaming dedup state off the JVM heap.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh directory in the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder: executors on other hosts would not
    see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
