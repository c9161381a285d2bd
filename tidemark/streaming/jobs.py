"""Streaming jobs: source, fan-out writer, side outputs and the full recompute job."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import suites
from tidemark.operators.clean import latest_per_key, rejected_rows, valid_rows
from tidemark.plans import marts
from tidemark.schemas import GOLD_TABLES, STREAM_ENVELOPE
from tidemark.sinks.tables import observed, write_parquet, write_table
from tidemark.streaming import events as ev
from tidemark.streaming.store import REJECTED, EventStore, keyed, months_of, route


@dataclass
class StreamPaths:
    """Folders of one streaming job: tables per layer and one checkpoint per query."""

    root: str

    def at(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def checkpoint(self, query: str) -> str:
        return self.at("checkpoints", query)


def envelope_source(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """A stream of envelopes. ``fmt`` may be any source that yields the four envelope columns;
    with the file source, ``maxFilesPerTrigger`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt in ("parquet", "json", "orc", "csv"):
        reader = reader.schema(STREAM_ENVELOPE)
    df = reader.load(path) if path else reader.load()
    return df.select(*STREAM_ENVELOPE.fieldNames())


# State of a stream is kept on the executors' disks, with one bound for the memory of all stores of an
# executor. Spark's own default keeps it on the heap, where it grows with the ids within the watermark.
# Changelog checkpoints stay off: with them a store that is done keeps what it wrote in memory, beyond the
# bound, as only a store that is writing flushes.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def _start(spark: SparkSession, writer, available_now: bool, interval: str, *path: str):
    """Start a stream; it takes a copy of the session's settings as it begins. The ones of ``STATE`` that
    the session does not set itself are set for that moment."""
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=interval)
    ours = [name for name in STATE if spark.conf.get(name, None) is None]
    for name in ours:
        spark.conf.set(name, STATE[name])
    try:
        return writer.start(*path)
    finally:
        for name in ours:
            spark.conf.unset(name)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = ev.TRIGGER,
    fmt: str = "parquet",
    partition_by: str | None = "processing_date",
) -> StreamingQuery:
    """Append a stream to one table."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _start(df.sparkSession, writer, available_now, interval, path)


def _run_id(spark: SparkSession, checkpoint: str | None) -> str:
    """Id of the query that a checkpoint belongs to. Batch numbers start at 0 again with a new
    checkpoint, so a batch is known by both."""
    if checkpoint is None:
        return "direct"
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


@contextmanager
def adaptive(spark: SparkSession):
    """Adaptive execution for the work on one batch. A stateful stream turns it off in its session, as
    its own plan must keep its partitions; that plan is fixed when foreachBatch gets the batch. Without it
    a rebalance hashes by route, and one task writes all rows of a route."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


SUITE = "streaming_events_microbatch"


def fan_out(
    paths: StreamPaths,
    fmt: str = "parquet",
    validate: bool = True,
    on_fail: str = "report",
    checkpoint: str | None = None,
):
    """foreachBatch function: one tagged write of the batch's new events, from which the rejected,
    silver and gold tables are read (:func:`stream_table`).

    Counts and rule results come from that write; only ``on_fail='raise'`` looks at the batch before
    it is stored. The batch is kept for the few passes over it. A batch that is replayed replaces what
    it wrote, and events that another batch has stored are left out (see ``streaming.store``).
    """
    state: dict = {}

    def audit(row: DataFrame, key: str, table: str) -> None:
        write_table(row.withColumn("batch_key", F.lit(key)), paths.at("audit", table), ["batch_key"],
                    fmt=fmt, replace_partitions_only=True)

    def process(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            store_batch(batch, batch_id)

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = EventStore(spark, paths.root)
        if "run" not in state:
            state["run"] = _run_id(spark, checkpoint)
            store.forget_attempt(f"{state['run']}-{batch_id}")
        key = f"{state['run']}-{batch_id}"
        kept = keyed(ev.tag_events(batch), key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            months = months_of(kept)
            if not months:
                return
            looks_first = validate and on_fail == "raise"
            new = store.fresh(kept, key, months, remember=not looks_first)
            checked = new.select(*suites.suite_columns(SUITE)).withColumn(
                "transaction_amount", ev.money("transaction_amount"))

            def summary(observed: dict | None) -> DataFrame:
                return suites.summarize(
                    suites.evaluate_suite(checked, SUITE, observed=observed), SUITE,
                    "streaming_events", "stream_microbatch")

            if looks_first:
                suites.enforce(summary(None), on_fail)
                store.remember(new, list(months))
            seen = Observation(key)
            rules = suites.row_metrics(SUITE, checked.columns, values={
                "transaction_amount": ev.money("transaction_amount")}) if validate else []
            store.write(new.observe(seen, *batch_metrics(), *rules))
            metrics = observed(seen, new.agg(*batch_metrics(), *rules).columns)
            if not metrics["input_rows"]:
                return
            counts = {c: metrics[c] for c in BATCH_COUNTS} | {"batch_id": batch_id}
            row = spark.range(0, 1, 1, 1).select(
                *[F.lit(counts[c]).cast(t).alias(c) for c, t in _COUNTS_TYPES.items()])
            audit(row, key, "batch_counts")
            if validate:
                audit(summary(metrics).withColumn("batch_id", F.lit(batch_id)), key,
                      "validation_results")
        finally:
            store.release()
            kept.unpersist()

    return process


BATCH_COUNTS = ["processing_date", "input_rows", "valid_rows", "rejected_rows",
                *[f"{k}_rows" for k in ev.EVENT_KINDS]]
_COUNTS_TYPES = {"processing_date": "date"} | dict.fromkeys([*BATCH_COUNTS[1:], "batch_id"], "bigint")


def batch_metrics() -> list[Column]:
    """Counts of a batch; all of its rows have one load day."""
    ok = F.col("rejection_reason").isNull()
    return [
        F.max("processing_date").alias("processing_date"),
        F.count("*").alias("input_rows"),
        F.count_if(ok).alias("valid_rows"),
        F.count_if(~ok).alias("rejected_rows"),
        *[F.count_if(ok & (F.col("event_type") == k)).alias(f"{k}_rows") for k in ev.EVENT_KINDS],
    ]


def stream_table(spark: SparkSession, paths: StreamPaths, layer: str, table: str) -> DataFrame:
    """One table of the fan-out job: the stored events of its route, in the table's columns. Silver
    and gold of a stream hold the same rows."""
    store = EventStore(spark, paths.root)
    if (layer, table) == ("rejected", "events"):
        return store.rows(REJECTED).drop("identity", "route", "event_month")
    names = dict(GOLD_TABLES) if layer == "gold" else {d: d for d in ev.EVENT_KINDS.values()}
    dataset = {t: d for d, t in names.items()}[table]
    kind = {d: k for k, d in ev.EVENT_KINDS.items()}[dataset]
    rows = store.rows(dataset)
    return ev.route(rows, kind, ["batch_key"])


STREAM_TABLES = [
    ("rejected", "events"),
    *[("silver", d) for d in ev.EVENT_KINDS.values()],
    *[("gold", GOLD_TABLES[d]) for d in ev.EVENT_KINDS.values()],
]


def register_stream_tables(spark: SparkSession, paths: StreamPaths) -> None:
    """The job's tables as views named ``<layer>_<table>``."""
    for layer, table in STREAM_TABLES:
        stream_table(spark, paths, layer, table).createOrReplaceTempView(f"{layer}_{table}")


def run_stream(
    envelopes: DataFrame,
    paths: StreamPaths,
    run_at: Column | None = None,
    available_now: bool = True,
    interval: str = ev.TRIGGER,
    checkpoint: str | None = None,
    **options,
) -> StreamingQuery:
    """Start the fan-out job on a stream of envelopes. A new ``checkpoint`` starts a new run beside
    the rows of earlier ones."""
    checkpoint = checkpoint or paths.checkpoint("fan_out")
    writer = (
        ev.prepare(envelopes, run_at)
        .writeStream.foreachBatch(fan_out(paths, checkpoint=checkpoint, **options))
        .option("checkpointLocation", checkpoint)
    )
    return _start(envelopes.sparkSession, writer, available_now, interval)


def run_side_output(
    envelopes: DataFrame, paths: StreamPaths, kind: str, available_now: bool = True
) -> StreamingQuery:
    """Dead letters (unparsable payloads) or late events, appended by a stateless query."""
    parsed = ev.parse_envelope(envelopes)
    rows = ev.dead_letters(parsed) if kind == "dead_letters" else ev.late_events(parsed)
    dated = rows.withColumn("arrival_date", F.to_date("arrival_timestamp"))
    return write_stream(
        dated, paths.at("rejected", kind), paths.checkpoint(kind), available_now,
        partition_by="arrival_date",
    )


def run_minute_windows(
    envelopes: DataFrame, paths: StreamPaths, run_at: Column | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """One-minute trade metrics, each window emitted once when the watermark has passed it."""
    trades = ev.route(valid_rows(ev.tag_events(ev.prepare(envelopes, run_at))), "trade")
    at = run_at if run_at is not None else F.current_timestamp()
    minutes = ev.minute_windows(trades).withColumn("processing_date", F.to_date(at))
    return write_stream(
        minutes, paths.at("gold", "trade_minutes"), paths.checkpoint("trade_minutes"), available_now,
    )


def progress_metrics(query: StreamingQuery) -> dict[str, int]:
    """Rows read and rows dropped for lateness over the query's recent progress."""
    read = sum(p.numInputRows for p in query.recentProgress)
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    return {"input_rows": read, "late_rows_dropped": dropped}


# ---- recompute job -----------------------------------------------------------------------------
def latest_events(events: DataFrame) -> DataFrame:
    """One row per event_id over all files, newest processing time first."""
    return latest_per_key(events, "event_id", "processing_timestamp")


def recompute(events: DataFrame, run_at: Column | None = None) -> dict[str, DataFrame]:
    """All tables of the trade path from the full set of event files, lazily by ``<layer>/<table>``.

    Load metadata is added to the surviving rows only.
    """
    tagged = ev.tag_events(ev.with_stream_metadata(latest_events(events), run_at))
    trades = ev.route(valid_rows(tagged), "trade")
    return {
        "rejected/events": rejected_rows(tagged),
        "silver/trades": trades,
        "gold/fact_trade": trades,
        "gold/trade_minute_metrics": marts.trade_minute_metrics(trades),
        "gold/customer_trade_exposure": marts.customer_trade_exposure(trades),
    }


def run_recompute(events: DataFrame, paths: StreamPaths, run_at: Column | None = None) -> None:
    """Overwrite the trade tables. The event files are read, reduced and tagged once, into one table
    cut by route; rejects and trades are read from its folders."""
    spark = events.sparkSession
    tagged = ev.tag_events(ev.with_stream_metadata(latest_events(events), run_at))
    routed = paths.at("silver", "events_by_route")
    write_table(tagged.withColumn("route", route()), routed, ["route"])
    stored = spark.read.schema(tagged.schema.add("route", "string")).parquet(routed)
    write_parquet(stored.filter(F.col("route") == REJECTED).drop("route"), paths.at("rejected", "events"))
    write_parquet(ev.route(stored.filter(F.col("route") == "trades"), "trade"),
                  paths.at("silver", "trades"))
    trades = spark.read.schema(ev.route(stored, "trade").schema).parquet(paths.at("silver", "trades"))
    write_parquet(trades, paths.at("gold", "fact_trade"))
    write_parquet(marts.trade_minute_metrics(trades), paths.at("gold", "trade_minute_metrics"))
    write_parquet(marts.customer_trade_exposure(trades), paths.at("gold", "customer_trade_exposure"))


def union_counts(parts: dict[str, DataFrame]) -> DataFrame:
    rows = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
            for n, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)
