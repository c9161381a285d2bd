"""Streaming queries: the events table is staged as stream files, the job runs over all of them and
its tables are read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.schemas import STREAM_ENVELOPE, STREAM_EVENT
from tidemark.session import scratch
from tidemark.sources.files import bytes_of, cores, read_event_lines
from tidemark.streaming import events as ev, folds, jobs
from tidemark.streaming.store import EventStore
from tidemark.testbed.ctes import avg_money
from tidemark.testbed.registry import count_rows, query
from tidemark.testbed.views import Views

RUN_DAY = "2024-06-01"
PIECE_BYTES = 64 << 20
LEAST_BYTES = 1 << 20


def run_at():
    return F.lit(RUN_DAY).cast("timestamp")


def staged(v: Views) -> tuple[str, jobs.StreamPaths]:
    root = scratch(v.spark, "stream")
    v.envelopes.write.parquet(f"{root}/in")
    return f"{root}/in", jobs.StreamPaths(f"{root}/out")


def source(v: Views, path: str, **options) -> DataFrame:
    return jobs.envelope_source(v.spark, path, **options)


def finish(job) -> None:
    job.awaitTermination()


def fan_out_run(v: Views) -> jobs.StreamPaths:
    path, paths = staged(v)
    finish(jobs.run_stream(source(v, path), paths, run_at()))
    return paths


@query(
    "s04_k04_stream_source_to_table",
    """SELECT CAST(user_id AS VARCHAR) AS partition_key, count(*) AS n,
      max(ts + to_seconds(CASE WHEN event_id % 41 = 0 THEN 3 * 86400 ELSE 5 END)) AS newest FROM
      (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 37 = 0) GROUP BY 1""",
)
def _(v):
    """Envelopes from a stream source, appended as they are to one table."""
    path, paths = staged(v)
    rows = source(v, path).withColumn("day", F.to_date("approximateArrivalTimestamp"))
    finish(jobs.write_stream(
        rows, paths.at("bronze", "envelopes"), paths.checkpoint("bronze"), available_now=True,
        partition_by="day",
    ))
    key = F.substring("partitionKey", 2, 100).alias("partition_key")
    return v.spark.read.parquet(paths.at("bronze", "envelopes")).groupBy(key).agg(
        count_rows(), F.max("approximateArrivalTimestamp").alias("newest")
    )


@query(
    "t02_dedup_within_watermark",
    """SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM ev_tagged GROUP BY 1""",
)
def _(v):
    path, paths = staged(v)
    rows = ev.prepare(source(v, path), run_at())
    finish(jobs.write_stream(rows, paths.at("silver", "events"), paths.checkpoint("events"), True))
    return v.spark.read.parquet(paths.at("silver", "events")).groupBy("event_type").agg(
        count_rows(), F.countDistinct("event_id").alias("ids")
    )


@query(
    "t01_watermark_drops_late_rows",
    """SELECT event_type, count(*) AS n FROM ev_tagged, (SELECT max(event_timestamp) FILTER (k % 2 = 0)
        - INTERVAL 10 MINUTE AS mark FROM ev_sent WHERE k % 101 <> 0)
      WHERE k % 2 = 0 OR event_timestamp > date_trunc('millisecond', mark) GROUP BY 1""",
)
def _(v):
    """Even events first, odd ones after: of these only the ones within ten minutes are taken."""
    path, paths = staged(v)
    number = F.split("sequenceNumber", "-")[0].cast("bigint")
    for half in (0, 1):
        part = f"{paths.root}/halves"
        v.spark.read.parquet(path).filter(number % 2 == half).write.mode("append").parquet(part)
        rows = ev.prepare(source(v, part), run_at())
        finish(jobs.write_stream(rows, paths.at("silver", "events"), paths.checkpoint("events"), True))
    return v.spark.read.parquet(paths.at("silver", "events")).groupBy("event_type").agg(count_rows())


@query(
    "t03_late_side_output",
    "SELECT event_id, event_type, event_timestamp FROM ev_sent WHERE k % 41 = 0 AND k % 101 <> 0",
)
def _(v):
    path, paths = staged(v)
    finish(jobs.run_side_output(source(v, path), paths, "late_events"))
    return v.spark.read.parquet(paths.at("rejected", "late_events")).select(
        "event_id", "event_type", "event_timestamp"
    )


@query(
    "t04_dead_letters",
    "SELECT k || '-' || copy AS sequence_number, 30 AS kept FROM ev_sent WHERE k % 101 = 0",
)
def _(v):
    path, paths = staged(v)
    finish(jobs.run_side_output(source(v, path), paths, "dead_letters"))
    return v.spark.read.parquet(paths.at("rejected", "dead_letters")).select(
        "sequence_number", F.length("raw_data").alias("kept")
    )


_COUNTS = f"""SELECT 'rejected/events' AS table_name, count(*) AS row_count FROM ev_rejected
  UNION ALL SELECT 'silver/transactions', count(*) FROM ev_valid WHERE event_type = 'transaction'
  UNION ALL SELECT 'silver/payments', count(*) FROM ev_valid WHERE event_type = 'payment'
  UNION ALL SELECT 'silver/trades', count(*) FROM ev_valid WHERE event_type = 'trade'
  UNION ALL SELECT 'gold/fact_transaction', count(*) FROM ev_valid WHERE event_type = 'transaction'
  UNION ALL SELECT 'gold/fact_payment', count(*) FROM ev_valid WHERE event_type = 'payment'
  UNION ALL SELECT 'gold/fact_trade', count(*) FROM ev_valid WHERE event_type = 'trade'"""


@query("k03_t05_foreach_batch_fan_out", _COUNTS)
def _(v):
    paths = fan_out_run(v)
    tables = ["rejected/events", "silver/transactions", "silver/payments", "silver/trades",
              "gold/fact_transaction", "gold/fact_payment", "gold/fact_trade"]
    return jobs.union_counts({t: jobs.stream_table(v.spark, paths, *t.split("/")) for t in tables})


@query(
    "t05_stream_fact_trade",
    f"""SELECT event_id, trade_id, account_id, security_id, CAST(quantity AS DOUBLE) AS quantity,
      CAST(transaction_amount AS DOUBLE) AS transaction_amount, side, event_timestamp, risk_score,
      '{RUN_DAY}' AS processing_date FROM stream_trades""",
)
def _(v):
    """Gold trades of the streaming job equal the batch result on the same events."""
    paths = fan_out_run(v)
    return jobs.stream_table(v.spark, paths, "gold", "fact_trade").select(
        "event_id", "trade_id", "account_id", "security_id", "quantity", "transaction_amount",
        "side", "event_timestamp", "risk_score", "processing_date",
    )


@query(
    "a20_stream_batch_counts",
    f"""SELECT '{RUN_DAY}' AS processing_date, count(*) AS input_rows,
      count(*) FILTER (rejection_reason IS NULL) AS valid_rows,
      count(*) FILTER (rejection_reason IS NOT NULL) AS rejected_rows,
      count(*) FILTER (rejection_reason IS NULL AND event_type = 'transaction') AS transaction_rows,
      count(*) FILTER (rejection_reason IS NULL AND event_type = 'payment') AS payment_rows,
      count(*) FILTER (rejection_reason IS NULL AND event_type = 'trade') AS trade_rows FROM ev_tagged""",
)
def _(v):
    paths = fan_out_run(v)
    return v.spark.read.parquet(paths.at("audit", "batch_counts")).drop("batch_id", "batch_key")


@query("t07_new_checkpoint_keeps_rows", _COUNTS)
def _(v):
    """Half the envelopes, then the other half with a new checkpoint: all rows stay."""
    path, paths = staged(v)
    number = F.split("sequenceNumber", "-")[0].cast("bigint")
    for half in (0, 1):
        part = f"{paths.root}/half{half}"
        v.spark.read.parquet(path).filter(number % 2 == half).write.parquet(part)
        finish(jobs.run_stream(source(v, part), paths, run_at(),
                               checkpoint=paths.checkpoint(f"fan_out_{half}")))
    tables = ["rejected/events", "silver/transactions", "silver/payments", "silver/trades",
              "gold/fact_transaction", "gold/fact_payment", "gold/fact_trade"]
    return jobs.union_counts({t: jobs.stream_table(v.spark, paths, *t.split("/")) for t in tables})


@query(
    "t08_stored_stream_checks",
    """SELECT 'streaming_events_microbatch' AS suite_name, 'stream_microbatch' AS stage, 1::BIGINT AS n""",
)
def _(v):
    """The summary of a batch's checks is kept and read back."""
    paths = fan_out_run(v)
    return v.spark.read.parquet(paths.at("audit", "validation_results")).groupBy(
        "suite_name", "stage").agg(count_rows())


@query("t07_replay_after_restart", _COUNTS)
def _(v):
    """The job runs twice over the same input with a lost checkpoint: tables stay the same."""
    path, paths = staged(v)
    finish(jobs.run_stream(source(v, path), paths, run_at()))
    replay = jobs.StreamPaths(paths.root)
    replay.checkpoint = lambda name: paths.at("checkpoints_after_loss", name)
    finish(jobs.run_stream(source(v, path), replay, run_at()))
    tables = ["rejected/events", "silver/transactions", "silver/payments", "silver/trades",
              "gold/fact_transaction", "gold/fact_payment", "gold/fact_trade"]
    return jobs.union_counts({t: jobs.stream_table(v.spark, paths, *t.split("/")) for t in tables})


def time_cuts(v: Views, path: str, n: int):
    """The envelopes as ``n`` frames, each with the next stretch of event time. One pass puts every row
    into the folder of its stretch; a frame reads its own folder only."""
    late = F.split("sequenceNumber", "-")[0].cast("bigint") % 41 == 0
    delay = F.when(late, 3 * 86400).otherwise(5)
    happened = F.unix_seconds("approximateArrivalTimestamp") - delay
    rows = v.spark.read.parquet(path).withColumn("happened", happened)
    first, last = rows.agg(F.min("happened"), F.max("happened")).first()
    place = F.floor((F.col("happened") - first) * n / (last - first + 1)).cast("int")
    folder = f"{path}_places_{n}"
    rows.withColumn("place", place).filter("place is not null").drop("happened").write.partitionBy(
        "place").parquet(folder)
    schema = T.StructType([*STREAM_ENVELOPE.fields, T.StructField("place", T.IntegerType())])
    placed = v.spark.read.schema(schema).parquet(folder)
    for i in range(n):
        yield placed.filter(F.col("place") == i).drop("place")


def pieces_of(v: Views, path: str, batches: int) -> int:
    """Files for each of ``batches`` equal batches of a folder's rows: one, or as many as keep a file at
    about ``PIECE_BYTES``, or one for each core if it gets ``LEAST_BYTES``: a task reads a whole file."""
    share = bytes_of(v.spark, path) // batches
    return max(1, -(-share // PIECE_BYTES), min(share // LEAST_BYTES, cores(v.spark)))


def cut_by_time(v: Views, path: str, n: int) -> DataFrame:
    """A stream of the envelopes in ``n`` batches, one after the other in event time. A batch is one
    file, or equally many files for each if the rows are many."""
    out, pieces = f"{path}_cut_{n}", pieces_of(v, path, n)
    for part in time_cuts(v, path, n):
        part = part.coalesce(1) if pieces == 1 else part.repartition(pieces)
        part.write.mode("append").parquet(out)
    return source(v, out, maxFilesPerTrigger=str(pieces))


@query(
    "a06_a08_marts_folded_by_batch",
    f"""SELECT 'stream_trade_performance' AS mart, concat_ws('|', security_id, currency_code, side,
        CAST(CAST(event_timestamp AS DATE) AS VARCHAR)) AS key, count(*) AS n, NULL::BIGINT AS m,
        CAST(sum(transaction_amount) AS DOUBLE) AS amount, CAST({avg_money('price')} AS DOUBLE) AS measure
      FROM stream_trades GROUP BY 2
    UNION ALL SELECT 'trade_minute_metrics', concat_ws('|', security_id, currency_code, side,
        CAST(trade_minute AS VARCHAR)), count(*), NULL, CAST(sum(transaction_amount) AS DOUBLE),
        CAST(max(risk_score) AS DOUBLE) FROM stream_trades GROUP BY 2
    UNION ALL SELECT 'customer_trade_exposure', concat_ws('|', customer_id, account_id, security_id,
        currency_code), count(*) FILTER (side = 'BUY'), count(*) FILTER (side = 'SELL'),
        CAST(sum(transaction_amount) AS DOUBLE),
        CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS DOUBLE)
      FROM stream_trades GROUP BY 2
    UNION ALL SELECT 'stream_reconciliation', '{RUN_DAY}', a, r, CAST(amount AS DOUBLE),
        CAST(r AS DOUBLE) / (a + r) FROM
        (SELECT count(*) AS a, sum(transaction_amount) AS amount FROM stream_trades),
        (SELECT count(*) AS r FROM ev_rejected)""",
)
def _(v):
    """The job takes three stretches of time, one run each; after each run the marts fold in what came.
    They equal aggregates over all events."""
    path, paths = staged(v)
    for part in time_cuts(v, path, 3):
        part.write.mode("append").parquet(f"{path}_cut")
        finish(jobs.run_stream(source(v, f"{path}_cut"), paths, run_at(), validate=False))
        folds.update_marts(v.spark, paths, buckets=4)
    text = {
        "stream_trade_performance": (
            ["security_id", "currency_code", "side", F.col("trade_date").cast("string")],
            "trade_count", None, "total_notional_amount", "avg_trade_price"),
        "trade_minute_metrics": (
            ["security_id", "currency_code", "side",
             F.date_format("trade_minute", "yyyy-MM-dd HH:mm:ss")],
            "trade_count", None, "total_transaction_amount", "max_risk_score"),
        "customer_trade_exposure": (
            ["customer_id", "account_id", "security_id", "currency_code"],
            "buy_trade_count", "sell_trade_count", "gross_notional_amount", "net_quantity"),
        "stream_reconciliation": (
            [F.col("processing_date").cast("string")], "accepted_trade_count",
            "rejected_event_count", "accepted_notional_amount", "rejection_ratio"),
    }
    out = None
    for name, (key, n, m, amount, measure) in text.items():
        rows = folds.read_mart(v.spark, paths, name, buckets=4).select(
            F.lit(name).alias("mart"), F.concat_ws("|", *key).alias("key"),
            F.col(n).cast("bigint").alias("n"),
            (F.col(m) if m else F.lit(None)).cast("bigint").alias("m"),
            F.col(amount).cast("double").alias("amount"), F.col(measure).cast("double").alias("measure"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("t05_replay_in_other_cuts", _COUNTS)
def _(v):
    """The job runs over three stretches of time, one a batch, then with a new checkpoint over two that
    cut the same events otherwise: every event is stored once."""
    path, paths = staged(v)
    for n in (3, 2):
        finish(jobs.run_stream(
            cut_by_time(v, path, n), paths, run_at(),
            checkpoint=paths.checkpoint(f"cut_{n}"), validate=False))
    return jobs.union_counts({"/".join(t): jobs.stream_table(v.spark, paths, *t)
                              for t in jobs.STREAM_TABLES})


@query(
    "k03_pack_closed_days",
    f"""SELECT table_name, row_count, true AS fewer_files FROM ({_COUNTS})
    UNION ALL SELECT 'batches', 20, true""",
)
def _(v):
    """Twenty batches, whose day is then packed: the rows stay, readers open fewer files, before and
    after the packed files go."""
    path, paths = staged(v)
    finish(jobs.run_stream(cut_by_time(v, path, 20), paths, run_at(), validate=False))
    store = EventStore(v.spark, paths.root)
    before = store.files().count()
    packed = store.pack("2024-06-02")
    after = store.files().count()
    store.drop_packed_files()
    fewer = after <= before / 4 and store.files().count() == after
    batches = v.spark.range(1).select(
        F.lit("batches").alias("table_name"), F.lit(packed).cast("bigint").alias("row_count"))
    counts = jobs.union_counts({"/".join(t): jobs.stream_table(v.spark, paths, *t)
                                for t in jobs.STREAM_TABLES})
    return counts.unionByName(batches).withColumn("fewer_files", F.lit(fewer))


@query(
    "t10_minute_windows",
    f"""SELECT security_id, currency_code, side, trade_minute, count(*) AS trade_count,
      CAST(sum(quantity) AS DOUBLE) AS total_quantity,
      CAST(sum(transaction_amount) AS DOUBLE) AS total_transaction_amount,
      {avg_money('price')} AS avg_trade_price, '2024-06-01' AS processing_date,
      max(risk_score) AS max_risk_score FROM stream_trades
      WHERE trade_minute + INTERVAL 1 MINUTE <= (SELECT max(event_timestamp) FROM ev_sent
        WHERE k % 101 <> 0) - INTERVAL 10 MINUTE GROUP BY 1, 2, 3, 4""",
)
def _(v):
    """Windows the watermark has passed; the newest ten minutes are still open."""
    path, paths = staged(v)
    finish(jobs.run_minute_windows(source(v, path), paths, run_at()))
    return v.spark.read.parquet(paths.at("gold", "trade_minutes"))


@query(
    "t11_bounded_micro_batches",
    """SELECT event_type, count(*) AS n, count(DISTINCT k || '-' || copy) AS records FROM ev_sent
    GROUP BY 1""",
)
def _(v):
    """A bounded number of files per micro-batch, one if the records are few; a stateless copy of the
    records, so nothing depends on order. All that was sent is stored, each record once; what a record
    is about is looked up in the events table."""
    path, paths = staged(v)
    pieces = pieces_of(v, path, 4)
    v.spark.read.parquet(path).repartition(4 * pieces, F.xxhash64("sequenceNumber")).write.parquet(
        f"{path}_sliced")
    parsed = ev.parse_envelope(source(v, f"{path}_sliced", maxFilesPerTrigger=str(pieces)))
    kept = parsed.select("sequence_number", "raw_data")
    finish(jobs.write_stream(
        kept, paths.at("bronze", "raw"), paths.checkpoint("raw"), True, partition_by=None))
    kinds = v.table("events").select(
        "event_id",
        F.when(F.col("event_type").isin("purchase", "signup"), "trade")
        .when(F.col("event_type") == "click", "transaction")
        .when(F.col("event_type") == "view", "payment").otherwise("error").alias("event_type"),
    )
    event_id = F.split("sequence_number", "-")[0].cast("bigint").alias("event_id")
    stored = v.spark.read.parquet(paths.at("bronze", "raw")).select(event_id, "sequence_number")
    return stored.join(kinds, "event_id").groupBy("event_type").agg(
        count_rows(), F.countDistinct("sequence_number").alias("records"))


@query(
    "s03_event_lines_stream",
    """SELECT event_type, count(*) AS n, true AS has_file FROM ev_sent WHERE k % 101 <> 0 GROUP BY 1""",
)
def _(v):
    """JSON-lines event files read as a stream."""
    _, paths = staged(v)
    lines = paths.at("bronze", "lines")
    v.parsed.filter("not parse_failed").select(*STREAM_EVENT.names).write.json(lines)
    rows = read_event_lines(v.spark, lines, STREAM_EVENT, streaming=True)
    finish(jobs.write_stream(
        rows, paths.at("silver", "lines"), paths.checkpoint("lines"), True, partition_by=None))
    return v.spark.read.parquet(paths.at("silver", "lines")).groupBy("event_type").agg(
        count_rows(), F.bool_and(F.col("source_file").contains("lines")).alias("has_file"))


@query(
    "t09_recompute_job",
    """SELECT 'fact_trade' AS table_name, count(*) AS n FROM stream_trades
    UNION ALL SELECT 'trade_minute_metrics', count(*) FROM
      (SELECT DISTINCT security_id, currency_code, side, trade_minute FROM stream_trades)
    UNION ALL SELECT 'customer_trade_exposure', count(*) FROM
      (SELECT DISTINCT customer_id, account_id, security_id, currency_code FROM stream_trades)""",
)
def _(v):
    _, paths = staged(v)
    good = v.parsed.filter("not parse_failed").drop(*ev.ENVELOPE_COLUMNS)
    jobs.run_recompute(good, paths, run_at())
    names = ["fact_trade", "trade_minute_metrics", "customer_trade_exposure"]
    counts = jobs.union_counts({n: v.spark.read.parquet(paths.at("gold", n)) for n in names})
    return counts.withColumnRenamed("row_count", "n")
