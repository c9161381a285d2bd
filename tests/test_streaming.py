import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.schemas import STREAM_ENVELOPE
from tidemark.operators import suites
from tidemark.sources.files import list_files
from tidemark.streaming import events as ev, folds, jobs, store as store_module
from tidemark.streaming.store import EventStore, keyed
from tidemark.testbed import q_stream
from tidemark.testbed.catalog import QUERIES
from tidemark.testbed.views import Views

T0 = dt.datetime(2024, 1, 1, 12)
RUN = lambda: F.lit("2024-06-01").cast("timestamp")


def event(i, minute=0, **over):
    return {"event_id": i, "event_type": "trade", "trade_id": f"T{i}", "account_id": "a", "customer_id": "c", "security_id": "SEC-X",
            "transaction_amount": "10.00", "currency_code": "USD", "transaction_status": "POSTED", "quantity": "2", "price": "5.00",
            "side": "BUY", "risk_score": 5, "event_timestamp": (T0 + dt.timedelta(minutes=minute)).isoformat() + "Z", **over}


def send(spark, path, payloads, start=0, late=0):
    rows = []
    for n, p in enumerate(payloads):
        data = p if p is None or isinstance(p, (bytes, str)) else json.dumps(p)
        data = data.encode() if isinstance(data, str) else data
        rows.append(("k", str(start + n), T0 + dt.timedelta(minutes=late), data))
    df = spark.createDataFrame(rows, STREAM_ENVELOPE).coalesce(1)
    df.write.mode("append").parquet(path)
    return df


MALFORMED = ['{"event_id": "x", "event_ty', "not json", '{"event_id": "y"', None]


def test_parse_envelope(spark, tmp_path):
    df = send(spark, str(tmp_path / "in"), [event("1"), *MALFORMED, event(None), event("2", transaction_amount="abc"), {"risk_score": "high"}])
    parsed = ev.parse_envelope(df).orderBy("sequence_number").collect()
    assert [r.parse_failed for r in parsed] == [False, True, True, True, True, False, False, True]
    assert ev.dead_letters(ev.parse_envelope(df)).count() == 5


@pytest.mark.parametrize(
    "over, reason",
    [
        ({}, None),
        ({"currency_code": "ZZZ", "risk_score": 900}, "invalid_currency"),
        ({"risk_score": 101, "transaction_amount": "-1"}, "invalid_risk_score"),
        ({"transaction_amount": "-1", "side": "X"}, "negative_amount"),
        ({"side": "HOLD"}, "invalid_trade_record"),
        ({"trade_id": None}, "invalid_trade_record"),
        ({"transaction_amount": "abc"}, "invalid_trade_record"),
        ({"risk_score": None}, "invalid_trade_record"),
        ({"currency_code": None}, "invalid_trade_record"),
        ({"event_type": "transaction"}, "invalid_transaction_record"),
        ({"event_type": "payment", "payment_id": "p"}, "invalid_payment_record"),
        ({"event_type": "payment", "payment_id": "p", "transaction_status": "SETTLED"}, None),
        ({"event_type": "transaction", "transaction_id": "t", "transaction_type": "FEE"}, None),
        ({"event_type": "other"}, "invalid_trade_record"),
    ],
)
def test_stream_rejections(spark, tmp_path, over, reason):
    df = ev.parse_envelope(send(spark, str(tmp_path / "in"), [event("1", **over)]))
    assert ev.tag_events(df).head().rejection_reason == reason


def test_late_events(spark, tmp_path):
    df = send(spark, str(tmp_path / "in"), [event("old"), event("new", minute=4318)], late=3 * 1440)
    assert [r.event_id for r in ev.late_events(ev.parse_envelope(df)).collect()] == ["old"]


def tables(spark, paths):
    names = ["rejected/events", "silver/trades", "gold/fact_trade", "silver/payments", "silver/transactions"]
    return {t: jobs.stream_table(spark, paths, *t.split("/")).count() for t in names}


def test_stream_dedup_fan_out_and_replay(spark, tmp_path):
    src, paths = str(tmp_path / "in"), jobs.StreamPaths(str(tmp_path / "out"))
    send(spark, src, [event("1"), event("1"), event("2", 1), event("3", 2, currency_code="ZZZ"), event(None, 2, side="SELL"),
                      event(None, 2, side="SELL"), *MALFORMED,
                      event("4", 2, event_type="payment", payment_id="p", transaction_status="SETTLED")])
    jobs.run_stream(jobs.envelope_source(spark, src), paths, RUN()).awaitTermination()
    want = {"rejected/events": 1, "silver/trades": 4, "gold/fact_trade": 4, "silver/payments": 1, "silver/transactions": 0}
    assert tables(spark, paths) == want
    # A repeat in a later batch is dropped while its id is within the delay.
    send(spark, src, [event("2", 1), event("5", 3)], start=100)
    jobs.run_stream(jobs.envelope_source(spark, src), paths, RUN()).awaitTermination()
    assert tables(spark, paths)["silver/trades"] == 5
    counts = spark.read.parquet(paths.at("audit", "batch_counts")).agg(F.sum("input_rows"), F.sum("valid_rows")).head()
    assert tuple(counts) == (7, 6)


def test_replayed_batch_replaces_its_own_rows(spark, tmp_path):
    paths = jobs.StreamPaths(str(tmp_path / "out"))
    batch = ev.with_stream_metadata(ev.parse_envelope(send(spark, str(tmp_path / "in"), [event("1"), event("2")])), RUN())
    process = jobs.fan_out(paths)
    for _ in range(2):
        process(batch, 7)
    process(batch.limit(0), 8)
    assert tables(spark, paths)["silver/trades"] == 2


def test_watermark_drops_and_reports_late_rows(spark, tmp_path):
    src, paths = str(tmp_path / "in"), jobs.StreamPaths(str(tmp_path / "out"))
    send(spark, src, [event("1", 60)])
    jobs.run_stream(jobs.envelope_source(spark, src), paths, RUN()).awaitTermination()
    send(spark, src, [event("late", 10), event("on-time", 55)], start=10)
    query = jobs.run_stream(jobs.envelope_source(spark, src), paths, RUN())
    query.awaitTermination()
    assert tables(spark, paths)["silver/trades"] == 2
    assert jobs.progress_metrics(query)["late_rows_dropped"] >= 1


def test_minute_windows_equal_batch(spark, tmp_path, rows):
    src, paths = str(tmp_path / "in"), jobs.StreamPaths(str(tmp_path / "out"))
    send(spark, src, [event(str(i), i % 5) for i in range(20)] + [event("end", 60)])
    jobs.run_minute_windows(jobs.envelope_source(spark, src), paths, RUN()).awaitTermination()
    got = rows(spark.read.parquet(paths.at("gold", "trade_minutes")), "trade_minute", "trade_count", "total_quantity")
    batch = ev.parse_envelope(spark.read.parquet(src))
    trades = ev.route(ev.with_stream_metadata(batch, RUN()), "trade").filter("event_id <> 'end'")
    assert got == rows(ev.minute_windows(trades), "trade_minute", "trade_count", "total_quantity") and len(got) == 5


def cuts(spark, tmp_path, name, groups):
    """Runs the job over files that hold the given events, one file a batch, with its own checkpoint."""
    paths = jobs.StreamPaths(str(tmp_path / "out"))
    for i, ids in enumerate(groups):
        send(spark, str(tmp_path / name), [event(x, i % 3) for x in ids], start=100 * i)
    source = jobs.envelope_source(spark, str(tmp_path / name), maxFilesPerTrigger="1")
    jobs.run_stream(source, paths, RUN(), checkpoint=paths.checkpoint(name), validate=False).awaitTermination()
    return paths


def test_every_event_once_in_other_cuts(spark, tmp_path):
    ids = [str(i) for i in range(12)]
    paths = cuts(spark, tmp_path, "a", [ids[:6], ids[6:]])
    assert tables(spark, paths)["silver/trades"] == 12
    # minute and so event day of an event are the same in each cut: replay by the first cut's minutes
    cuts(spark, tmp_path, "b", [ids[:3], ids[9:] + ["new"]])
    store = EventStore(spark, paths.root)
    got = sorted(r["identity"] for r in store.rows().collect())
    assert got == sorted([*ids, "new"])


def test_an_id_whose_batch_failed_is_stored_later(spark, tmp_path):
    paths = jobs.StreamPaths(str(tmp_path / "out"))
    batch = ev.with_stream_metadata(ev.parse_envelope(send(spark, str(tmp_path / "in"), [event("1"), event("2")])), RUN())
    store = EventStore(spark, paths.root)
    rows = keyed(ev.tag_events(batch), "x-0")
    store.remember(rows, ["2024-01"])  # the filter was written, then the batch failed
    assert store.maybe_stored(rows, ["2024-01"]).count() == 2
    jobs.fan_out(paths)(batch, 0)
    assert tables(spark, paths)["silver/trades"] == 2


def test_the_filter_knows_all_and_only_few_others(spark, tmp_path):
    store = EventStore(spark, str(tmp_path), bits=1 << 16, hashes=4)
    month = F.lit("2024-01").alias("event_month")
    ids = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("identity"), month)
    for a in range(0, 3000, 1000):
        store.remember(ids(a, a + 1000), ["2024-01"])
    assert store.maybe_stored(ids(0, 3000), ["2024-01"]).count() == 3000
    assert store.maybe_stored(ids(5000, 15000), ["2024-01"]).count() < 300
    assert store.maybe_stored(ids(0, 10), ["2024-02"]) is None


def test_packing_keeps_rows_for_old_and_new_readers(spark, tmp_path, rows):
    paths = cuts(spark, tmp_path, "a", [[f"{i}", f"{i}x"] for i in range(5)])
    store = EventStore(spark, paths.root)
    want, reader, before = rows(store.rows(), "identity"), store.rows(), store.files().count()
    assert store.pack("2024-06-01") == 0  # the day is not over
    assert store.pack("2024-06-02") == 5 and store.pack("2024-06-02") == 0
    assert rows(reader, "identity") == want == rows(store.rows(), "identity") and store.files().count() < before
    store.drop_packed_files()
    assert rows(store.rows(), "identity") == want and rows(store.rows("trades"), "identity") == want
    # a replay of packed events is still known, and later batches are added beside them
    cuts(spark, tmp_path, "b", [["0", "0x"], ["later"]])
    assert rows(store.rows(), "identity") == sorted([*want, ("later",)], key=str)
    assert store.pack("2024-06-02") >= 1 and rows(store.rows(), "identity") == sorted([*want, ("later",)], key=str)


def test_counts_and_checks_come_from_the_write(spark, tmp_path):
    paths = jobs.StreamPaths(str(tmp_path / "out"))
    send(spark, str(tmp_path / "in"), [event("1"), event("2", currency_code="ZZZ"), event("3", event_type="payment", payment_id="p", transaction_status="SETTLED")])
    jobs.run_stream(jobs.envelope_source(spark, str(tmp_path / "in")), paths, RUN()).awaitTermination()
    r = spark.read.parquet(paths.at("audit", "batch_counts")).first()
    assert (r.input_rows, r.valid_rows, r.rejected_rows, r.trade_rows, r.payment_rows, r.transaction_rows) == (3, 2, 1, 1, 1, 0)
    s = spark.read.parquet(paths.at("audit", "validation_results")).first()
    assert (s.evaluated_expectations, s.unsuccessful_expectations, s.success) == (7, 1, False)
    stored = ev.tag_events(ev.parse_envelope(spark.read.parquet(str(tmp_path / "in"))))
    plain = suites.evaluate_suite(stored.select(*suites.suite_columns(jobs.SUITE)).withColumn(
        "transaction_amount", ev.money("transaction_amount")), jobs.SUITE)
    assert plain.filter("not success").count() == 1


def test_a_failing_suite_stops_the_batch_before_it_is_stored(spark, tmp_path):
    paths = jobs.StreamPaths(str(tmp_path / "out"))
    batch = ev.with_stream_metadata(ev.parse_envelope(send(spark, str(tmp_path / "in"), [event("1", risk_score=500)])), RUN())
    with pytest.raises(suites.ValidationFailed):
        jobs.fan_out(paths, on_fail="raise")(batch, 0)
    assert tables(spark, paths)["rejected/events"] == 0


def test_stream_tables_as_views(spark, tmp_path):
    paths = jobs.StreamPaths(str(tmp_path / "out"))
    send(spark, str(tmp_path / "in"), [event("1")])
    jobs.run_stream(jobs.envelope_source(spark, str(tmp_path / "in")), paths, RUN()).awaitTermination()
    jobs.register_stream_tables(spark, paths)
    assert spark.sql("SELECT sum(quantity) AS q FROM gold_fact_trade").first().q == 2
    assert spark.table("silver_payments").count() == 0


def test_marts_take_in_each_batch_once(spark, tmp_path):
    paths = jobs.StreamPaths(str(tmp_path / "out"))
    src = str(tmp_path / "in")
    mart = folds.MARTS["customer_trade_exposure"]
    for n, payloads in enumerate(([event("1"), event("2", 1, side="SELL")], [event("3", 2, security_id=None), event("4", 2, currency_code="ZZZ")])):
        send(spark, src, payloads, start=10 * n)
        jobs.run_stream(jobs.envelope_source(spark, src), paths, RUN(), validate=False).awaitTermination()
        assert folds.update_mart(spark, paths, mart) == 1 and folds.update_mart(spark, paths, mart) == 0
    store = EventStore(spark, paths.root)
    store.pack("2024-07-01")
    assert folds.update_mart(spark, paths, mart) == 0  # packed batches are not new ones
    store.drop_packed_files()
    assert folds.update_mart(spark, paths, mart) == 0
    got = {r.security_id: (r.buy_trade_count, r.sell_trade_count, float(r.net_quantity), float(r.gross_notional_amount))
           for r in folds.read_mart(spark, paths, mart.name).collect()}
    assert got == {"SEC-X": (1, 1, 0.0, 20.0), None: (1, 0, 2.0, 10.0)}
    folds.update_mart(spark, paths, folds.MARTS["stream_reconciliation"])
    r = folds.read_mart(spark, paths, "stream_reconciliation").first()
    assert (r.accepted_trade_count, r.rejected_event_count, r.rejection_ratio) == (3, 1, 0.25)


def small_events(spark, folder, n=400):
    spark.range(n).select(
        F.col("id").alias("event_id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(
            mins=F.col("id").cast("int"))).alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.lit("purchase").alias("event_type"), (F.col("id") * 1.5).alias("value"),
        F.lit('{"k": 3}').alias("props")).write.parquet(f"{folder}/events.parquet")
    return Views(spark, folder)


def test_time_cuts_read_their_own_part_and_batches_hold_several_files(spark, tmp_path, monkeypatch):
    v = small_events(spark, str(tmp_path))
    path, paths = q_stream.staged(v)
    whole = v.spark.read.parquet(path).count()
    frames = list(q_stream.time_cuts(v, path, 4))
    assert sum(f.count() for f in frames) == whole
    assert "PartitionFilters: [isnotnull(place" in frames[1]._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(q_stream, "PIECE_BYTES", 4000)
    pieces = q_stream.pieces_of(v, path, 3)
    assert pieces > 1
    job = jobs.run_stream(q_stream.cut_by_time(v, path, 3), paths, RUN(), validate=False)
    job.awaitTermination()
    assert spark.read.parquet(f"{path}_cut_3").count() == whole
    sent = [p.numInputRows for p in job.recentProgress if p.numInputRows]
    assert len(sent) == 3 and sum(sent) >= whole
    ids = jobs.stream_table(spark, paths, "silver", "trades").filter("event_id is not null").select("event_id")
    assert ids.distinct().count() == ids.count() > 0


def test_a_batch_is_stored_with_adaptive_execution(spark, tmp_path, monkeypatch):
    src, paths = str(tmp_path / "in"), jobs.StreamPaths(str(tmp_path / "out"))
    send(spark, src, [event("1"), event("2", 1)])
    name, during, before = "spark.sql.adaptive.enabled", [], []
    write, process = EventStore.write, jobs.fan_out

    def seen(self, batch):
        during.append(self.spark.conf.get(name))
        write(self, batch)

    def outer(*args, **kwargs):
        inner = process(*args, **kwargs)

        def run(batch, number):
            before.append(batch.sparkSession.conf.get(name))
            inner(batch, number)
            before.append(batch.sparkSession.conf.get(name))
        return run

    monkeypatch.setattr(EventStore, "write", seen)
    monkeypatch.setattr(jobs, "fan_out", outer)
    jobs.run_stream(jobs.envelope_source(spark, src), paths, RUN()).awaitTermination()
    assert during == ["true"] and before and set(before) == {"false"}


def test_the_sliced_copy_bounds_its_files(spark, tmp_path, monkeypatch):
    small_events(spark, str(tmp_path))
    asked = []
    source = q_stream.source
    monkeypatch.setattr(q_stream, "PIECE_BYTES", 2000)
    monkeypatch.setattr(q_stream, "source", lambda v, path, **o: asked.append((path, o)) or source(v, path, **o))
    got = QUERIES["t11_bounded_micro_batches"](spark, str(tmp_path)).collect()
    (path, options), = asked
    files = {r.path for r in list_files(spark, path).collect() if r.path.endswith(".parquet")}
    assert int(options["maxFilesPerTrigger"]) > 1 and len(files) > 4
    assert [(r.event_type, r.n, r.records) for r in got] == [("trade", 411, 411)]


def test_state_is_kept_on_disk_unless_the_session_says_otherwise(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    kinds = {}
    try:
        for setting in (None, heap):
            root = tmp_path / str(setting)
            paths = jobs.StreamPaths(str(root / "out"))
            send(spark, str(root / "in"), [event("1"), event("1"), event(None, 1)])
            spark.conf.unset(name) if setting is None else spark.conf.set(name, setting)
            query = jobs.run_stream(jobs.envelope_source(spark, str(root / "in")), paths, RUN())
            assert spark.conf.get(name, None) == setting
            query.awaitTermination()
            state = root / "out" / "checkpoints" / "fan_out" / "state" / "0"
            kinds[setting] = {p.suffix for p in state.rglob("1.*")} - {".crc"}
            rows = EventStore(spark, paths.root).rows().collect()
            assert sorted(r.identity for r in rows) == ["1", "sequence:2"]
            assert all("_identity" not in json.loads(r.raw_payload) for r in rows)
    finally:
        spark.conf.set(name, before)
    assert kinds[None] == {".zip"} and kinds[heap] == {".delta"}


def meets(monkeypatch, owner, name, barrier, only=lambda *a: True):
    """Calls of a method wait for each other, at most 60 s."""
    inner = getattr(owner, name)

    def call(self, *args, **kwargs):
        if only(*args):
            barrier.wait(60)
        return inner(self, *args, **kwargs)

    monkeypatch.setattr(owner, name, call)


def test_ids_are_remembered_beside_the_comparison(spark, tmp_path, monkeypatch):
    barrier = threading.Barrier(2)
    meets(monkeypatch, EventStore, "remember", barrier)
    meets(monkeypatch, EventStore, "_unknown", barrier)
    paths = cuts(spark, tmp_path, "a", [["1", "2"], ["3", "4"]])
    cuts(spark, tmp_path, "b", [["1", "5"]])
    store = EventStore(spark, paths.root)
    assert sorted(r["identity"] for r in store.rows().collect()) == ["1", "2", "3", "4", "5"]
    assert store.maybe_stored(store.rows(), ["2024-01"]).count() == 5


def test_routes_are_packed_side_by_side(spark, tmp_path, monkeypatch, rows):
    paths, src = jobs.StreamPaths(str(tmp_path / "out")), str(tmp_path / "in")
    send(spark, src, [event("1"), event("2", currency_code="ZZZ")])
    jobs.run_stream(jobs.envelope_source(spark, src), paths, RUN()).awaitTermination()
    store = EventStore(spark, paths.root)
    want = rows(store.rows(), "identity", "route")
    meets(monkeypatch, type(store.packed), "put", threading.Barrier(2), lambda df, name: name == "packed")
    assert store.pack("2024-06-02") == 1
    store.drop_packed_files()
    assert rows(store.rows(), "identity", "route") == want and len(want) == 2
    assert [r.batch_key for r in store.batches().collect()] == [r.batch_key for r in store.rows().select("batch_key").distinct().collect()]


def test_filters_are_sent_or_shuffled_alike(spark, tmp_path, monkeypatch, rows):
    store = EventStore(spark, str(tmp_path), bits=1 << 16)
    ids = spark.range(50).select(F.col("id").cast("string").alias("identity"), F.concat(F.lit("2024-0"), 1 + F.col("id") % 3).alias("event_month"))
    months = ["2024-01", "2024-02", "2024-03"]
    store.remember(ids, months)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    sent = store.maybe_stored(ids, months)
    monkeypatch.setattr(store_module, "SENT_MONTHS", 2)
    shuffled = store.maybe_stored(ids, months)
    assert "strategy=broadcast" in plan(sent) and "strategy=broadcast" not in plan(shuffled)
    assert rows(sent) == rows(shuffled) == rows(ids, "identity")


def test_the_time_of_a_batch_is_any_time(spark):
    at = [None, "0001-01-01 00:00:00", "+12024-02-03 04:05:06", "2024-01-01 00:00:00.000001"]
    df = spark.createDataFrame([(x, "m" if x else "none") for x in at], "t string, event_month string").select(
        F.expr("try_cast(t AS timestamp)").alias("event_timestamp"), "event_month")
    spans = store_module.months_of(df)
    assert spans["none"] == (None, None) and spans["m"][0] < 0 < spans["m"][1]


def test_a_small_table_is_dealt_to_all_cores(spark, tmp_path, monkeypatch):
    v = small_events(spark, str(tmp_path))
    v.table("events").coalesce(1).write.parquet(str(tmp_path / "one" / "events.parquet"))
    v = Views(spark, str(tmp_path / "one"))
    path, _ = q_stream.staged(v)
    files = [r.path for r in list_files(spark, path).collect() if r.path.endswith(".parquet")]
    assert len(files) == spark.sparkContext.defaultParallelism
    assert q_stream.pieces_of(v, path, 2) == 1
    monkeypatch.setattr(q_stream, "LEAST_BYTES", 1000)
    assert 1 < q_stream.pieces_of(v, path, 2) <= spark.sparkContext.defaultParallelism
