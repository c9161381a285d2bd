import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import recon
from tidemark.plans import batch
from tidemark.schemas import STREAM_EVENT, struct
from tidemark.session import scratch
from tidemark.sinks import tables
from tidemark.sources import files


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def test_bronze_json_and_csv(spark, tmp_path, rows):
    row = {"customer_id": "c1", "full_name": "N", "email": "e", "country_code": "US", "risk_score": 5, "created_at": "2026-01-01T00:00:00Z"}
    put(tmp_path / "customers/customers_20260101T000000Z.json", json.dumps([row, {"customer_id": "c2"}]))
    put(tmp_path / "customers/customers_20260102T000000Z.json", json.dumps([{"customer_id": "c3"}], indent=1))
    put(tmp_path / "customers/customers_20260102T000000Z.csv", "customer_id,full_name,email,country_code,risk_score,created_at\nc9,NULL,null,,7,2026-01-01T00:00:00Z\n")
    df = files.read_bronze(spark, str(tmp_path), "customers")
    assert rows(df, "customer_id", "risk_score") == [("c1", 5), ("c2", None), ("c3", None)]
    got = files.read_bronze(spark, str(tmp_path), "customers", "csv").head()
    assert (got.customer_id, got.full_name, got.email, got.country_code, got.risk_score) == ("c9", None, None, None, 7)


def test_discovery(spark, tmp_path, rows):
    for name in ["transactions_20260101T000000Z.json", "transactions_20260301T000000Z.csv", "daily_account_balances_20260101T000000Z.json",
                 "transactions_2026.json", "unknown_20260101T000000Z.json", "notes.txt"]:
        put(tmp_path / "in" / name.split("_2")[0] / name, "[]")
    root = str(tmp_path / "in")
    assert len(rows(files.discover_batch_files(spark, root))) == 3
    latest = rows(files.discover_batch_files(spark, root, latest_only=True), "dataset_name", "filename", "source_format")
    assert latest == [("daily_account_balances", "daily_account_balances_20260101T000000Z.json", "json"),
                      ("transactions", "transactions_20260301T000000Z.csv", "csv")]
    assert files.latest_dataset_file(spark, root, "transactions").head().file_timestamp == "20260301T000000Z"


def test_manifest(spark, tmp_path, rows):
    good = put(tmp_path / "payments/payments_20260101T000000Z.json", json.dumps([{"payment_id": "p"}, {"payment_id": "q"}]))
    put(tmp_path / "payments/payments_20260102T000000Z.json", "[]")
    put(tmp_path / "payments/payments-x.json", json.dumps([{"payment_id": "p"}]))
    at = F.lit("2026-01-03 04:05:06").cast("timestamp")
    got = {r.filename: r for r in files.ingestion_manifest(spark, str(tmp_path), "payments", at).collect()}
    first = got["payments_20260101T000000Z.json"]
    assert (first.source_row_count, first.status, first.ingestion_id) == (2, "accepted", "payments-20260103T040506Z")
    assert first.source_checksum == hashlib.sha256(good.read_bytes()).hexdigest()
    assert got["payments_20260102T000000Z.json"].status == "empty" and got["payments-x.json"].status == "bad_name"


def test_landing(spark):
    df = spark.createDataFrame([("p1", "12.345", "2026-01-01T00:00:00", "7")], "payment_id string, transaction_amount string, event_timestamp string, risk_score string")
    r = files.load_landing(df, "payments", "L1").head()
    assert (r.transaction_amount, r.risk_score, r.load_id, r.event_timestamp) == (Decimal("12.35"), 7, "L1", dt.datetime(2026, 1, 1))
    bad = df.withColumn("transaction_amount", F.lit("abc"))
    assert files.load_landing(bad, "payments", "L1", on_error="null").head().transaction_amount is None
    with pytest.raises(Exception, match="cannot load transaction_amount"):
        files.load_landing(bad, "payments", "L1").collect()


def test_listings(spark, tmp_path, rows):
    path = put(tmp_path / "l.csv", "symbol,name,exchange,assetType,ipoDate,delistingDate,status\nA,Agilent,NYSE,Stock,1999-11-18,null,Active\nB,Barnes,NYSE,Stock,,,Active\n")
    assert files.read_listings(spark, str(path)).count() == 2
    assert rows(files.read_listings(spark, str(path), [" a "]), "name") == [("Agilent",)]


def test_event_lines(spark, tmp_path):
    path = put(tmp_path / "e/one.jsonl", '{"event_id": "1", "risk_score": 4}\n{"event_id": "2"}\n')
    df = files.read_event_lines(spark, str(tmp_path / "e"), STREAM_EVENT)
    assert df.count() == 2 and df.head().source_file.endswith(path.name)


def test_overwrite_scope(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("d1", 1), ("d2", 1)], "processing_date string, v int")
    second = spark.createDataFrame([("d2", 2)], "processing_date string, v int")
    tables.write_table(first, path)
    tables.write_table(second, path, replace_partitions_only=True)
    assert rows(spark.read.parquet(path), "processing_date", "v") == [("d1", 1), ("d2", 2)]
    tables.write_parquet(second, path)
    assert rows(spark.read.parquet(path), "processing_date", "v") == [("d2", 2)]


def test_register_and_repair(spark, tmp_path, rows):
    path = str(tmp_path / "ext")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    tables.write_table(df, path, "day")
    tables.register_table(spark, "ext_t", df, path, ["day"])
    assert spark.table("ext_t").count() == 0
    tables.repair_table(spark, "ext_t")
    assert rows(spark.table("ext_t")) == [(1, "a"), (2, "b")]


def test_materialize(spark, tmp_path):
    tables.materialize(spark.range(3), "m_view", "staging")
    tables.materialize(spark.range(4), "m_table", "facts", path=str(tmp_path / "m"))
    kinds = {t.name: t.tableType for t in spark.catalog.listTables()}
    assert kinds["m_view"] == "TEMPORARY" and kinds["m_table"] == "EXTERNAL"
    assert spark.table("m_table").count() == 4


def test_audit_and_inventory(spark, tmp_path):
    path = str(tmp_path / "audit")
    for n in (1, 2):
        tables.append_audit(spark.createDataFrame([(f"l{n}",)], "load_id string"), path)
    r = recon.inventory({"audit": spark.read.parquet(path)}).head()
    assert (r.table_name, r.row_count, r.file_count, r.latest_partition, r.column_names) == ("audit", 2, 2, None, "load_id")


def test_table_counts(spark, tmp_path, rows):
    paths = batch.Layout(str(tmp_path))
    tables.write_table(spark.range(5), paths.at("gold", "t"), None)
    assert rows(batch.table_counts(spark, paths, {"gold": ["t"]})) == [("gold", "t", 5)]


def test_scratch_needs_a_shared_folder(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch(spark, "x") != scratch(spark, "x")


def test_null_tokens_only_touch_text(spark, tmp_path):
    path = put(tmp_path / "c.csv", 'a,n\n"say ""hi""",1\nNULL,\n')
    df = files.read_format(spark, "csv", str(path), struct("a string, n int"))
    assert [tuple(r) for r in df.collect()] == [('say "hi"', 1), (None, None)]


def test_many_files_are_looked_up_by_few_tasks(spark, tmp_path):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, n = spark.conf.get(key), 120
    for i in range(n):
        (tmp_path / f"part_{i}.json").write_text(f'[{{"a": {i}}}, {{"a": {i}}}]')
    sc = spark.sparkContext
    sc.setJobGroup("files-by-name", "")
    try:
        df = files.read_files(spark, "json", [str(p) for p in tmp_path.iterdir()], struct("a int"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = map(sc.statusTracker().getJobInfo, sc.statusTracker().getJobIdsForGroup("files-by-name"))
    tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    assert tasks and max(tasks) <= files.LISTING_TASKS * sc.defaultParallelism < n
    assert sorted(r.a for r in df.collect()) == sorted([*range(n)] * 2)
    assert spark.conf.get(key) == before
