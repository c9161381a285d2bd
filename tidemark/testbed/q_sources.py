"""Sources and sinks: data derived from the tables is staged in the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.plans import batch, incremental, model
from tidemark.schemas import CURRENCIES, STREAM_EVENT, struct
from tidemark.session import scratch
from tidemark.sinks import tables
from tidemark.sinks.versions import KeyedTable
from tidemark.operators import history
from tidemark.operators.clean import with_load_metadata
from tidemark.sources import files
from tidemark.testbed.ctes import lit, total
from tidemark.testbed.registry import query
from tidemark.testbed.views import Views

BY_CURRENCY = f"""SELECT currency_code, count(*) AS n, count(transaction_id) AS ids,
  {total('transaction_amount')} AS amount, max(event_timestamp) AS newest FROM txn_raw GROUP BY 1"""


def _monthly(df: DataFrame) -> DataFrame:
    """Load month as the partition, so a test table has few folders."""
    return df.withColumn("load_month", F.date_format("processing_date", "yyyy-MM"))


def by_currency(df: DataFrame) -> DataFrame:
    return df.groupBy("currency_code").agg(
        F.count("*").alias("n"),
        F.count("transaction_id").alias("ids"),
        F.sum(F.col("transaction_amount").cast("decimal(18,2)")).alias("amount"),
        F.max("event_timestamp").alias("newest"),
    )


def stage_json_lists(v: Views, root: str | None = None, keys=None,
                     stamp: str = "20240101T000000Z", per_list: int = 1000) -> str:
    """Transactions as bronze files, one JSON list per file. A list holds the rows of ``per_list``
    consecutive order keys, so its size does not grow with the table."""
    root = root or scratch(v.spark, "bronze")
    rows = v.transactions_keyed if keys is None else v.transactions_keyed.filter(keys)
    fields = [c for c in rows.columns if c != "o_orderkey"]
    block = F.floor(F.col("o_orderkey") / per_list).alias("_block")
    lists = rows.groupBy(block).agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value"))
    path = f"{root}/transactions/transactions_{stamp}.json"
    lists.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return root


@query("s01_bronze_json_scan", BY_CURRENCY)
def _(v):
    root = stage_json_lists(v)
    return by_currency(files.read_bronze(v.spark, root, "transactions"))


@query(
    "k01_two_daily_loads",
    f"""SELECT 'silver' AS layer, count(*) AS n, count(DISTINCT transaction_id) AS keys,
      {total('transaction_amount')} AS amount FROM transactions
    UNION ALL SELECT 'gold', count(*), count(DISTINCT transaction_id), {total('transaction_amount')}
      FROM transactions""",
)
def _(v):
    """Two days' files, the second day with all of the first again: one row per key in each layer."""
    root = scratch(v.spark, "days")
    paths, even = batch.Layout(root), F.col("o_orderkey") % 2 == 0
    for day, keys in (("01", even), ("02", F.lit(True))):
        stage_json_lists(v, f"{root}/bronze", keys, f"202406{day}T000000Z", per_list=10_000)
        run_at = F.lit(f"2024-06-{day} 02:00:00").cast("timestamp")
        batch.load_transactional(v.spark, paths, "transactions", batch.Options(run_at=run_at))
    layers = {"silver": paths.at("silver", "transactions"), "gold": paths.at("gold", "fact_transaction")}
    parts = [v.spark.read.parquet(path).select(F.lit(layer).alias("layer"), "transaction_id",
                                               "transaction_amount") for layer, path in layers.items()]
    return parts[0].union(parts[1]).groupBy("layer").agg(
        F.count("*").alias("n"), F.countDistinct("transaction_id").alias("keys"),
        F.sum("transaction_amount").alias("amount"))


@query(
    "r06_q10_rows_written_by_the_load",
    """SELECT status, source_row_count, target_row_count, rejected_record_count,
      CAST(source_amount_sum AS DOUBLE) AS source_amount_sum,
      CAST(target_amount_sum AS DOUBLE) AS target_amount_sum, duplicate_identifier_count FROM (
      SELECT 'OK' AS status, count(*) AS source_row_count,
        count(*) FILTER (rejection_reason IS NULL) AS target_row_count,
        count(*) FILTER (rejection_reason IS NOT NULL) AS rejected_record_count,
        sum(transaction_amount) AS source_amount_sum,
        sum(transaction_amount) FILTER (rejection_reason IS NULL) AS target_amount_sum,
        0::BIGINT AS duplicate_identifier_count FROM txn_tagged
      UNION ALL SELECT 'MISMATCH', count(*), 2 * count(*) FILTER (rejection_reason IS NULL),
        count(*) FILTER (rejection_reason IS NOT NULL), sum(transaction_amount),
        2 * sum(transaction_amount) FILTER (rejection_reason IS NULL),
        count(transaction_id) FILTER (rejection_reason IS NULL) FROM txn_tagged)""",
)
def _(v):
    """The load appends a row that balances; a silver table with every row twice gives one that does
    not."""
    root = scratch(v.spark, "reconciled")
    paths = batch.Layout(stage_json_lists(v, f"{root}/bronze") and root)
    options = batch.Options(run_at=F.lit("2024-06-01 02:00:00").cast("timestamp"))
    batch.load_transactional(v.spark, paths, "transactions", options)
    silver = v.spark.read.parquet(paths.at("silver", "transactions"))
    rejected = v.spark.read.parquet(paths.at("rejected", "transactions"))
    batch.reconcile(v.spark, paths, "transactions", silver.unionByName(
        rejected, allowMissingColumns=True), silver.union(silver), rejected, options)
    return v.spark.read.parquet(paths.at("audit", "reconciliation_results")).select(
        "status", "source_row_count", "target_row_count", "rejected_record_count",
        "source_amount_sum", "target_amount_sum", "duplicate_identifier_count")


# Day 1 sends the even order keys, day 2 the odd ones and every tenth with an id again: a row without an
# id is a copy of nothing, so sending it again would add one.
_DAYS = {
    "days": """SELECT 1 AS day, o_orderkey, 1 + (o_orderkey % 50 = 0)::INT AS copies FROM orders
      WHERE o_orderkey % 2 = 0 UNION ALL SELECT 2, o_orderkey, 1 + (o_orderkey % 50 = 0)::INT FROM orders
      WHERE o_orderkey % 2 = 1 OR (o_orderkey % 10 = 0 AND o_orderkey % 97 <> 0)"""
}


def two_days(v: Views) -> tuple[batch.Layout, list[dict]]:
    """Two days' files, each loaded when it comes."""
    root = scratch(v.spark, "incremental")
    paths, k, entries = batch.Layout(root), F.col("o_orderkey"), []
    for day, keys in (("01", k % 2 == 0), ("02", (k % 2 == 1) | ((k % 10 == 0) & (k % 97 != 0)))):
        stage_json_lists(v, f"{root}/bronze", keys, f"202406{day}T000000Z")
        run_at = F.lit(f"2024-06-{day} 02:00:00").cast("timestamp")
        entries.append(incremental.load_new_files(
            v.spark, paths, "transactions", batch.Options(run_at=run_at), buckets=16))
    return paths, entries


@query(
    "s07_k01_load_of_new_files",
    f"""SELECT 'silver' AS part, count(*) AS n, count(DISTINCT transaction_id) AS keys,
      {total('transaction_amount')} AS amount FROM transactions
    UNION ALL SELECT 'gold', count(*), count(DISTINCT transaction_id), {total('transaction_amount')}
      FROM transactions
    UNION ALL SELECT 'rejected', count(*), count(DISTINCT transaction_id), {total('transaction_amount')}
      FROM txn_tagged WHERE rejection_reason IS NOT NULL
    UNION ALL SELECT 'files of day ' || day, count(DISTINCT o_orderkey // 1000), NULL, NULL FROM days
      GROUP BY day""",
    _DAYS,
)
def _(v):
    """After day 2 the layers equal one load of everything, and the ledger shows that day 2 read the
    files of day 2 only."""
    paths, _ = two_days(v)
    parts = [
        incremental.layer(v.spark, paths, "transactions", name).select(
            F.lit(name).alias("part"), "transaction_id", "transaction_amount")
        for name in ("silver", "gold", "rejected")
    ]
    layers = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("part").agg(
        F.count("*").alias("n"), F.countDistinct("transaction_id").alias("keys"),
        F.sum("transaction_amount").alias("amount"))
    files_read = incremental.ledger(incremental.stored(v.spark, paths, "transactions")).groupBy(
        F.concat(F.lit("files of day "), F.dayofmonth("loaded_at").cast("string")).alias("part")
    ).agg(F.count("*").alias("n")).withColumns(
        {"keys": F.lit(None).cast("bigint"), "amount": F.lit(None).cast("decimal(28,2)")})
    return layers.unionByName(files_read)


@query(
    "k10_load_history_of_loads",
    """SELECT 'transactions' AS stage_name, 'LOADED' AS status, day, count(DISTINCT o_orderkey // 1000)
      AS files_loaded, sum(copies)::BIGINT AS rows_parsed, sum(copies)::BIGINT AS rows_loaded,
      true AS finished FROM days GROUP BY day""",
    _DAYS,
)
def _(v):
    """The rows that the loads appended; their counts come from the write itself."""
    paths, _ = two_days(v)
    order = Window.partitionBy("stage_name").orderBy("load_started_at")
    return v.spark.read.parquet(paths.at("audit", "load_history")).select(
        "stage_name", "status", F.row_number().over(order).alias("day"), "files_loaded",
        "rows_parsed", "rows_loaded",
        (F.col("load_finished_at") >= F.col("load_started_at")).alias("finished"))


@query("s02_bronze_csv_scan", BY_CURRENCY)
def _(v):
    root = scratch(v.spark, "csv")
    v.transactions_raw.write.option("header", True).csv(
        f"{root}/transactions/transactions_20240101T000000Z.csv"
    )
    return by_currency(files.read_bronze(v.spark, root, "transactions", "csv"))


@query(
    "s03_event_lines_scan",
    """SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids, true AS has_file
    FROM ev_sent WHERE k % 101 <> 0 GROUP BY 1""",
)
def _(v):
    path = scratch(v.spark, "lines")
    tables.write_bronze_json(v.parsed.filter("not parse_failed").select(*STREAM_EVENT.names), path)
    lines = files.read_event_lines(v.spark, path, STREAM_EVENT)
    return lines.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.countDistinct("event_id").alias("ids"),
        F.bool_and(F.col("source_file").endswith(".json")).alias("has_file"),
    )


@query(
    "s05_table_read_back",
    """SELECT 'rejected' AS layer, 'transactions' AS table_name, count(*) AS row_count
      FROM txn_tagged WHERE rejection_reason IS NOT NULL
    UNION ALL SELECT 'silver', 'transactions', count(*) FROM transactions""",
)
def _(v):
    paths = batch.Layout(scratch(v.spark, "tables"))
    for layer, rows in [("silver", v.transactions), ("rejected", v.transactions_rejected)]:
        tables.write_table(_monthly(rows), paths.at(layer, "transactions"), "load_month")
    return batch.table_counts(
        v.spark, paths, {"silver": ["transactions"], "rejected": ["transactions"]}
    )


@query(
    "s06_landing_load",
    f"""SELECT transaction_type, 'load-1' AS load_id, count(*) AS n, {total('transaction_amount')} AS amount,
      max(processing_timestamp) AS newest, TIMESTAMP '2024-06-01 00:00:00' AS load_timestamp
    FROM transactions GROUP BY 1, 2""",
)
def _(v):
    path = scratch(v.spark, "landing")
    model.gold(v.transactions, "transactions").write.parquet(path)
    landed = files.load_landing(
        v.spark.read.parquet(path), "transactions", "load-1",
        F.lit("2024-06-01").cast("timestamp"),
    )
    return landed.groupBy("transaction_type", "load_id").agg(
        F.count("*").alias("n"),
        F.sum("transaction_amount").alias("amount"),
        F.max("processing_timestamp").alias("newest"),
        F.max("load_timestamp").alias("load_timestamp"),
    )


# One file per order day and dataset, as a listing with a stray name in every seventh place.
_LISTING = {
    "listing": """SELECT DISTINCT 'bronze/' || ds || '/' || CASE WHEN o_custkey % 7 = 0 THEN 'x-' ELSE '' END
      || ds || '_' || strftime(o_orderdate, '%Y%m%d') || 'T000000Z.json' AS path, ds,
      strftime(o_orderdate, '%Y%m%d') || 'T000000Z' AS file_timestamp, o_custkey % 7 <> 0 AS good
      FROM orders CROSS JOIN (VALUES ('transactions'), ('daily_account_balances')) t(ds)"""
}


def _listing(v: Views) -> DataFrame:
    ds = F.explode(F.array(F.lit("transactions"), F.lit("daily_account_balances")))
    days = v.table("orders").select(
        ds.alias("ds"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.when(F.col("o_custkey") % 7 == 0, "x-").otherwise("").alias("mark"),
    )
    path = F.concat(
        F.lit("bronze/"), "ds", F.lit("/"), "mark", "ds", F.lit("_"), "day", F.lit("T000000Z.json")
    )
    return days.select(path.alias("path"), F.lit(0).cast("bigint").alias("length")).distinct()


@query(
    "s07_discover_batch_files",
    """SELECT ds AS dataset_name, file_timestamp, path FROM listing WHERE good""",
    _LISTING,
)
def _(v):
    return files.match_batch_files(_listing(v)).select("dataset_name", "file_timestamp", "path")


@query(
    "s08_latest_file_per_dataset",
    """SELECT ds AS dataset_name, max(file_timestamp) AS file_timestamp, max(path) AS path
    FROM listing WHERE good GROUP BY 1""",
    _LISTING,
)
def _(v):
    found = files.match_batch_files(_listing(v), latest_only=True)
    return found.select("dataset_name", "file_timestamp", "path")


@query(
    "s09_ingestion_manifest",
    """SELECT 'transactions' AS dataset_name, 'json' AS source_format, count(*) AS row_count,
      count(DISTINCT o_orderkey // 1000) AS files, true AS checksums_are_right FROM orders_sent""",
)
def _(v):
    """Files, rows and checksums; the checksums are compared with digests of the files read as text."""
    root = stage_json_lists(v)
    manifest = files.ingestion_manifest(v.spark, root, "transactions", recursive=True)
    digests = v.spark.read.option("recursiveFileLookup", "true").text(
        f"{root}/transactions", wholetext=True).select(
        F.col("_metadata.file_path").alias("source_path"), F.sha2("value", 256).alias("digest"))
    return manifest.join(digests, "source_path", "left").groupBy("dataset_name", "source_format").agg(
        F.sum("source_row_count").alias("row_count"), F.count("*").alias("files"),
        F.bool_and(F.col("source_checksum").eqNullSafe(F.col("digest"))).alias("checksums_are_right"),
    )


@query(
    "s10_seed_currencies",
    f"SELECT currency_code, count(*) AS n FROM txn_raw WHERE currency_code IN ({lit(CURRENCIES)}) GROUP BY 1",
)
def _(v):
    seed = files.load_seed(v.spark, CURRENCIES, "currency_code")
    kept = files.keep_seeded(v.transactions_raw, seed, "currency_code")
    return kept.groupBy("currency_code").agg(F.count("*").alias("n"))


@query(
    "s11_csv_null_tokens",
    """SELECT o_orderstatus AS status, count(*) AS n,
      count(CASE WHEN o_orderkey % 4 = 0 THEN 1 END) AS filled FROM orders GROUP BY 1""",
)
def _(v):
    path = scratch(v.spark, "formats")
    k = F.col("o_orderkey")
    note = F.when(k % 4 == 0, 'say "hi", twice').when(k % 4 == 1, "NULL").when(k % 4 == 2, "null")
    v.table("orders").select(
        F.col("o_orderstatus").alias("status"), note.otherwise("").alias("note")
    ).write.option("header", True).option("escape", '"').csv(path)
    back = files.read_format(v.spark, "csv", path, struct("status string, note string"))
    return back.groupBy("status").agg(F.count("*").alias("n"), F.count("note").alias("filled"))


@query(
    "s12_listing_csv",
    """SELECT 'TK' || p_partkey AS symbol, p_name AS name, p_type AS "assetType" FROM part
    WHERE 'TK' || p_partkey IN ('TK1', 'TK7', 'TK19')""",
)
def _(v):
    path = scratch(v.spark, "listing")
    key = F.concat(F.lit("TK"), F.col("p_partkey").cast("string"))
    v.table("part").select(
        key.alias("symbol"), F.col("p_name").alias("name"), F.lit("NYSE").alias("exchange"),
        F.col("p_type").alias("assetType"), F.lit("").alias("ipoDate"),
        F.lit("").alias("delistingDate"), F.lit("Active").alias("status"),
    ).write.option("header", True).csv(path)
    return files.read_listings(v.spark, path, ["tk1 ", "TK7", "tk19"]).select(
        "symbol", "name", "assetType"
    )


# ---- sinks -------------------------------------------------------------------------------------
BY_DAY = f"""SELECT CAST(processing_date AS VARCHAR) AS processing_date, count(*) AS n,
  {total('transaction_amount')} AS amount FROM transactions GROUP BY 1"""


def by_day(df: DataFrame) -> DataFrame:
    return df.groupBy("processing_date").agg(
        F.count("*").alias("n"), F.sum("transaction_amount").alias("amount")
    )


@query("k01_overwrite_partitioned", BY_DAY)
def _(v):
    path = scratch(v.spark, "overwrite")
    tables.write_table(_monthly(v.transactions).filter("risk_score > 50"), path, "load_month")
    tables.write_table(_monthly(v.transactions), path, "load_month")
    return by_day(files.read_table(v.spark, path))


@query("k01_overwrite_changed_partitions", BY_DAY)
def _(v):
    """A second load of some months replaces just these months."""
    path = scratch(v.spark, "dynamic")
    rows = _monthly(v.transactions)
    stale = F.when(F.year("processing_date") == 1997, F.lit(0)).otherwise(F.col("transaction_amount"))
    first = rows.withColumn("transaction_amount", stale.cast("decimal(18,2)"))
    tables.write_table(first, path, "load_month")
    tables.write_table(
        rows.filter("load_month like '1997-%'"), path, "load_month", replace_partitions_only=True
    )
    return by_day(files.read_table(v.spark, path))


@query("k02_parquet_snappy_overwrite", BY_DAY)
def _(v):
    path = scratch(v.spark, "snappy")
    tables.write_parquet(_monthly(v.transactions), path, "load_month")
    return by_day(v.spark.read.parquet(path))


_MERGE = {
    "landing": """SELECT * REPLACE (CAST(processing_timestamp + INTERVAL 1 DAY AS TIMESTAMP) AS processing_timestamp,
      'REVERSED' AS transaction_status) FROM transactions WHERE risk_score >= 60
      UNION ALL SELECT * FROM transactions WHERE risk_score < 10""",
    "staged": "SELECT * FROM transactions WHERE risk_score >= 10 OR transaction_id IS NULL",
}


def _merge_inputs(v: Views) -> tuple[DataFrame, DataFrame]:
    rows = model.gold(v.transactions, "transactions")
    later = rows.filter("risk_score >= 60").withColumns(
        {
            "processing_timestamp": F.col("processing_timestamp") + F.expr("interval 1 day"),
            "transaction_status": F.lit("REVERSED"),
        }
    )
    older = rows.filter("risk_score >= 60")
    landing = later.unionByName(older).unionByName(rows.filter("risk_score < 10"))
    return rows.filter("risk_score >= 10"), landing


@query(
    "k05_upsert_latest",
    f"""SELECT transaction_status, count(*) AS n, count(DISTINCT transaction_id) AS ids,
      {total('transaction_amount')} AS amount, max(processing_timestamp) AS newest FROM (
        SELECT * FROM staged WHERE transaction_id NOT IN (SELECT transaction_id FROM landing)
        UNION ALL SELECT * FROM landing) GROUP BY 1""",
    _MERGE,
)
def _(v):
    target, landing = _merge_inputs(v)
    merged = history.upsert(
        target, landing, "transaction_id", ["processing_timestamp", "ingestion_timestamp"]
    )
    return merged.groupBy("transaction_status").agg(
        F.count("*").alias("n"), F.countDistinct("transaction_id").alias("ids"),
        F.sum("transaction_amount").alias("amount"), F.max("processing_timestamp").alias("newest"),
    )


@query(
    "k05_j08_upsert_to_storage",
    f"""SELECT transaction_status, count(*) AS n, count(DISTINCT transaction_id) AS ids,
      {total('transaction_amount')} AS amount, max(processing_timestamp) AS newest, true AS others_kept
      FROM (
        SELECT * FROM staged WHERE transaction_id NOT IN (SELECT transaction_id FROM landing)
        UNION ALL SELECT * FROM landing) GROUP BY 1""",
    _MERGE,
)
def _(v):
    """Two upserts into a stored table, the second with the few keys of the greatest risk again; files
    of buckets that it does not touch keep their names."""
    target, landing = _merge_inputs(v)
    table = KeyedTable(v.spark, scratch(v.spark, "upsert"), "transaction_id", buckets=32)
    newest = ["processing_timestamp", "ingestion_timestamp"]
    table.replace(target)
    first = table.upsert(landing, newest)
    again = table.read().filter("risk_score = 100").orderBy("transaction_id").limit(3)
    second = table.upsert(again, newest)
    touched = table.touched(again, second)
    same = [p for p in first.parts if second.parts.get(p) == first.parts[p]]
    kept = set(first.parts) - set(touched) <= set(same) and not set(touched) & set(same)
    return table.read().groupBy("transaction_status").agg(
        F.count("*").alias("n"), F.countDistinct("transaction_id").alias("ids"),
        F.sum("transaction_amount").alias("amount"), F.max("processing_timestamp").alias("newest"),
    ).withColumn("others_kept", F.lit(kept))


def _registered(v: Views, name: str) -> DataFrame:
    """Write trades, register the folder as an external table and find its partitions."""
    path = scratch(v.spark, "external")
    rows = _monthly(v.stream_trades)
    tables.write_parquet(rows, path, "load_month")
    table = f"{name}_{path[-8:]}"
    tables.register_table(v.spark, table, rows, path, ["load_month"])
    tables.repair_table(v.spark, table)
    return v.spark.table(table)


@query(
    "k06_external_table",
    f"""SELECT side, count(*) AS n, {total('transaction_amount')} AS amount FROM stream_trades GROUP BY 1""",
)
def _(v):
    return _registered(v, "silver_trades").groupBy("side").agg(
        F.count("*").alias("n"), F.sum("transaction_amount").alias("amount")
    )


@query(
    "k08_partition_repair",
    """SELECT strftime(processing_date, '%Y-%m') AS load_month, count(*) AS n FROM stream_trades GROUP BY 1""",
)
def _(v):
    return _registered(v, "repaired_trades").groupBy("load_month").agg(F.count("*").alias("n"))


@query(
    "k09_materialized_models",
    f"""SELECT risk_band, account_type, count(*) AS n, {total('transaction_amount')} AS amount
    FROM fct_transactions GROUP BY 1, 2""",
)
def _(v):
    path = scratch(v.spark, "models")
    mark = path[-8:]
    staged, fact = f"stg_transactions_{mark}", f"fct_transactions_{mark}"
    tables.materialize(model.staging(v.transactions, "transactions"), staged, "staging")
    enriched = model.transaction_enrichment(v.spark.table(staged), v.accounts)
    tables.materialize(enriched, fact, "facts", path=path)
    return v.spark.table(fact).groupBy("risk_band", "account_type").agg(
        F.count("*").alias("n"), F.sum("transaction_amount").alias("amount")
    )


@query(
    "k10_load_history_append",
    """SELECT 'load-' || n AS load_id, 'LOADED' AS status, count(*) AS rows_loaded, 0::BIGINT AS error_count
    FROM transactions CROSS JOIN (VALUES (1), (2)) t(n) GROUP BY 1, 2""",
)
def _(v):
    path = scratch(v.spark, "history")
    for n in (1, 2):
        entry = v.transactions.agg(F.count("*").alias("rows_loaded")).select(
            F.lit(f"load-{n}").alias("load_id"), F.lit("LOADED").alias("status"), "rows_loaded",
            F.lit(0).cast("bigint").alias("error_count"),
        )
        tables.append_audit(entry, path)
    return v.spark.read.parquet(path)


@query(
    "p01_load_metadata",
    """SELECT o_orderstatus AS status, 'orders' AS source_file,
      TIMESTAMP '2024-06-01 12:00:00' AS ingestion_timestamp, '2024-06-01' AS processing_date,
      count(*) AS n FROM orders GROUP BY 1""",
)
def _(v):
    at = F.lit("2024-06-01 12:00:00").cast("timestamp")
    rows = with_load_metadata(v.table("orders"), "orders", at)
    return rows.groupBy(
        F.col("o_orderstatus").alias("status"), "source_file", "ingestion_timestamp",
        "processing_date",
    ).agg(F.count("*").alias("n"))


