"""Cleaning, models, marts, reports, joins, windows and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.scalars import cents_to_amount, money, risk_band
from tidemark.operators import recon, reshape
from tidemark.operators.clean import (
    broken_rules, latest_per_key, payment_rule, to_money, trade_rule, transaction_rule,
)
from tidemark.operators.checks import relationships
from tidemark.operators.history import upsert
from tidemark.plans import marts, model, reports
from tidemark.schemas import CANONICAL
from tidemark.streaming import events as ev
from tidemark.streaming.jobs import latest_events, recompute, union_counts
from tidemark.testbed.ctes import avg_money, day, names, total
from tidemark.testbed.registry import count_rows, query
from tidemark.testbed.views import Views

LOADED = "CAST(processing_date AS VARCHAR) AS processing_date"


def columns(dataset: str, *money_columns: str, prefix: str = "") -> str:
    """The canonical columns of a table in SQL, money as double."""
    return ", ".join(
        f"CAST({prefix}{c} AS DOUBLE) AS {c}" if c in money_columns else f"{prefix}{c}"
        for c in names(dataset)
    )


# ---- P: cleaning -------------------------------------------------------------------------------
@query(
    "p02_money_standardization",
    "SELECT k, CAST(TRY_CAST(transaction_amount AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM ev_wide",
)
def _(v):
    """Text amounts, some of which are no numbers."""
    k, value = F.col("event_id"), F.col("value")
    signed = F.when(k % 89 == 0, -value).otherwise(value).cast("decimal(18,2)").cast("string")
    text = F.when(k % 211 == 0, "abc").otherwise(signed)
    return v.table("events").select(k.alias("k"), money(text).alias("amount"))


def _split(name: str, tagged: str, cte: str, key: str) -> None:
    @query(
        f"{name}_valid_rejected_split",
        f"""SELECT rejection_reason IS NULL AS valid, count(*) AS n, count({key}) AS ids,
          {total('transaction_amount')} AS amount FROM {cte} GROUP BY 1""",
    )
    def _(v):
        rows = getattr(v, tagged)
        return rows.groupBy(F.col("rejection_reason").isNull().alias("valid")).agg(
            count_rows(), F.count(key).alias("ids"), F.sum("transaction_amount").alias("amount")
        )


_split("p03_transactions", "transactions_tagged", "txn_tagged", "transaction_id")
_split("p03_payments", "payments_tagged", "pay_tagged", "payment_id")
_split("p03_trades", "trades_tagged", "trade_tagged", "trade_id")


@query(
    "p04_rejection_reasons",
    """SELECT 'transactions' AS dataset, rejection_reason, count(*) AS n FROM txn_tagged
      WHERE rejection_reason IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'payments', rejection_reason, count(*) FROM pay_tagged
      WHERE rejection_reason IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'trades', rejection_reason, count(*) FROM trade_tagged
      WHERE rejection_reason IS NOT NULL GROUP BY 2""",
)
def _(v):
    parts = {"transactions": v.transactions_tagged, "payments": v.payments_tagged,
             "trades": v.trades_tagged}
    out = None
    for name, df in parts.items():
        one = df.filter("rejection_reason is not null").groupBy("rejection_reason").agg(count_rows()).select(
            F.lit(name).alias("dataset"), "rejection_reason", "n"
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "p05_extra_conditions",
    """SELECT 'transactions' AS dataset, count(*) FILTER (transaction_type IN
        ('DEBIT', 'CREDIT', 'FEE', 'REFUND', 'WIRE', 'ACH')) AS passing, count(*) AS n FROM txn_raw
    UNION ALL SELECT 'payments', count(*) FILTER (transaction_status IN
        ('PENDING', 'SETTLED', 'FAILED', 'CANCELLED')), count(*) FROM pay_raw
    UNION ALL SELECT 'trades', count(*) FILTER (side IN ('BUY', 'SELL')), count(*) FROM trade_raw""",
)
def _(v):
    parts = [("transactions", v.transactions_raw, transaction_rule()),
             ("payments", v.payments_raw, payment_rule()), ("trades", v.trades_raw, trade_rule())]
    frames = [
        df.agg(F.count_if(rule).alias("passing"), count_rows()).select(F.lit(n).alias("dataset"), "passing", "n")
        for n, df, rule in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _gold(name: str, dataset: str, frame: str, source: str, *amounts: str) -> None:
    extra = f"{source}.ingestion_timestamp, source_file, {LOADED}"

    @query(name, f"SELECT {columns(dataset, *amounts)}, {extra} FROM {source}")
    def _(v):
        return model.gold(getattr(v, frame), dataset)


_gold("p06_fact_transaction", "transactions", "transactions", "transactions", "transaction_amount")
_gold("p07_fact_payment", "payments", "payments", "payments", "transaction_amount")
_gold("p08_fact_trade", "trades", "trades", "trades", "quantity", "price", "transaction_amount")


@query(
    "p09_fact_daily_account_balance",
    f"""SELECT {columns('daily_account_balances', 'opening_balance', 'closing_balance')},
      balance_date AS ingestion_timestamp, 'bronze' AS source_file, {LOADED} FROM balances""",
)
def _(v):
    return model.gold(v.balances, "daily_account_balances")


def _dimension(name: str, dataset: str, *amounts: str) -> None:
    @query(
        name,
        f"""SELECT {columns(dataset, *amounts)}, TIMESTAMP '2024-06-01' AS ingestion_timestamp,
          'bronze' AS source_file, '2024-06-01' AS processing_date FROM {dataset}""",
    )
    def _(v):
        at = F.lit("2024-06-01").cast("timestamp")
        loaded = to_money(getattr(v, dataset), *amounts) if amounts else getattr(v, dataset)
        loaded = loaded.withColumns(
            {"ingestion_timestamp": at, "source_file": F.lit("bronze"),
             "processing_date": F.to_date(at)}
        )
        key = CANONICAL[dataset].fieldNames()[0]
        return model.gold(latest_per_key(loaded, key, "ingestion_timestamp"), dataset)


_dimension("p10_dim_customer", "customers")
_dimension("p11_dim_account", "accounts", "current_balance")
_dimension("p12_dim_security", "securities")

# ---- P13–P20: stream events (batch form) -------------------------------------------------------
EVENT_TEXT = [
    "event_id", "event_type", "transaction_id", "payment_id", "trade_id", "account_id",
    "security_id", "transaction_amount", "currency_code", "quantity", "price", "side",
]


@query(
    "p13_parse_payload",
    f"""SELECT k % 101 = 0 AS parse_failed,
      {', '.join(f"CASE WHEN k % 101 <> 0 THEN {c} END AS {c}" for c in EVENT_TEXT)},
      CASE WHEN k % 101 <> 0 THEN event_timestamp END AS event_timestamp,
      CASE WHEN k % 101 <> 0 THEN risk_score END AS risk_score, arrival_timestamp FROM ev_sent""",
)
def _(v):
    broken = F.col("parse_failed")
    kept = [F.when(~broken, F.col(c)).alias(c) for c in [*EVENT_TEXT, "event_timestamp", "risk_score"]]
    return v.parsed.select("parse_failed", *kept, "arrival_timestamp")


@query(
    "p14_optional_columns",
    """SELECT event_type, count(*) AS n, 0::BIGINT AS transaction_ids, 0::BIGINT AS merchants,
      count(trade_id) AS trades FROM ev_sent WHERE k % 101 <> 0 GROUP BY 1""",
)
def _(v):
    narrow = v.parsed.filter("not parse_failed").select("event_id", "event_type", "trade_id")
    return ev.with_optional_columns(narrow).groupBy("event_type").agg(
        count_rows(), F.count("transaction_id").alias("transaction_ids"),
        F.count("merchant_category").alias("merchants"), F.count("trade_id").alias("trades"),
    )


@query(
    "p15_stream_metadata",
    """SELECT event_id, transaction_amount AS amount, account_id, event_type,
      TIMESTAMP '2024-06-01' AS ingestion_timestamp, '2024-06-01' AS processing_date
      FROM ev_sent WHERE k % 101 <> 0""",
)
def _(v):
    """The raw payload is read back: it must hold the row's own fields."""
    good = v.parsed.filter("not parse_failed").drop(*ev.ENVELOPE_COLUMNS)
    stamped = ev.with_stream_metadata(good, F.lit("2024-06-01").cast("timestamp"))

    def field(name: str):
        return F.get_json_object("raw_payload", f"$.{name}")

    return stamped.select(
        field("event_id").alias("event_id"), field("transaction_amount").alias("amount"),
        field("account_id").alias("account_id"), field("event_type").alias("event_type"),
        "ingestion_timestamp", "processing_date",
    )


@query(
    "p16_stream_split",
    "SELECT event_type, rejection_reason IS NULL AS valid, count(*) AS n FROM ev_tagged GROUP BY 1, 2",
)
def _(v):
    valid = F.col("rejection_reason").isNull().alias("valid")
    return v.events_tagged.groupBy("event_type", valid).agg(count_rows())


@query("p17_stream_rejection_reasons",
       "SELECT event_id, event_type, rejection_reason FROM ev_rejected")
def _(v):
    return v.events_rejected.select("event_id", "event_type", "rejection_reason")


def _route(name: str, kind: str, *amounts: str) -> None:
    dataset = ev.EVENT_KINDS[kind]
    shown = ", ".join(
        f"CAST(TRY_CAST({c} AS DECIMAL(18,2)) AS DOUBLE) AS {c}" if c in amounts else c
        for c in names(dataset)
    )

    @query(name, f"""SELECT event_id, {shown}, ingestion_timestamp, {LOADED}
      FROM ev_valid WHERE event_type = '{kind}'""")
    def _(v):
        return ev.route(v.events_valid, kind)


_route("p18_route_transactions", "transaction", "transaction_amount")
_route("p19_route_payments", "payment", "transaction_amount")
_route("p20_route_trades", "trade", "quantity", "price", "transaction_amount")

# ---- P21–P31 -----------------------------------------------------------------------------------
for _dataset, _frame, _source, _amounts in [
    ("transactions", "transactions", "transactions", ["transaction_amount"]),
    ("daily_account_balances", "balances", "balances", ["opening_balance", "closing_balance"]),
]:
    _stamp = "ingestion_timestamp" if _dataset == "transactions" else "balance_date"

    @query(
        f"p21_staging_{_dataset}",
        f"""SELECT {columns(_dataset, *_amounts)}, {_stamp} AS ingestion_timestamp,
          'bronze' AS source_file, {LOADED} FROM {_source}""",
    )
    def _(v, dataset=_dataset, frame=_frame):
        return model.staging(getattr(v, frame), dataset)


for _dataset, _amounts in [("customers", []), ("accounts", ["current_balance"])]:

    @query(
        f"p21_staging_{_dataset}",
        f"""SELECT {columns(_dataset, *_amounts)}, TIMESTAMP '2024-06-01' AS ingestion_timestamp,
          'bronze' AS source_file, '2024-06-01' AS processing_date FROM {_dataset}""",
    )
    def _(v, dataset=_dataset, amounts=_amounts):
        at = F.lit("2024-06-01").cast("timestamp")
        silver = getattr(v, dataset).withColumns(
            {"ingestion_timestamp": at, "source_file": F.lit("bronze"),
             "processing_date": F.to_date(at)}
        )
        return model.staging(to_money(silver, *amounts) if amounts else silver, dataset)


@query(
    "p22_risk_band",
    """SELECT CASE WHEN risk_score >= 80 THEN 'HIGH' WHEN risk_score >= 50 THEN 'MEDIUM'
      ELSE 'LOW' END AS risk_band, count(*) AS n, count(risk_score) AS scored FROM txn_raw GROUP BY 1""",
)
def _(v):
    return v.transactions_raw.groupBy(risk_band("risk_score").alias("risk_band")).agg(
        count_rows(), F.count("risk_score").alias("scored")
    )


@query(
    "p23_net_balance_change",
    f"""SELECT balance_id, account_id, customer_id, balance_date,
      CAST(opening_balance AS DOUBLE) AS opening_balance,
      CAST(closing_balance AS DOUBLE) AS closing_balance,
      CAST(closing_balance - opening_balance AS DOUBLE) AS net_balance_change, currency_code,
      {LOADED} FROM balances""",
)
def _(v):
    return model.account_daily_balance(model.staging(v.balances, "daily_account_balances"))


FCT = f"""SELECT transaction_id, account_id, customer_id, account_type, transaction_type,
  CAST(transaction_amount AS DOUBLE) AS transaction_amount, currency_code, transaction_status,
  event_timestamp, processing_timestamp, merchant_category, country_code, risk_score, risk_band,
  {LOADED} FROM fct_transactions"""


@query("p24_fct_transactions", FCT)
def _(v):
    return v.fct_transactions


@query("p24_dim_customer_model", f"SELECT {columns('customers')} FROM customers")
def _(v):
    return model.model_dimension(v.customers, "customers")


@query("p24_dim_account_model", f"SELECT {columns('accounts', 'current_balance')} FROM accounts")
def _(v):
    return model.model_dimension(to_money(v.accounts, "current_balance"), "accounts")


@query(
    "p25_fct_stream_trades",
    f"""SELECT event_id, {columns('trades', 'quantity', 'price', 'transaction_amount')},
      ingestion_timestamp, {day('event_timestamp')} AS trade_date, trade_minute, {LOADED}
      FROM stream_trades""",
)
def _(v):
    return v.fct_stream_trades


@query(
    "p26_high_risk_transactions",
    """SELECT transaction_id, account_id, customer_id, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
      currency_code, merchant_category, transaction_status, risk_score, event_timestamp
      FROM transactions WHERE risk_score >= 30""",
)
def _(v):
    return reports.high_risk(v.transactions)


@query(
    "p27_ticket_size",
    """SELECT currency_code, CAST(sum(total) AS DOUBLE) / sum(transaction_count) AS average_ticket_size
    FROM performance GROUP BY 1""",
)
def _(v):
    return reports.ticket_size(marts.financial_performance(v.fct_transactions), "currency_code")


@query(
    "p27_risk_flag",
    """SELECT customer_id, CASE WHEN customer_risk_score >= 80 OR max_transaction_risk_score >= 80
      THEN 'High' ELSE 'Normal' END AS high_risk_customer_flag FROM customer_risk""",
)
def _(v):
    flagged = reports.with_risk_flag(marts.customer_risk(v.customers, v.fct_transactions))
    return flagged.select("customer_id", "high_risk_customer_flag")


@query(
    "p27_batch_health",
    f"""SELECT {LOADED},
      CASE WHEN debit_credit_difference > 1000 THEN 'Investigate' ELSE 'Normal' END AS reconciliation_gap_flag,
      CASE WHEN net_flow_imbalance_ratio > 0.75 THEN 'Critical'
        WHEN net_flow_imbalance_ratio > 0.40 THEN 'Warning' ELSE 'Healthy' END AS batch_health_status
    FROM regulatory""",
)
def _(v):
    health = reports.with_health(marts.regulatory_reconciliation(v.fct_transactions))
    return health.select("processing_date", "reconciliation_gap_flag", "batch_health_status")


@query("p28_cents_to_amount",
       "SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 AS amount FROM orders")
def _(v):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return v.table("orders").select("o_orderkey", cents_to_amount(cents).alias("amount"))


@query(
    "p29_reindex",
    """SELECT o_orderstatus, CAST(NULL AS VARCHAR) AS missing_column, o_orderkey FROM orders""",
)
def _(v):
    return reshape.reindex(v.table("orders"), ["o_orderstatus", "missing_column", "o_orderkey"])


@query(
    "p30_star",
    """SELECT l_orderkey AS "src_l_orderkey_x", l_partkey AS "src_l_partkey_x",
      l_linenumber AS "src_l_linenumber_x", l_returnflag AS "src_l_returnflag_x" FROM lineitem""",
)
def _(v):
    drop = ["L_SUPPKEY", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
            "l_shipdate"]
    return reshape.star(v.table("lineitem"), drop, prefix="src_", suffix="_x")


@query(
    "p31_empty_to_null",
    """SELECT o_orderkey, nullif(CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END, '') AS priority,
      nullif(o_orderstatus, '') AS status FROM orders""",
)
def _(v):
    blank = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.col("o_orderpriority"))
    rows = v.table("orders").select(
        "o_orderkey", blank.alias("priority"), F.col("o_orderstatus").alias("status")
    )
    return reshape.empty_to_null(rows)


@query(
    "m21_record_rules",
    """SELECT rule, count(*) AS n FROM (
      SELECT unnest([
        CASE WHEN NOT coalesce(currency_code IN ('USD','EUR','GBP','JPY','CAD','AUD'), false) THEN 'currency_code' END,
        CASE WHEN NOT coalesce(risk_score BETWEEN 0 AND 100, false) THEN 'risk_score' END,
        CASE WHEN NOT coalesce(transaction_status IN ('PENDING','SETTLED','FAILED','CANCELLED'), false)
          THEN 'transaction_status' END]) AS rule FROM pay_raw) WHERE rule IS NOT NULL GROUP BY 1""",
)
def _(v):
    broken = broken_rules(v.payments_raw, "payments")
    return broken.select(F.explode("broken_rules").alias("rule")).groupBy("rule").agg(count_rows())


@query(
    "m22_daily_account_balances",
    f"""SELECT {columns('daily_account_balances', 'opening_balance', 'closing_balance')} FROM balances""",
)
def _(v):
    return v.balances.select(*names("daily_account_balances"))


# ---- J: joins ----------------------------------------------------------------------------------
@query(
    "j01_transactions_left_accounts",
    """SELECT account_type, count(*) AS n, count(DISTINCT customer_id) AS customers
      FROM fct_transactions GROUP BY 1""",
)
def _(v):
    return v.fct_transactions.groupBy("account_type").agg(
        count_rows(), F.countDistinct("customer_id").alias("customers")
    )


@query(
    "j07_orphan_accounts",
    """SELECT counterparty_account_id AS id, count(*) AS n FROM payments WHERE counterparty_account_id
      NOT IN (SELECT account_id FROM accounts) GROUP BY 1""",
)
def _(v):
    orphans = relationships(v.payments, "counterparty_account_id", v.accounts, "account_id")
    return orphans.groupBy("id").agg(count_rows())


@query(
    "j02_customers_left_transactions",
    f"""SELECT c.country_code, count(DISTINCT c.customer_id) AS customers,
      count(t.transaction_id) AS transactions, {total('t.transaction_amount')} AS amount
      FROM customers c LEFT JOIN transactions t ON c.customer_id = t.customer_id GROUP BY 1""",
)
def _(v):
    per_customer = marts.per_key_then_join(
        v.customers, v.transactions, "customer_id",
        F.count("transaction_id").alias("n"), F.sum("transaction_amount").alias("amount"),
    )
    return per_customer.groupBy("country_code").agg(
        F.count("*").alias("customers"), F.coalesce(F.sum("n"), F.lit(0)).alias("transactions"),
        F.sum("amount").alias("amount"),
    )


@query(
    "j08_merge_join",
    """SELECT customer_id, risk_score, full_name FROM customers WHERE risk_score < 50
    UNION ALL SELECT customer_id, 100, full_name FROM customers WHERE risk_score >= 50""",
)
def _(v):
    landing = v.customers.filter("risk_score >= 50").withColumn("risk_score", F.lit(100))
    return upsert(v.customers, landing, "customer_id", ["created_at"]).select(
        "customer_id", "risk_score", "full_name"
    )


# ---- A: marts ----------------------------------------------------------------------------------
@query(
    "a01_trade_minute_metrics",
    f"""SELECT security_id, currency_code, side, trade_minute, {LOADED}, trade_count,
      CAST(total_quantity AS DOUBLE) AS total_quantity,
      CAST(total_transaction_amount AS DOUBLE) AS total_transaction_amount, avg_trade_price,
      max_risk_score FROM minute_metrics""",
)
def _(v):
    return marts.trade_minute_metrics(v.stream_trades)


@query(
    "a02_customer_trade_exposure",
    f"""SELECT customer_id, account_id, security_id, currency_code, {LOADED}, buy_trade_count,
      sell_trade_count, CAST(net_quantity AS DOUBLE) AS net_quantity,
      CAST(gross_notional_amount AS DOUBLE) AS gross_notional_amount, avg_risk_score,
      latest_event_timestamp FROM exposure""",
)
def _(v):
    return marts.customer_trade_exposure(v.stream_trades)


@query(
    "a03_financial_performance",
    f"""SELECT {LOADED}, CAST(transaction_date AS VARCHAR) AS transaction_date, currency_code,
      merchant_category, transaction_type, CAST(total AS DOUBLE) AS total_transaction_amount,
      transaction_count, average AS avg_transaction_amount FROM performance""",
)
def _(v):
    return marts.financial_performance(v.fct_transactions)


@query(
    "a04_customer_risk",
    """SELECT customer_id, full_name, country_code, customer_risk_score, transaction_count,
      CAST(total_transaction_amount AS DOUBLE) AS total_transaction_amount, avg_transaction_amount,
      max_transaction_risk_score FROM customer_risk""",
)
def _(v):
    return marts.customer_risk(v.customers, v.fct_transactions)


REGULATORY = f"""SELECT {LOADED}, transaction_count, CAST(debit_total AS DOUBLE) AS debit_total,
  CAST(credit_total AS DOUBLE) AS credit_total,
  CAST(debit_credit_difference AS DOUBLE) AS debit_credit_difference, net_flow_imbalance_ratio
  FROM regulatory"""


@query("a05_regulatory_reconciliation", REGULATORY)
def regulatory(v):
    return marts.regulatory_reconciliation(v.fct_transactions)


@query(
    "a06_stream_trade_performance",
    f"""SELECT {LOADED}, CAST(trade_date AS VARCHAR) AS trade_date, security_id, currency_code, side,
      {total('transaction_amount')} AS total_notional_amount, {total('quantity')} AS total_quantity,
      count(*) AS trade_count, {avg_money('price')} AS avg_trade_price,
      avg(risk_score) AS avg_risk_score FROM stream_trades
      GROUP BY stream_trades.processing_date, stream_trades.trade_date, 3, 4, 5""",
)
def _(v):
    return marts.stream_trade_performance(v.fct_stream_trades)


@query(
    "a06_batch_trade_performance",
    f"""SELECT {LOADED}, {day('event_timestamp')} AS trade_date, currency_code, side,
      {total('transaction_amount')} AS total_notional_amount, count(*) AS trade_count FROM trades
      GROUP BY trades.processing_date, CAST(event_timestamp AS DATE), 3, 4""",
)
def _(v):
    trades = v.trades.withColumn("trade_date", F.to_date("event_timestamp"))
    per_security = marts.stream_trade_performance(trades)
    return per_security.groupBy("processing_date", "trade_date", "currency_code", "side").agg(
        F.sum("total_notional_amount").alias("total_notional_amount"),
        F.sum("trade_count").alias("trade_count"),
    )


@query(
    "a07_stream_customer_exposure",
    f"""SELECT customer_id, currency_code, sum(buy_trade_count)::BIGINT AS buys,
      sum(sell_trade_count)::BIGINT AS sells, {total('gross_notional_amount')} AS gross,
      max(latest_event_timestamp) AS newest FROM exposure GROUP BY 1, 2""",
)
def _(v):
    rows = marts.customer_trade_exposure(v.fct_stream_trades)
    return rows.groupBy("customer_id", "currency_code").agg(
        F.sum("buy_trade_count").alias("buys"), F.sum("sell_trade_count").alias("sells"),
        F.sum("gross_notional_amount").alias("gross"),
        F.max("latest_event_timestamp").alias("newest"),
    )


_RECON = {
    "acc": """SELECT processing_date, count(*) AS a, sum(transaction_amount) AS amount
      FROM stream_trades GROUP BY 1""",
    "rej": "SELECT processing_date, count(*) AS r FROM ev_rejected GROUP BY 1",
}


@query(
    "a08_stream_reconciliation",
    """SELECT CAST(acc.processing_date AS VARCHAR) AS processing_date, a AS accepted_trade_count,
      CAST(amount AS DOUBLE) AS accepted_notional_amount, coalesce(r, 0) AS rejected_event_count,
      CAST(coalesce(r, 0) AS DOUBLE) / nullif(a + coalesce(r, 0), 0) AS rejection_ratio
      FROM acc LEFT JOIN rej ON acc.processing_date = rej.processing_date""",
    _RECON,
)
def _(v):
    return marts.stream_reconciliation(v.stream_trades, v.events_rejected)


@query(
    "j04_reconciliation_all_days",
    """SELECT CAST(coalesce(acc.processing_date, rej.processing_date) AS VARCHAR) AS processing_date,
      coalesce(a, 0) AS accepted_trade_count, CAST(amount AS DOUBLE) AS accepted_notional_amount,
      coalesce(r, 0) AS rejected_event_count,
      CAST(coalesce(r, 0) AS DOUBLE) / nullif(coalesce(a, 0) + coalesce(r, 0), 0) AS rejection_ratio
      FROM acc FULL JOIN rej ON acc.processing_date = rej.processing_date""",
    _RECON,
)
def _(v):
    return marts.stream_reconciliation(v.stream_trades, v.events_rejected, how="full")


# ---- A9–A20, O: reports ------------------------------------------------------------------------
TOTALS = f"{total('transaction_amount')} AS total_transaction_amount, count(*) AS transaction_count"
AVERAGE = f"{avg_money('transaction_amount')} AS avg_transaction_amount"
EVENT_DAY = f"{day('event_timestamp')} AS transaction_date"


@query("a09_daily_transaction_totals",
       f"SELECT {EVENT_DAY}, currency_code, {TOTALS} FROM transactions GROUP BY 1, 2")
def _(v):
    return reports.daily_totals(v.transactions)


@query(
    "o01_o02_output_order",
    f"""SELECT 'daily_status' AS report, row_number() OVER (ORDER BY d DESC, s) AS position,
      CAST(d AS VARCHAR) || ' ' || s AS label, CAST(NULL AS DOUBLE) AS amount FROM
      (SELECT DISTINCT CAST(event_timestamp AS DATE) AS d, transaction_status AS s FROM transactions)
    UNION ALL SELECT 'customer_summary', row_number() OVER (ORDER BY amount DESC NULLS LAST), NULL, amount FROM
      (SELECT c.customer_id, {total('t.transaction_amount')} AS amount FROM customers c
       LEFT JOIN transactions t ON c.customer_id = t.customer_id GROUP BY 1)""",
)
def _(v):
    """What stands at each place of two sorted reports: rows are numbered as they come out."""
    def placed(name, report, label, amount):
        rows = report.select(label.alias("label"), amount.cast("double").alias("amount")).withColumn(
            "_at", F.monotonically_increasing_id())
        return rows.select(F.lit(name).alias("report"), F.row_number().over(
            Window.orderBy("_at")).cast("bigint").alias("position"), "label", "amount")

    status = reports.daily_status(v.transactions)
    people = reports.customer_summary(v.customers, v.transactions)
    return placed(
        "daily_status", status,
        F.concat_ws(" ", F.col("transaction_date").cast("string"), "transaction_status"), F.lit(None),
    ).unionByName(placed(
        "customer_summary", people, F.lit(None).cast("string"), F.col("total_transaction_amount")))


@query("a10_daily_status_breakdown",
       f"SELECT {EVENT_DAY}, transaction_status, {TOTALS} FROM transactions GROUP BY 1, 2")
def _(v):
    return reports.daily_status(v.transactions)


@query(
    "a11_account_balances",
    f"""SELECT account_id, max(balance_date) AS latest_balance_date,
      CAST(arg_max(closing_balance, balance_date) AS DOUBLE) AS latest_closing_balance,
      {avg_money('closing_balance')} AS avg_closing_balance FROM balances GROUP BY 1""",
)
def _(v):
    return reports.account_balances(v.balances)


@query("a12_merchant_distribution",
       f"SELECT merchant_category, {TOTALS}, {AVERAGE} FROM transactions GROUP BY 1")
def _(v):
    return reports.merchant_distribution(v.transactions)


@query(
    "a13_cross_table_summary",
    f"""SELECT (SELECT count(*) FROM transactions) AS transaction_count,
      (SELECT {total('transaction_amount')} FROM transactions) AS transaction_amount_sum,
      (SELECT count(*) FROM balances) AS balance_count,
      (SELECT {avg_money('closing_balance')} FROM balances) AS avg_closing_balance""",
)
def _(v):
    return reports.cross_table_summary(v.transactions, v.balances)


@query("a14_status_breakdown",
       f"SELECT transaction_status, {TOTALS}, {AVERAGE} FROM transactions GROUP BY 1")
def _(v):
    return reports.status_breakdown(v.transactions)


@query(
    "a15_customer_summary",
    f"""SELECT c.customer_id, c.full_name, c.email, c.risk_score AS customer_risk_score,
      count(t.transaction_id) AS transaction_count,
      {total('t.transaction_amount')} AS total_transaction_amount,
      {avg_money('t.transaction_amount')} AS avg_transaction_amount,
      max(t.event_timestamp) AS latest_transaction_timestamp
      FROM customers c LEFT JOIN transactions t ON c.customer_id = t.customer_id GROUP BY 1, 2, 3, 4""",
)
def _(v):
    return reports.customer_summary(v.customers, v.transactions)


@query(
    "a16_account_activity",
    f"""SELECT a.account_id, a.account_type, a.status, lb.latest_balance_date,
      CAST(lb.latest_closing_balance AS DOUBLE) AS latest_closing_balance,
      count(t.transaction_id) AS transaction_count,
      {total('t.transaction_amount')} AS total_transaction_amount
      FROM accounts a LEFT JOIN latest_balances lb ON a.account_id = lb.account_id
      LEFT JOIN transactions t ON a.account_id = t.account_id GROUP BY 1, 2, 3, 4, 5""",
)
def _(v):
    return reports.account_activity(v.accounts, v.balances, v.transactions)


@query("a17_cashflow_trend",
       f"SELECT {EVENT_DAY}, transaction_type, {TOTALS} FROM transactions GROUP BY 1, 2")
def _(v):
    return reports.cashflow_trend(v.transactions)


@query("a18_rejected_events",
       f"""SELECT {LOADED}, rejection_reason, count(*) AS rejected_event_count
       FROM ev_rejected GROUP BY ev_rejected.processing_date, 2""")
def _(v):
    return reports.rejected_events(v.events_rejected)


@query(
    "a19_newest_trade_days",
    f"""SELECT CAST(processing_date AS VARCHAR) AS processing_date, count(*) AS trade_count,
      {total('transaction_amount')} AS total_notional FROM trades
      GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
)
def _(v):
    return reports.newest_trade_days(v.trades)


@query(
    "a20_stage_counts",
    """SELECT 'transactions' AS dataset_name, count(*) FILTER (rejection_reason IS NULL) AS valid_rows,
      count(*) FILTER (rejection_reason IS NOT NULL) AS rejected_rows FROM txn_tagged
    UNION ALL SELECT 'payments', count(*) FILTER (rejection_reason IS NULL),
      count(*) FILTER (rejection_reason IS NOT NULL) FROM pay_tagged
    UNION ALL SELECT 'trades', count(*) FILTER (rejection_reason IS NULL),
      count(*) FILTER (rejection_reason IS NOT NULL) FROM trade_tagged""",
)
def _(v):
    return recon.stage_counts(
        {"transactions": v.transactions_tagged, "payments": v.payments_tagged,
         "trades": v.trades_tagged}
    )


@query(
    "o03_top_trade_minutes",
    """SELECT trade_minute, security_id, side, trade_count, CAST(total_quantity AS DOUBLE) AS total_quantity,
      CAST(total_transaction_amount AS DOUBLE) AS total_transaction_amount, avg_trade_price
      FROM minute_metrics ORDER BY trade_minute DESC, security_id, side, currency_code, processing_date
      LIMIT 200""",
)
def _(v):
    return reports.top_trade_minutes(marts.trade_minute_metrics(v.stream_trades))


@query(
    "o03_top_exposure",
    """SELECT customer_id, account_id, security_id, buy_trade_count, sell_trade_count,
      CAST(net_quantity AS DOUBLE) AS net_quantity,
      CAST(gross_notional_amount AS DOUBLE) AS gross_notional_amount, avg_risk_score,
      latest_event_timestamp FROM exposure
      ORDER BY exposure.gross_notional_amount DESC, latest_event_timestamp DESC, customer_id,
        account_id, security_id, currency_code, processing_date LIMIT 200""",
)
def _(v):
    return reports.top_exposure(marts.customer_trade_exposure(v.stream_trades))


# ---- W: windows --------------------------------------------------------------------------------
@query("w01_latest_per_key", f"SELECT {columns('trades', 'quantity', 'price', 'transaction_amount')} FROM trade_latest")
def _(v):
    rows = to_money(v.trades_raw, "quantity", "price", "transaction_amount")
    return latest_per_key(rows, "trade_id", "processing_timestamp")


@query("w02_latest_event",
       "SELECT event_id, event_type, transaction_amount, processing_timestamp FROM ev_tagged")
def _(v):
    good = v.parsed.filter("not parse_failed").drop(*ev.ENVELOPE_COLUMNS)
    return latest_events(good).select(
        "event_id", "event_type", "transaction_amount", "processing_timestamp"
    )


@query(
    "w03_two_key_order",
    """SELECT user_id, event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id
      FROM events GROUP BY 1, 2""",
)
def _(v):
    rows = v.table("events").select("user_id", "event_type", "ts", "event_id")
    return latest_per_key(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "w05_deduplicate_without_null_keys",
    """SELECT transaction_id, processing_timestamp, transaction_status FROM txn_latest
      WHERE transaction_id IS NOT NULL""",
)
def _(v):
    rows = to_money(v.transactions_raw, "transaction_amount")
    kept = latest_per_key(rows, ["transaction_id"], ["processing_timestamp"], keep_null_keys=False)
    return kept.select("transaction_id", "processing_timestamp", "transaction_status")


@query(
    "w04_latest_landing_row",
    """SELECT transaction_id, transaction_status, processing_timestamp FROM
      (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY processing_timestamp DESC,
        load_timestamp DESC, transaction_status DESC) AS rn FROM
        (SELECT t.*, TIMESTAMP '2024-06-01' + to_days(d) AS load_timestamp FROM txn_raw t,
          (VALUES (0), (1)) x(d)) WHERE transaction_id IS NOT NULL) WHERE rn = 1""",
)
def _(v):
    """Every row landed twice; processing time, then load time decides."""
    day = F.explode(F.array(F.lit(0), F.lit(1)))
    landed = v.transactions_raw.withColumn("day", day).withColumn(
        "load_timestamp", F.lit("2024-06-01").cast("timestamp") + F.make_dt_interval("day")
    )
    newest = ["processing_timestamp", "load_timestamp"]
    kept = latest_per_key(landed, "transaction_id", newest, keep_null_keys=False)
    return kept.select("transaction_id", "transaction_status", "processing_timestamp")


@query(
    "t09_recompute_trade_tables",
    """SELECT 'gold/customer_trade_exposure' AS table_name, count(*) AS row_count FROM
      (SELECT DISTINCT customer_id, account_id, security_id, currency_code FROM stream_trades)
    UNION ALL SELECT 'gold/fact_trade', count(*) FROM stream_trades
    UNION ALL SELECT 'gold/trade_minute_metrics', count(*) FROM
      (SELECT DISTINCT security_id, currency_code, side, trade_minute FROM stream_trades)
    UNION ALL SELECT 'rejected/events', count(*) FROM ev_rejected
    UNION ALL SELECT 'silver/trades', count(*) FROM stream_trades""",
)
def _(v):
    good = v.parsed.filter("not parse_failed").drop(*ev.ENVELOPE_COLUMNS)
    return union_counts(recompute(good, F.lit("2024-06-01").cast("timestamp")))


def flagship(v: Views) -> DataFrame:
    return regulatory(v)


