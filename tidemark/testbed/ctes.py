"""The canonical views of ``views`` as SQL, composed into one WITH clause per check."""

from __future__ import annotations

import re

from tidemark.schemas import (
    CANONICAL, COUNTRIES, CURRENCIES, MERCHANT_CATEGORIES, PAYMENT_STATUSES, SECURITY_TYPES,
    TRANSACTION_STATUSES, TRANSACTION_TYPES,
)


def lit(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def pick(values: list[str], index: str) -> str:
    return f"split_part('{','.join(values)}', ',', CAST({index} AS INT) + 1)"


def day(expr: str) -> str:
    """A date as text, the form dates take in registered results."""
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR)"


def avg_money(expr: str) -> str:
    """Mean of a decimal(18,2), rounded half up to cents, in integer arithmetic."""
    cents = f"sum(CAST({expr} * 100 AS BIGINT))"
    n = f"count({expr})"
    return (
        f"CAST(CASE WHEN {n} = 0 THEN NULL ELSE "
        f"sign({cents}) * ((2 * abs({cents}) + {n}) // (2 * {n})) END AS DOUBLE) / 100"
    )


def total(expr: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE)"


def latest(source: str, columns: list[str], key: str, newest: str = "processing_timestamp") -> str:
    rest = [c for c in columns if c not in (key, newest)]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [newest, *rest])
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1 OR {key} IS NULL"
    )


def tag(source: str, key: str, statuses: list[str], extra: str) -> str:
    ok = (
        f"{key} IS NOT NULL AND currency_code IN ({lit(CURRENCIES)}) AND transaction_amount >= 0 "
        f"AND transaction_status IN ({lit(statuses)}) AND risk_score BETWEEN 0 AND 100 AND {extra}"
    )
    return f"""SELECT *, processing_timestamp AS ingestion_timestamp, 'bronze' AS source_file,
      CAST(processing_timestamp AS DATE) AS processing_date,
      CASE WHEN coalesce({ok}, false) THEN NULL WHEN {key} IS NULL THEN '{key}_null'
        WHEN currency_code NOT IN ({lit(CURRENCIES)}) THEN 'invalid_currency'
        WHEN transaction_amount < 0 THEN 'negative_amount'
        WHEN transaction_status NOT IN ({lit(statuses)}) THEN 'invalid_status'
        ELSE 'validation_failed' END AS rejection_reason FROM {source}"""


def names(dataset: str) -> list[str]:
    return CANONICAL[dataset].fieldNames()


_ORDER = f"""'ACCT-' || o_custkey AS account_id, 'CUST-' || o_custkey AS customer_id,
  CAST(CASE WHEN o_orderkey % 89 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2))
    AS transaction_amount,
  CASE WHEN o_orderkey % 83 = 0 THEN 'ZZZ' ELSE {pick(CURRENCIES, 'o_custkey % 6')} END AS currency_code,
  o_orderdate AS event_timestamp,
  o_orderdate + to_minutes(CAST(o_orderkey % 60 + copy * 5 AS BIGINT)) AS processing_timestamp,
  {pick(COUNTRIES, 'o_custkey % 6')} AS country_code,
  CAST(CASE WHEN o_orderkey % 73 = 0 THEN 150 WHEN o_orderkey % 71 = 0 THEN NULL
    ELSE (o_orderkey * 7) % 101 END AS INT) AS risk_score"""

_EVENT_REASON = f"""CASE WHEN coalesce(currency_code IN ({lit(CURRENCIES)}) AND risk_score BETWEEN 0 AND 100
    AND TRY_CAST(transaction_amount AS DECIMAL(18,2)) >= 0 AND (
      (event_type = 'transaction' AND transaction_id IS NOT NULL
        AND transaction_type IN ({lit(TRANSACTION_TYPES)})
        AND transaction_status IN ({lit(TRANSACTION_STATUSES)}))
      OR (event_type = 'payment' AND payment_id IS NOT NULL
        AND transaction_status IN ({lit(PAYMENT_STATUSES)}))
      OR (event_type = 'trade' AND trade_id IS NOT NULL AND side IN ('BUY', 'SELL')
        AND transaction_status IN ({lit(TRANSACTION_STATUSES)}))), false) THEN NULL
  WHEN currency_code NOT IN ({lit(CURRENCIES)}) THEN 'invalid_currency'
  WHEN risk_score NOT BETWEEN 0 AND 100 THEN 'invalid_risk_score'
  WHEN TRY_CAST(transaction_amount AS DECIMAL(18,2)) < 0 THEN 'negative_amount'
  WHEN event_type = 'transaction' THEN 'invalid_transaction_record'
  WHEN event_type = 'payment' THEN 'invalid_payment_record'
  ELSE 'invalid_trade_record' END AS rejection_reason"""

CTES: dict[str, str] = {
    "customers": f"""SELECT 'CUST-' || c_custkey AS customer_id, c_name AS full_name,
      lower(replace(c_name, '#', '')) || '@example.com' AS email,
      {pick(COUNTRIES, 'c_nationkey % 6')} AS country_code,
      CAST(c_custkey % 101 AS INT) AS risk_score,
      TIMESTAMP '2020-01-01' + to_days(CAST(c_custkey % 1000 AS INT)) AS created_at
      FROM customer""",
    "accounts": """SELECT 'ACCT-' || c_custkey AS account_id, 'CUST-' || c_custkey AS customer_id,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 'BROKERAGE'
        WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'SAVINGS' ELSE 'CHECKING' END AS account_type,
      'USD' AS currency_code, CAST(c_acctbal AS DECIMAL(18,2)) AS current_balance,
      TIMESTAMP '1990-01-01' + to_days(CAST(c_custkey % 365 AS INT)) AS opened_at,
      CASE c_custkey % 4 WHEN 3 THEN 'CLOSED' WHEN 2 THEN 'SUSPENDED' ELSE 'OPEN' END AS status
      FROM customer""",
    "securities": f"""SELECT 'SEC-' || p_partkey AS security_id, 'TK' || p_partkey AS ticker,
      p_name AS security_name, {pick(SECURITY_TYPES, 'p_size % 4')} AS security_type,
      {pick(['NYSE', 'NASDAQ', 'ARCA'], 'p_partkey % 3')} AS exchange_code, 'USD' AS currency_code
      FROM part""",
    "orders_sent": """SELECT *, 0 AS copy FROM orders
      UNION ALL SELECT *, 1 AS copy FROM orders WHERE o_orderkey % 50 = 0""",
    "txn_raw": f"""SELECT CASE WHEN o_orderkey % 97 <> 0 THEN 'TXN-' || o_orderkey END AS transaction_id,
      {pick(TRANSACTION_TYPES, 'o_orderkey % 6')} AS transaction_type,
      CASE WHEN copy = 1 THEN 'REVERSED' WHEN o_orderstatus = 'F' THEN 'POSTED'
        WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'FAILED' END AS transaction_status,
      {pick(MERCHANT_CATEGORIES, 'o_orderkey % 7')} AS merchant_category, {_ORDER} FROM orders_sent""",
    "pay_raw": f"""SELECT CASE WHEN o_orderkey % 97 <> 0 THEN 'PAY-' || o_orderkey END AS payment_id,
      {pick([*PAYMENT_STATUSES, 'UNKNOWN'], 'o_orderkey % 5')} AS transaction_status,
      'ACCT-' || (o_custkey + 1) AS counterparty_account_id, {_ORDER}
      FROM orders_sent""",
    "trade_raw": f"""SELECT CASE WHEN l_partkey % 101 <> 0
        THEN 'TRD-' || l_orderkey || '-' || l_linenumber END AS trade_id,
      'ACCT-' || o_custkey AS account_id, 'CUST-' || o_custkey AS customer_id,
      'SEC-' || l_partkey AS security_id, CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
      CAST(floor(CAST(round(l_extendedprice * 100) AS BIGINT) / l_quantity) / 100.0
        AS DECIMAL(18,2)) AS price,
      CAST(l_extendedprice AS DECIMAL(18,2)) AS transaction_amount,
      CASE WHEN l_suppkey % 61 = 0 THEN 'ZZZ' ELSE {pick(CURRENCIES, 'l_suppkey % 6')} END AS currency_code,
      CASE l_returnflag WHEN 'A' THEN 'BUY' WHEN 'R' THEN 'SELL' ELSE 'HOLD' END AS side,
      CASE WHEN l_linestatus = 'O' THEN 'PENDING' ELSE 'POSTED' END AS transaction_status,
      l_shipdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)) AS event_timestamp,
      l_shipdate + to_minutes(CAST(l_partkey % 1440 + l_suppkey % 60 AS BIGINT)) AS processing_timestamp,
      {pick(COUNTRIES, 'o_custkey % 6')} AS country_code,
      CAST((l_partkey * 3 + l_linenumber) % 101 AS INT) AS risk_score
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "txn_latest": latest("txn_raw", names("transactions"), "transaction_id"),
    "pay_latest": latest("pay_raw", names("payments"), "payment_id"),
    "trade_latest": latest("trade_raw", names("trades"), "trade_id"),
    "txn_tagged": tag(
        "txn_latest", "transaction_id", TRANSACTION_STATUSES,
        f"transaction_type IN ({lit(TRANSACTION_TYPES)})",
    ),
    "pay_tagged": tag(
        "pay_latest", "payment_id", PAYMENT_STATUSES,
        f"transaction_status IN ({lit(PAYMENT_STATUSES)})",
    ),
    "trade_tagged": tag(
        "trade_latest", "trade_id", TRANSACTION_STATUSES, "side IN ('BUY', 'SELL')"
    ),
    "transactions": "SELECT * FROM txn_tagged WHERE rejection_reason IS NULL",
    "payments": "SELECT * FROM pay_tagged WHERE rejection_reason IS NULL",
    "trades": "SELECT * FROM trade_tagged WHERE rejection_reason IS NULL",
    "fct_transactions": """SELECT t.*, a.account_type,
      CASE WHEN t.risk_score >= 80 THEN 'HIGH' WHEN t.risk_score >= 50 THEN 'MEDIUM' ELSE 'LOW' END
        AS risk_band
      FROM transactions t LEFT JOIN accounts a ON t.account_id = a.account_id""",
    "daily_net": """SELECT account_id, CAST(event_timestamp AS DATE) AS d,
      sum(CASE WHEN transaction_type IN ('CREDIT', 'REFUND') THEN transaction_amount
        ELSE -transaction_amount END) AS net
      FROM transactions WHERE account_id IS NOT NULL GROUP BY 1, 2""",
    "daily_running": """SELECT *, sum(net) OVER (PARTITION BY account_id ORDER BY d
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running,
      sum(net) OVER (PARTITION BY account_id) AS total FROM daily_net""",
    "balances": """SELECT a.account_id || '-' || CAST(coalesce(r.d, CAST(a.opened_at AS DATE)) AS VARCHAR)
        AS balance_id,
      a.account_id, a.customer_id,
      CAST(coalesce(r.d, CAST(a.opened_at AS DATE)) AS TIMESTAMP) AS balance_date,
      CAST(a.current_balance - coalesce(total, 0) + coalesce(running, 0) - coalesce(net, 0)
        AS DECIMAL(18,2)) AS opening_balance,
      CAST(a.current_balance - coalesce(total, 0) + coalesce(running, 0) AS DECIMAL(18,2))
        AS closing_balance,
      a.currency_code, coalesce(r.d, CAST(a.opened_at AS DATE)) AS processing_date
      FROM accounts a LEFT JOIN daily_running r ON a.account_id = r.account_id""",
    "ev_kind": """SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN 'trade'
        WHEN event_type = 'click' THEN 'transaction' WHEN event_type = 'view' THEN 'payment'
        ELSE 'error' END AS kind, event_id AS k FROM events""",
    "ev_wide": f"""SELECT k, CASE WHEN k % 113 <> 0 THEN 'EVT-' || k END AS event_id, kind AS event_type,
      'SEC-' || (k % 50) AS partition_key,
      CASE WHEN kind = 'transaction' THEN 'TXN-E' || k END AS transaction_id,
      CASE WHEN kind = 'payment' THEN 'PAY-E' || k END AS payment_id,
      CASE WHEN kind = 'trade' AND k % 43 <> 0 THEN 'TRD-E' || k END AS trade_id,
      'ACCT-' || user_id AS account_id, 'CUST-' || user_id AS customer_id,
      CASE WHEN kind = 'trade' THEN 'SEC-' || (k % 50) END AS security_id,
      CASE WHEN kind = 'transaction' THEN {pick(TRANSACTION_TYPES, 'k % 6')} END AS transaction_type,
      CASE WHEN k % 211 = 0 THEN 'abc' ELSE CAST(CAST(CASE WHEN k % 89 = 0 THEN -value ELSE value END
        AS DECIMAL(18,2)) AS VARCHAR) END AS transaction_amount,
      CASE WHEN k % 83 = 0 THEN 'ZZZ' ELSE {pick(CURRENCIES, 'user_id % 6')} END AS currency_code,
      CASE WHEN kind = 'payment' THEN {pick(PAYMENT_STATUSES, 'k % 4')}
        ELSE {pick(TRANSACTION_STATUSES, 'k % 4')} END AS transaction_status,
      ts AS event_timestamp, ts + to_seconds(k % 60) AS processing_timestamp,
      CASE WHEN kind = 'transaction' THEN {pick(MERCHANT_CATEGORIES, 'k % 7')} END AS merchant_category,
      {pick(COUNTRIES, 'user_id % 6')} AS country_code,
      CAST(CASE WHEN k % 73 = 0 THEN 150 WHEN k % 71 = 0 THEN NULL ELSE k % 101 END AS INT) AS risk_score,
      CASE WHEN kind = 'payment' THEN 'ACCT-' || (user_id + 1) END AS counterparty_account_id,
      CASE WHEN kind = 'trade' THEN json_extract_string(props, '$.k') END AS quantity,
      CASE WHEN kind = 'trade' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS price,
      CASE WHEN kind = 'trade' THEN CASE WHEN k % 31 = 0 THEN 'HOLD' WHEN k % 2 = 0 THEN 'BUY'
        ELSE 'SELL' END END AS side,
      k % 37 = 0 AS duplicate_flag, k % 41 = 0 AS late_arrival_flag,
      ts + to_seconds(CASE WHEN k % 41 = 0 THEN 3 * 86400 ELSE 5 END) AS arrival_timestamp
      FROM ev_kind""",
    # Every thirty-seventh event is sent twice; copies with an id collapse, others stay.
    "ev_sent": """SELECT *, 0 AS copy FROM ev_wide
      UNION ALL SELECT *, 1 AS copy FROM ev_wide WHERE k % 37 = 0""",
    "ev_tagged": f"""SELECT *, processing_timestamp AS ingestion_timestamp,
      CAST(processing_timestamp AS DATE) AS processing_date, {_EVENT_REASON}
      FROM ev_sent WHERE k % 101 <> 0 AND (copy = 0 OR event_id IS NULL)""",
    "ev_valid": "SELECT * FROM ev_tagged WHERE rejection_reason IS NULL",
    "ev_rejected": "SELECT * FROM ev_tagged WHERE rejection_reason IS NOT NULL",
    "stream_trades": """SELECT event_id, trade_id, account_id, customer_id, security_id,
      CAST(quantity AS DECIMAL(18,2)) AS quantity, CAST(price AS DECIMAL(18,2)) AS price,
      CAST(transaction_amount AS DECIMAL(18,2)) AS transaction_amount, currency_code, side,
      transaction_status, event_timestamp, processing_timestamp, country_code, risk_score,
      ingestion_timestamp, processing_date, CAST(event_timestamp AS DATE) AS trade_date,
      date_trunc('minute', event_timestamp) AS trade_minute
      FROM ev_valid WHERE event_type = 'trade'""",
    "minute_metrics": f"""SELECT security_id, currency_code, side, trade_minute, processing_date,
      count(*) AS trade_count, sum(quantity) AS total_quantity,
      sum(transaction_amount) AS total_transaction_amount, {avg_money('price')} AS avg_trade_price,
      max(risk_score) AS max_risk_score FROM stream_trades GROUP BY 1, 2, 3, 4, 5""",
    "exposure": """SELECT customer_id, account_id, security_id, currency_code, processing_date,
      count(*) FILTER (side = 'BUY') AS buy_trade_count,
      count(*) FILTER (side = 'SELL') AS sell_trade_count,
      sum(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS net_quantity,
      sum(transaction_amount) AS gross_notional_amount, avg(risk_score) AS avg_risk_score,
      max(event_timestamp) AS latest_event_timestamp FROM stream_trades GROUP BY 1, 2, 3, 4, 5""",
    "performance": f"""SELECT processing_date, CAST(event_timestamp AS DATE) AS transaction_date,
      currency_code, merchant_category, transaction_type, sum(transaction_amount) AS total,
      count(*) AS transaction_count, {avg_money('transaction_amount')} AS average
      FROM fct_transactions GROUP BY 1, 2, 3, 4, 5""",
    "regulatory": """SELECT processing_date, count(*) AS transaction_count,
      sum(CASE WHEN transaction_type = 'DEBIT' THEN transaction_amount ELSE 0 END) AS debit_total,
      sum(CASE WHEN transaction_type = 'CREDIT' THEN transaction_amount ELSE 0 END) AS credit_total,
      abs(debit_total - credit_total) AS debit_credit_difference,
      CAST(abs(debit_total - credit_total) AS DOUBLE)
        / nullif(CAST(debit_total + credit_total AS DOUBLE), 0) AS net_flow_imbalance_ratio
      FROM fct_transactions GROUP BY 1""",
    "customer_risk": f"""SELECT c.customer_id, c.full_name, c.country_code,
      c.risk_score AS customer_risk_score, count(t.transaction_id) AS transaction_count,
      sum(t.transaction_amount) AS total_transaction_amount,
      {avg_money('t.transaction_amount')} AS avg_transaction_amount,
      max(t.risk_score) AS max_transaction_risk_score
      FROM customers c LEFT JOIN fct_transactions t ON c.customer_id = t.customer_id
      GROUP BY 1, 2, 3, 4""",
    "latest_balances": """SELECT account_id, max(balance_date) AS latest_balance_date,
      arg_max(closing_balance, balance_date) AS latest_closing_balance
      FROM balances GROUP BY 1""",
}


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the views it mentions, directly or through other views."""
    known = {**CTES, **(extra or {})}
    order = list(known)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in order:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(known[name])

    visit(sql)
    if not needed:
        return sql
    parts = [f"{n} AS ({known[n]})" for n in order if n in needed]
    head = "WITH " + ",\n".join(parts)
    if sql.startswith("WITH "):
        return head + ",\n" + sql.removeprefix("WITH ")
    return head + "\n" + sql
