"""Expectation suites, table tests, reconciliation and history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import checks, history, recon, suites
from tidemark.plans import marts, model
from tidemark.schemas import CURRENCIES
from tidemark.session import scratch
from tidemark.sinks.history_table import HistoryTable
from tidemark.sinks.tables import write_table
from tidemark.testbed.ctes import lit
from tidemark.testbed.registry import count_rows, query
from tidemark.testbed.views import Views

RUN_AT = datetime(2024, 6, 1, 12, 0, 0)
CHECKED = "2024-06-01 12:00:00"


def checked_at():
    return F.lit(CHECKED).cast("timestamp")


# ---- Q1–Q10 ------------------------------------------------------------------------------------
def expectation(i: int, kind: str, column: str | None, mostly: float, tested: str, bad: str, frm: str) -> str:
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    ok = (
        f"({bad}) = 0" if kind == suites.COLUMNS
        else f"CASE WHEN ({tested}) = 0 THEN ({bad}) = 0 ELSE 1 - CAST(({bad}) AS DOUBLE) / ({tested}) >= {mostly} END"
    )
    return (
        f"SELECT CAST({i} AS INT) AS position, '{kind}' AS kind, {name} AS column_name, "
        f"CAST({mostly} AS DOUBLE) AS mostly, CAST({tested} AS BIGINT) AS tested, "
        f"CAST({bad} AS BIGINT) AS unexpected, {ok} AS success FROM {frm}"
    )


def suite_sql(suite: str, source: str, parameters: dict | None = None) -> str:
    """The suite as one SELECT per expectation."""
    parts = []
    for i, rule in enumerate(suites.SUITES[suite]):
        kind, column, mostly = rule["kind"], rule.get("column"), rule.get("mostly", 1.0)
        frm, tested = source, f"count({column})"
        if kind == suites.COLUMNS:
            parts.append(expectation(i, kind, None, 1.0, str(len(rule["columns"])), "0", "(SELECT 1)"))
            continue
        if kind == suites.NOT_NULL:
            tested, bad = "count(*)", f"count(*) - count({column})"
        elif kind == suites.UNIQUE:
            frm = f"(SELECT {column}, count(*) AS c FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"
            tested, bad = "coalesce(sum(c), 0)", "coalesce(sum(CASE WHEN c > 1 THEN c ELSE 0 END), 0)"
        elif kind == suites.IN_SET:
            bad = f"count(*) FILTER ({column} NOT IN ({lit(rule['values'])}))"
        elif kind == suites.REGEX:
            bad = f"count(*) FILTER (NOT regexp_matches({column}, '{rule['pattern']}'))"
        else:
            low, high = ((parameters or {})[x["parameter"]] if isinstance(x, dict) else x
                         for x in (rule["min"], rule["max"]))
            bad = f"count(*) FILTER ({column} < {low} OR {column} > {high})"
        parts.append(expectation(i, kind, column, mostly, tested, bad, frm))
    return "\nUNION ALL ".join(parts)


def _suite(name: str, suite: str, source: str, frame) -> None:
    @query(f"q07_suite_{name}", suite_sql(suite, source))
    def _(v):
        columns = suites.suite_columns(suite)
        return suites.evaluate_suite(frame(v).select(*columns), suite)


def _typed(v: Views, name: str) -> DataFrame:
    from tidemark.operators.clean import to_money

    return to_money(getattr(v, name), "transaction_amount")


FRAMES = {
    "customers": ("customers", lambda v: v.customers),
    "accounts": ("accounts", lambda v: v.accounts),
    "securities": ("securities", lambda v: v.securities),
    "transactions": ("txn_raw", lambda v: _typed(v, "transactions_raw")),
    "payments": ("pay_raw", lambda v: _typed(v, "payments_raw")),
    "trades": ("trade_raw", lambda v: _typed(v, "trades_raw")),
}
for _name, (_source, _frame) in FRAMES.items():
    _suite(_name, suites.SUITE_BY_DATASET[_name], _source, _frame)

@query(
    "q01_failing_column_set",
    f"""SELECT CAST(0 AS INT) AS position, CAST({len(suites.suite_columns("transactions_bronze"))} AS BIGINT)
      AS tested, CAST(2 AS BIGINT) AS unexpected, false AS success, count(*) > 0 AS has_rows FROM txn_raw""",
)
def _(v):
    """A table that lacks one column of its suite and has another too many breaks the rule."""
    odd = _typed(v, "transactions_raw").withColumnRenamed("risk_score", "risk")
    results = suites.evaluate_suite(odd, "transactions_bronze").filter(F.col("kind") == suites.COLUMNS)
    some = odd.agg((F.count("*") > 0).alias("has_rows"))
    return recon.one_row(results.select("position", "tested", "unexpected", "success"), some)


_EVENTS = {"ev_typed": """SELECT * REPLACE (TRY_CAST(transaction_amount AS DECIMAL(18,2)) AS transaction_amount)
  FROM ev_tagged"""}


@query("q07_suite_stream_events", suite_sql("streaming_events_microbatch", "ev_typed"), _EVENTS)
def _(v):
    suite = "streaming_events_microbatch"
    rows = v.events_tagged.select(*suites.suite_columns(suite))
    amount = F.col("transaction_amount").try_cast("decimal(18,2)")
    return suites.evaluate_suite(rows.withColumn("transaction_amount", amount), suite)


_GOLD = {
    "gold_recon": """SELECT source_row_count, target_row_count, row_count_difference, debit_total,
      credit_total, abs(debit_total - credit_total) AS debit_credit_difference, duplicate_rate,
      rejected_rate FROM (SELECT (SELECT count(*) FROM transactions) AS source_row_count,
      (SELECT count(*) FROM transactions) AS target_row_count, 0::BIGINT AS row_count_difference,
      (SELECT sum(transaction_amount) FROM transactions WHERE transaction_type = 'DEBIT') AS debit_total,
      (SELECT sum(transaction_amount) FROM transactions WHERE transaction_type = 'CREDIT') AS credit_total,
      ((SELECT count(transaction_id) FROM txn_raw) - (SELECT count(transaction_id) FROM txn_tagged))
        / CAST((SELECT count(transaction_id) FROM txn_raw) AS DOUBLE) AS duplicate_rate,
      (SELECT count(*) FILTER (rejection_reason IS NOT NULL) / CAST(count(*) AS DOUBLE) FROM txn_tagged)
        AS rejected_rate)"""
}


def _gold(v: Views) -> DataFrame:
    return recon.gold_reconciliation(
        v.transactions_raw, v.transactions_tagged, model.gold(v.transactions, "transactions"),
        "transaction_id",
    )


@query(
    "q10_gold_reconciliation",
    """SELECT * REPLACE (CAST(debit_total AS DOUBLE) AS debit_total, CAST(credit_total AS DOUBLE) AS credit_total,
      CAST(debit_credit_difference AS DOUBLE) AS debit_credit_difference) FROM gold_recon""",
    _GOLD,
)
def _(v):
    return _gold(v)


@query("q07_suite_gold_load", suite_sql("gold_load_validation", "gold_recon", suites.GOLD_THRESHOLDS), _GOLD)
def _(v):
    """Also the gold load thresholds, given as suite parameters."""
    return suites.evaluate_suite(_gold(v), "gold_load_validation", suites.GOLD_THRESHOLDS)


def summary_sql(dataset: str, source: str) -> str:
    suite = suites.SUITE_BY_DATASET[dataset]
    return f"""SELECT '{suite}' AS suite_name, bool_and(success) AS success,
      count(*) AS evaluated_expectations, count(*) FILTER (success) AS successful_expectations,
      count(*) FILTER (NOT success) AS unsuccessful_expectations,
      count(*) FILTER (success) * 100.0 / count(*) AS success_percent,
      '{suite}-20240601T120000Z' AS run_identifier, 'batch' AS stage, '{dataset}' AS dataset_name
      FROM ({suite_sql(suite, source)})"""


@query("q08_q09_dataset_summaries",
       " UNION ALL ".join(summary_sql(n, s) for n, (s, _) in FRAMES.items()).replace(
           "100.0", "100.0::DOUBLE"))
def _(v):
    """All datasets with a suite, one summary row each; balances have none and are passed over."""
    frames = {n: f(v) for n, (_, f) in FRAMES.items()} | {"daily_account_balances": v.balances}
    return suites.validate_datasets(frames, "batch", RUN_AT).drop("created_at").withColumn(
        "success_percent", F.col("success_percent").cast("double")
    )


@query(
    "q08_failure_metric",
    f"""SELECT 'GreatExpectationsFailures' AS metric_name, suite_name, dataset_name, stage,
      CASE WHEN success THEN 0.0 ELSE 1.0 END::DOUBLE AS value, 'Count' AS unit
      FROM ({summary_sql('payments', 'pay_raw')})""",
)
def _(v):
    results = suites.evaluate_suite(_typed(v, "payments_raw"), "payments_bronze")
    summary = suites.summarize(results, "payments_bronze", "payments", "batch", RUN_AT)
    return suites.failure_metric(summary)


# ---- Q11–Q28 -----------------------------------------------------------------------------------
@query("q11_unique", """SELECT transaction_id AS unique_field, count(*) AS n_records FROM txn_raw
  WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def _(v):
    return checks.unique(v.transactions_raw, "transaction_id")


@query("q11_not_null", "SELECT account_id, event_timestamp FROM txn_raw WHERE transaction_id IS NULL")
def _(v):
    return checks.not_null(v.transactions_raw, "transaction_id").select("account_id", "event_timestamp")


@query("q11_accepted_values", f"""SELECT currency_code AS value_field, count(*) AS n_records FROM txn_raw
  WHERE currency_code NOT IN ({lit(CURRENCIES)}) GROUP BY 1""")
def _(v):
    return checks.accepted_values(v.transactions_raw, "currency_code", CURRENCIES)


@query("q11_relationships", """SELECT 'CUST-' || c_custkey AS id FROM customer
  WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def _(v):
    """Customers that no event refers to, over both whole tables."""
    name = lambda c: F.concat(F.lit("CUST-"), F.col(c).cast("string")).alias("cust")
    customers = v.table("customer").select(name("c_custkey"))
    return checks.relationships(customers, "cust", v.table("events").select(name("user_id")), "cust")


@query("q11_relationships_all_suppliers", """SELECT 'SEC-' || l_suppkey AS id FROM lineitem
  WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""")
def _(v):
    """Only lines whose supplier doesn't exist, whatever the balance."""
    lines = v.table("lineitem").select(
        F.concat(F.lit("SEC-"), F.col("l_suppkey").cast("string")).alias("sec"))
    firms = v.table("supplier").select(
        F.concat(F.lit("SEC-"), F.col("s_suppkey").cast("string")).alias("sec"))
    return checks.relationships(lines, "sec", firms, "sec")


@query("q12_accepted_range", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
  WHERE NOT l_quantity > 2 OR NOT l_quantity < 49""")
def _(v):
    rows = v.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return checks.accepted_range(rows, "l_quantity", 2, 49, inclusive=False)


@query("q13_at_least_one", """SELECT account_id, 0::BIGINT AS filler_column FROM
  (SELECT account_id, CASE WHEN risk_score > 80 THEN risk_score END AS r FROM txn_raw)
  GROUP BY 1 HAVING count(r) = 0""")
def _(v):
    rows = v.transactions_raw.select(
        "account_id", F.when(F.col("risk_score") > 80, F.col("risk_score")).alias("r"))
    return checks.at_least_one(rows, "r", ["account_id"])


@query("q13_at_least_one_in_table", """SELECT 'r' AS column_name, count(*) FILTER (n = 0) AS failures FROM
  (SELECT count(CASE WHEN risk_score > 1000 THEN 1 END) AS n FROM txn_raw
   UNION ALL SELECT count(risk_score) FROM txn_raw)""")
def _(v):
    """An all-null column fails with one row, a filled one passes with none."""
    rows = v.transactions_raw.withColumn("none", F.when(F.col("risk_score") > 1000, 1))
    failing = checks.at_least_one(rows, "none").unionByName(checks.at_least_one(rows, "risk_score"))
    return failing.agg(F.lit("r").alias("column_name"), count_rows().alias("failures"))


@query("q14_cardinality_equality", """WITH a AS (SELECT o_custkey AS value, count(*) AS num_rows FROM orders GROUP BY 1),
  b AS (SELECT c_custkey AS value, count(*) AS num_rows FROM customer GROUP BY 1)
  SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _(v):
    return checks.cardinality_equality(v.table("orders"), "o_custkey", v.table("customer"), "c_custkey")


@query("q15_equal_rowcount", """SELECT a.g AS user_group_a, b.g AS user_group_b, count_a, count_b,
  abs(count_a - count_b) AS diff_count FROM
  (SELECT user_id % 7 AS g, count(*) AS count_a FROM events WHERE user_id % 7 <> 2 GROUP BY 1) a FULL JOIN
  (SELECT user_id % 7 AS g, count(*) AS count_b FROM events WHERE event_type <> 'error' AND user_id % 7 <> 5 GROUP BY 1) b
  ON a.g = b.g""")
def _(v):
    rows = v.table("events").withColumn("user_group", F.col("user_id") % 7)
    return checks.equal_rowcount(
        rows.filter("user_group <> 2"),
        rows.filter("event_type <> 'error' and user_group <> 5"), ["user_group"])


@query("q15_equal_rowcount_whole", """SELECT (SELECT count(*) FROM orders) AS count_a,
  (SELECT count(*) FROM lineitem) AS count_b,
  abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM lineitem)) AS diff_count""")
def _(v):
    return checks.equal_rowcount(v.table("orders"), v.table("lineitem"))


_EQ = {
    "eq_a": "SELECT o_custkey, o_orderstatus, CAST(round(o_totalprice, 0) AS DECIMAL(28,6)) AS o_totalprice FROM orders",
    "eq_b": """SELECT o_custkey, CASE WHEN o_custkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
      CAST(round(o_totalprice, 0) AS DECIMAL(28,6)) AS o_totalprice FROM orders""",
}


@query("q16_equality_with_precision", """SELECT 'a_minus_b' AS which_diff, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice
  FROM (SELECT * FROM eq_a EXCEPT SELECT * FROM eq_b)
  UNION ALL SELECT 'b_minus_a', o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE)
  FROM (SELECT * FROM eq_b EXCEPT SELECT * FROM eq_a)""", _EQ)
def _(v):
    a = v.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                 F.round("o_totalprice").alias("o_totalprice"))
    changed = F.when(F.col("o_custkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus"))
    b = a.withColumns({"o_orderstatus": changed, "o_totalprice": F.col("o_totalprice") + 0.0001})
    out = checks.equality(a, b, exclude_columns=["o_orderkey"], precision=2)
    return out


@query("q17_expression_is_true", """SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE NOT (l_extendedprice * (1 - l_discount) >= 5000)""")
def _(v):
    failing = checks.expression_is_true(
        v.table("lineitem"), ">= 5000", "l_extendedprice * (1 - l_discount)")
    return failing.select("l_orderkey", "l_linenumber")


@query("q18_fewer_rows_than", """SELECT a.s AS kind_a, b.s AS kind_b, a.n AS count_our_model, b.n AS count_comparison_model,
  CAST(CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta FROM
  (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1) a FULL JOIN
  (SELECT l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1) b ON a.s = b.s""")
def _(v):
    return checks.fewer_rows_than(
        v.table("orders").select(F.col("o_orderstatus").alias("kind")),
        v.table("lineitem").select(F.col("l_linestatus").alias("kind")), ["kind"])


def _ranges(name: str, gaps: str, zero: bool, op: str, grouped: bool) -> None:
    first = "<=" if zero else "<"
    part = "PARTITION BY g" if grouped else ""
    key = "g, " if grouped else ""

    @query(
        name,
        f"""SELECT {key}lower_bound, upper_bound, next_lower_bound, count(*) AS failing_rows FROM
          (SELECT *, coalesce(lower_bound {first} upper_bound, false) AS a,
            coalesce(upper_bound {op} next_lower_bound, is_last, false) AS b FROM
            (SELECT *, lead(lower_bound) OVER ({part} ORDER BY lower_bound, upper_bound) AS next_lower_bound,
              row_number() OVER ({part} ORDER BY lower_bound DESC, upper_bound DESC) = 1 AS is_last FROM
              (SELECT l_suppkey AS g, CAST(l_shipdate AS DATE) - DATE '1990-01-01' AS lower_bound,
                CAST(l_shipdate AS DATE) - DATE '1990-01-01' + CAST(l_linenumber AS INT) - 2 AS upper_bound
               FROM lineitem)))
          WHERE NOT (a AND b) GROUP BY ALL""",
    )
    def _(v):
        start = F.date_diff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date")).cast("bigint")
        rows = v.table("lineitem").select(
            F.col("l_suppkey").alias("g"), start.alias("lo"),
            (start + F.col("l_linenumber") - 2).alias("hi"))
        return checks.mutually_exclusive_ranges(rows, "lo", "hi", ["g"] if grouped else [], gaps, zero)


_ranges("q19_ranges_gaps_allowed", "allowed", False, "<=", True)
_ranges("q19_ranges_no_gaps_zero_length", "not_allowed", True, "=", True)
_ranges("q19_ranges_gaps_required_global", "required", False, "<", False)


@query("q20_not_accepted_values", "SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'view', 'none')")
def _(v):
    return checks.not_accepted_values(v.table("events"), "event_type", ["error", "view", "none"])


@query("q21_not_constant", """SELECT l_orderkey, count(DISTINCT l_returnflag) AS filler_column FROM lineitem
  GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1""")
def _(v):
    return checks.not_constant(v.table("lineitem"), "l_returnflag", ["l_orderkey"])


@query("q22_not_empty_string", """SELECT trim(s) AS s FROM
  (SELECT CASE WHEN o_orderkey % 9 = 0 THEN '  ' ELSE o_orderstatus END AS s FROM orders) WHERE trim(s) = ''""")
def _(v):
    blank = F.when(F.col("o_orderkey") % 9 == 0, "  ").otherwise(F.col("o_orderstatus"))
    return checks.not_empty_string(v.table("orders").select(blank.alias("s")), "s")


@query("q23_not_null_proportion", """SELECT account_id, count(transaction_id) / CAST(count(*) AS DOUBLE) AS not_null_proportion
  FROM txn_raw GROUP BY 1 HAVING count(transaction_id) / CAST(count(*) AS DOUBLE) < 0.95""")
def _(v):
    return checks.not_null_proportion(v.transactions_raw, "transaction_id", 0.95, group_by=["account_id"])


@query("q24_recency", """SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30 23:00:00' AS threshold
  FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 23:00:00'""")
def _(v):
    as_of = F.lit("2024-01-31 11:00:00").cast("timestamp")
    return checks.recency(v.table("events"), "ts", "hour", 12, group_by=["user_id"], as_of=as_of)


@query("q25_relationships_where", """SELECT o_custkey AS id FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')""")
def _(v):
    return checks.relationships(
        v.table("orders"), "o_custkey", v.table("customer"), "c_custkey",
        "o_orderstatus <> 'P'", "c_mktsegment <> 'MACHINERY'")


@query("q26_sequential_values", """SELECT l_linenumber, l_orderkey, previous_value, count(*) AS failing_rows FROM
  (SELECT l_linenumber, l_orderkey, lag(l_orderkey) OVER (PARTITION BY l_linenumber ORDER BY l_orderkey) AS previous_value
   FROM lineitem) WHERE NOT (l_orderkey = previous_value + 2) GROUP BY ALL""")
def _(v):
    return checks.sequential_values(v.table("lineitem"), "l_orderkey", 2, group_by=["l_linenumber"])


@query("q26_sequential_days", """SELECT o_orderdate, previous_value, count(*) AS failing_rows FROM
  (SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderdate) AS previous_value FROM orders)
  WHERE NOT (o_orderdate = previous_value + INTERVAL 1 DAY) GROUP BY ALL""")
def _(v):
    return checks.sequential_values(v.table("orders"), "o_orderdate", 1, "day")


@query("q27_unique_combination", """SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(v):
    return checks.unique_combination(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("q28_imbalance_over_tolerance", """SELECT CAST(processing_date AS VARCHAR) AS processing_date, net_flow_imbalance_ratio
  FROM regulatory WHERE coalesce(net_flow_imbalance_ratio, 0) > 0.75""")
def _(v):
    mart = marts.regulatory_reconciliation(v.fct_transactions)
    return checks.imbalance_over(mart).select("processing_date", "net_flow_imbalance_ratio")


@query("q28_negative_amounts", """SELECT transaction_id, CAST(transaction_amount AS DOUBLE) AS transaction_amount
  FROM txn_raw WHERE transaction_amount < 0""")
def _(v):
    return checks.negative_amounts(_typed(v, "transactions_raw")).select(
        "transaction_id", "transaction_amount")


# ---- R: reconciliation and history -------------------------------------------------------------
@query("r01_row_counts", """SELECT 'FACT_TRANSACTION' AS dataset_name, (SELECT count(*) FROM txn_raw) AS raw_row_count,
  (SELECT count(*) FROM transactions) AS staging_row_count,
  (SELECT count(*) FROM txn_raw) - (SELECT count(*) FROM transactions) AS row_count_difference""")
def _(v):
    return recon.row_count_reconciliation("FACT_TRANSACTION", v.transactions_raw, v.transactions)


@query("r02_amounts", """SELECT 'FACT_TRANSACTION' AS dataset_name, CAST(a AS DOUBLE) AS raw_amount_sum, CAST(b AS DOUBLE) AS staging_amount_sum,
  CAST(abs(a - b) AS DOUBLE) AS amount_difference FROM
  (SELECT (SELECT sum(transaction_amount) FROM txn_raw) AS a, (SELECT sum(transaction_amount) FROM transactions) AS b)""")
def _(v):
    return recon.amount_reconciliation("FACT_TRANSACTION", _typed(v, "transactions_raw"), v.transactions)


@query("r03_duplicate_identifiers", """SELECT trade_id, count(*) AS duplicate_count FROM trade_raw GROUP BY 1 HAVING count(*) > 1""")
def _(v):
    return recon.duplicate_identifiers(v.trades_raw, "trade_id")


def _result(v: Views) -> DataFrame:
    return recon.reconciliation_result(
        "transactions", v.transactions_tagged, v.transactions, v.transactions_rejected,
        "transaction_id", "transaction_amount", checked_at())


RESULT = {"recon_row": """SELECT *, source_row_count - target_row_count AS row_count_difference,
  rejected_record_count || ' rejected, 0 duplicated' AS details FROM
  (SELECT 'transactions-20240601T120000Z' AS reconciliation_id, 'transactions' AS dataset_name,
  (SELECT count(*) FROM txn_tagged) AS source_row_count, (SELECT count(*) FROM transactions) AS target_row_count,
  (SELECT CAST(sum(transaction_amount) AS DOUBLE) FROM txn_tagged) AS source_amount_sum,
  (SELECT CAST(sum(transaction_amount) AS DOUBLE) FROM transactions) AS target_amount_sum,
  (SELECT CAST(abs(sum(transaction_amount) FILTER (rejection_reason IS NOT NULL)) AS DOUBLE) FROM txn_tagged) AS amount_difference,
  0::BIGINT AS duplicate_identifier_count,
  (SELECT count(*) FROM txn_tagged WHERE rejection_reason IS NOT NULL) AS rejected_record_count,
  TIMESTAMP '2024-06-01 12:00:00' AS checked_at, 'OK' AS status)"""}


@query("r06_reconciliation_result", "SELECT * FROM recon_row", RESULT)
def _(v):
    return _result(v)


@query("r04_rejected_record_audit", """SELECT dataset_name, rejected_record_count, checked_at, status, details
  FROM recon_row""", RESULT)
def _(v):
    return recon.rejected_record_audit(_result(v))


@query("r05_load_history_report", """SELECT 'load-' || o_orderstatus AS load_id, 'FACT_TRANSACTION' AS target_table,
  'LOADED' AS status, count(*) AS rows_loaded, 0::BIGINT AS error_count, CAST(NULL AS VARCHAR) AS first_error,
  max(o_orderdate) AS load_finished_at FROM orders GROUP BY o_orderstatus""")
def _(v):
    loads = v.table("orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("rows_loaded"), F.max("o_orderdate").alias("load_finished_at"))
    return recon.load_history_report(loads.select(
        F.concat(F.lit("load-"), "o_orderstatus").alias("load_id"),
        F.lit("FACT_TRANSACTION").alias("target_table"), F.lit("LOADED").alias("status"),
        "rows_loaded", F.lit(0).cast("bigint").alias("error_count"),
        F.lit(None).cast("string").alias("first_error"), "load_finished_at"))


@query("r07_scd2_snapshot", """WITH c AS (SELECT *, risk_score % 4 = 0 AS moved,
    risk_score % 4 = 0 AND (country_code <> 'JP' OR risk_score % 8 = 0) AS changed,
    risk_score % 10 <> 9 AS known FROM customers)
  SELECT customer_id, full_name, email, country_code, risk_score, TIMESTAMP '2024-01-01' AS valid_from,
    CASE WHEN changed THEN TIMESTAMP '2024-02-01' END AS valid_to FROM c WHERE known
  UNION ALL SELECT customer_id, full_name, CASE WHEN moved AND risk_score % 8 = 0 THEN NULL ELSE email END,
    CASE WHEN moved THEN 'JP' ELSE country_code END, risk_score, TIMESTAMP '2024-02-01', NULL
    FROM c WHERE changed OR NOT known""")
def _(v):
    """Two runs: a first load without some customers, then changes (also to null) and new keys."""
    people = v.customers.drop("created_at")
    first = history.start_history(
        people.filter("risk_score % 10 <> 9"), "customer_id", F.lit("2024-01-01").cast("timestamp"))
    moved = F.col("risk_score") % 4 == 0
    second = people.withColumns({
        "country_code": F.when(moved, "JP").otherwise(F.col("country_code")),
        "email": F.when(moved & (F.col("risk_score") % 8 == 0), None).otherwise(F.col("email")),
    })
    out = history.apply_snapshot(
        first, second, "customer_id", ["full_name", "email", "country_code", "risk_score"],
        F.lit("2024-02-01").cast("timestamp"))
    return out.drop("scd_id", "updated_at")


@query("r07_history_in_storage", """WITH c AS (SELECT *, risk_score % 4 = 0 AS moved,
    risk_score % 4 = 0 AND (country_code <> 'JP' OR risk_score % 8 = 0) AS changed,
    risk_score % 10 <> 9 AS known, risk_score = 7 AS named FROM customers)
  SELECT customer_id, full_name, email, country_code, risk_score, TIMESTAMP '2024-01-01' AS valid_from,
    CASE WHEN changed THEN TIMESTAMP '2024-02-01' WHEN named THEN TIMESTAMP '2024-03-01' END AS valid_to,
    true AS others_kept FROM c WHERE known
  UNION ALL SELECT customer_id, full_name, CASE WHEN moved AND risk_score % 8 = 0 THEN NULL ELSE email END,
    CASE WHEN moved THEN 'JP' ELSE country_code END, risk_score, TIMESTAMP '2024-02-01', NULL, true
    FROM c WHERE changed OR NOT known
  UNION ALL SELECT customer_id, upper(full_name), email, country_code, risk_score,
    TIMESTAMP '2024-03-01', NULL, true FROM c WHERE named""")
def _(v):
    """Three snapshots into a stored table, the last one with few changes: files of closed versions and
    of open parts without a change stay as they are."""
    people = v.customers.drop("created_at")
    columns = ["full_name", "email", "country_code", "risk_score"]
    table = HistoryTable(v.spark, scratch(v.spark, "history"), "customer_id", columns, buckets=16)
    at = lambda day: F.lit(day).cast("timestamp")
    table.snapshot(people.filter("risk_score % 10 <> 9"), at("2024-01-01"))
    moved = F.col("risk_score") % 4 == 0
    second = people.withColumns({
        "country_code": F.when(moved, "JP").otherwise(F.col("country_code")),
        "email": F.when(moved & (F.col("risk_score") % 8 == 0), None).otherwise(F.col("email")),
    })
    before = table.snapshot(second, at("2024-02-01"))
    after = table.snapshot(second.withColumn("full_name", F.when(
        F.col("risk_score") == 7, F.upper("full_name")).otherwise(F.col("full_name"))), at("2024-03-01"))
    closed = {p: f for p, f in before.parts.items() if p.startswith("closed-")}
    kept = closed.items() <= after.parts.items() and bool(closed)
    return table.read().select("customer_id", *columns, "valid_from", "valid_to").withColumn(
        "others_kept", F.lit(kept))


@query("r08_inventory", """SELECT 'fact_transaction' AS table_name, count(DISTINCT strftime(processing_date, '%Y')) > 0 AS has_files,
  max(strftime(processing_date, '%Y')) AS latest_partition, count(*) AS row_count FROM transactions""")
def _(v):
    path = scratch(v.spark, "inventory")
    yearly = v.transactions.withColumn("load_year", F.date_format("processing_date", "yyyy"))
    write_table(yearly, path, "load_year")
    out = recon.inventory({"fact_transaction": v.spark.read.parquet(path)}, "load_year")
    return out.select("table_name", (F.col("file_count") > 0).alias("has_files"), "latest_partition",
                      "row_count")


@query("r09_freshness", """SELECT 'transactions' AS table_name, max(ingestion_timestamp) AS newest,
    CAST(date_diff('second', max(ingestion_timestamp), TIMESTAMP '2024-06-01 12:00:00') AS BIGINT) AS age_seconds,
    max(ingestion_timestamp) >= TIMESTAMP '2024-05-31 12:00:00' AS is_fresh FROM transactions
  UNION ALL SELECT 'events', max(processing_timestamp),
    CAST(date_diff('second', date_trunc('second', max(processing_timestamp)), TIMESTAMP '2024-06-01 12:00:00') AS BIGINT),
    max(processing_timestamp) >= TIMESTAMP '2024-05-31 12:00:00' FROM ev_tagged""")
def _(v):
    return recon.freshness(
        {"transactions": v.transactions, "events": v.events_tagged}, checked_at(), "1 day")


@query("r09_metrics", """SELECT 'transactions' AS dataset_name, 'ReconciliationMismatches' AS metric_name,
  0.0::DOUBLE AS value FROM recon_row""", RESULT)
def _(v):
    return recon.mismatch_metric(_result(v))


