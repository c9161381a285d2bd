"""Expectation suites: declared as data, evaluated in one aggregate pass plus one grouped pass for all
unique columns, whatever the number of expectations. The counts of the aggregate pass can also come
from a write that observes them."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import (
    ACCOUNT_STATUSES, ACCOUNT_TYPES, CANONICAL, CURRENCIES, PAYMENT_STATUSES, TRADE_SIDES,
    TRANSACTION_STATUSES, TRANSACTION_TYPES,
)

COLUMNS, NOT_NULL, UNIQUE, IN_SET, BETWEEN, REGEX = (
    "columns_match_set", "not_null", "unique", "in_set", "between", "matches_regex",
)


def parameter(name: str) -> dict:
    """A bound given at run time."""
    return {"parameter": name}


def _columns(entity: str) -> dict:
    return {"kind": COLUMNS, "columns": CANONICAL[entity].fieldNames()}


def _not_null(column: str, mostly: float = 1.0) -> dict:
    return {"kind": NOT_NULL, "column": column, "mostly": mostly}


def _unique(column: str, mostly: float = 1.0) -> dict:
    return {"kind": UNIQUE, "column": column, "mostly": mostly}


def _in_set(column: str, values: list[str]) -> dict:
    return {"kind": IN_SET, "column": column, "values": values}


def _between(column: str, low, high) -> dict:
    return {"kind": BETWEEN, "column": column, "min": low, "max": high}


def _regex(column: str, pattern: str) -> dict:
    return {"kind": REGEX, "column": column, "pattern": pattern}


# ---- Fixed values: the eight suites -----------------------------------------------------------
EVENT_COLUMNS = [
    "event_id", "event_type", "partition_key", "event_timestamp", "processing_timestamp",
    "currency_code", "transaction_status", "transaction_amount", "risk_score",
]
RECONCILIATION_COLUMNS = [
    "source_row_count", "target_row_count", "row_count_difference", "debit_total", "credit_total",
    "debit_credit_difference", "duplicate_rate", "rejected_rate",
]
SUITES = {
    "accounts_bronze": [
        _columns("accounts"),
        _not_null("account_id"),
        _unique("account_id"),
        _in_set("account_type", ACCOUNT_TYPES),
        _in_set("currency_code", CURRENCIES),
        _in_set("status", ACCOUNT_STATUSES),
    ],
    "customers_bronze": [
        _columns("customers"),
        _not_null("customer_id"),
        _unique("customer_id"),
        _regex("email", r"^[^@\s]+@[^@\s]+\.[^@\s]+$"),
        _between("risk_score", 0, 100),
    ],
    "securities_bronze": [
        _columns("securities"),
        _not_null("security_id"),
        _unique("security_id"),
        _regex("ticker", r"^[A-Z0-9._-]+$"),
        _in_set("currency_code", CURRENCIES),
    ],
    "transactions_bronze": [
        _columns("transactions"),
        _not_null("transaction_id", 0.98),
        _unique("transaction_id", 0.94),
        _in_set("currency_code", CURRENCIES),
        _in_set("transaction_status", TRANSACTION_STATUSES),
        _in_set("transaction_type", TRANSACTION_TYPES),
        _between("transaction_amount", 0, 1000000),
        _between("risk_score", 0, 100),
    ],
    "payments_bronze": [
        _columns("payments"),
        _not_null("payment_id", 0.98),
        _unique("payment_id", 0.94),
        _in_set("currency_code", CURRENCIES),
        _in_set("transaction_status", PAYMENT_STATUSES),
        _between("transaction_amount", 0, 5000000),
        _between("risk_score", 0, 100),
    ],
    "trades_bronze": [
        _columns("trades"),
        _not_null("trade_id", 0.98),
        _unique("trade_id", 0.94),
        _in_set("side", TRADE_SIDES),
        _in_set("currency_code", CURRENCIES),
        _between("transaction_amount", 0, 10000000),
        _between("risk_score", 0, 100),
    ],
    "streaming_events_microbatch": [
        {"kind": COLUMNS, "columns": EVENT_COLUMNS},
        _not_null("event_id", 0.99),
        _unique("event_id", 0.94),
        _in_set("event_type", ["transaction", "payment", "trade"]),
        _in_set("currency_code", CURRENCIES),
        _between("transaction_amount", 0, 10000000),
        _between("risk_score", 0, 100),
    ],
    "gold_load_validation": [
        {"kind": COLUMNS, "columns": RECONCILIATION_COLUMNS},
        _between("row_count_difference", 0, parameter("max_row_count_difference")),
        _between("debit_credit_difference", 0, parameter("max_debit_credit_difference")),
        _between("duplicate_rate", 0, parameter("max_duplicate_rate")),
        _between("rejected_rate", 0, parameter("max_rejected_rate")),
    ],
}
SUITE_BY_DATASET = {
    "customers": "customers_bronze",
    "accounts": "accounts_bronze",
    "transactions": "transactions_bronze",
    "payments": "payments_bronze",
    "trades": "trades_bronze",
    "securities": "securities_bronze",
}
GOLD_THRESHOLDS = {
    "max_row_count_difference": 0,
    "max_debit_credit_difference": 0.01,
    "max_duplicate_rate": 0.05,
    "max_rejected_rate": 0.10,
}
FAILURE_METRIC = "GreatExpectationsFailures"

_RESULT = ["position", "kind", "column_name", "mostly", "tested", "unexpected"]


def suite_columns(suite: str) -> list[str]:
    return SUITES[suite][0]["columns"]


def _bound(value, parameters: dict):
    if isinstance(value, dict):
        name = value["parameter"]
        if name not in parameters:
            raise KeyError(f"suite parameter {name} is not set")
        return parameters[name]
    return value


def _breaks(rule: dict, parameters: dict, c: Column) -> Column:
    """True where a value breaks the rule; null values are not tested."""
    if rule["kind"] == NOT_NULL:
        return c.isNull()
    if rule["kind"] == IN_SET:
        return ~c.isin(rule["values"])
    if rule["kind"] == REGEX:
        return ~c.rlike(rule["pattern"])
    low, high = _bound(rule["min"], parameters), _bound(rule["max"], parameters)
    broken = F.lit(False)
    if low is not None:
        broken = broken | (c < F.lit(low))
    if high is not None:
        broken = broken | (c > F.lit(high))
    return broken


def _rules(suite: str | list[dict]) -> list[dict]:
    return SUITES[suite] if isinstance(suite, str) else suite


def _by_row(rule: dict, present: set[str]) -> bool:
    return rule["kind"] not in (COLUMNS, UNIQUE) and rule["column"] in present


def row_metrics(suite: str | list[dict], columns: list[str], parameters: dict | None = None,
                values: dict[str, Column] | None = None,
                where: Column | None = None) -> list[Column]:
    """Named aggregates that hold the counts of all row rules, to aggregate or to observe.

    ``values`` gives expressions for columns that are stored in another type; rows for which ``where``
    is not true are not looked at.
    """
    looked_at = F.lit(True) if where is None else where
    present, out = set(columns), [F.count_if(looked_at).alias("_rows")]
    for i, rule in enumerate(_rules(suite)):
        if _by_row(rule, present):
            c = (values or {}).get(rule["column"], F.col(rule["column"]))
            bad = _breaks(rule, parameters or {}, c)
            out.append(F.count_if(looked_at & bad).alias(f"_bad{i}"))
            if rule["kind"] != NOT_NULL:
                out.append(F.count_if(looked_at & c.isNotNull()).alias(f"_set{i}"))
    return out


def unique_counts(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """(position, tested, unexpected) per unique column: values, and values that occur again.

    All columns travel in one shuffle: a row sends one record per column, with the value in a field of
    its own type, and equal records of a task are counted before they are sent.
    """
    places = {c: f"_v{n}" for n, c in enumerate(dict.fromkeys(columns.values()))}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    records = [
        F.when(F.col(c).isNotNull(), F.struct(
            F.lit(i).alias("position"),
            *[(F.col(c) if o == c else F.lit(None).cast(kinds[o])).alias(v)
              for o, v in places.items()]))
        for i, c in columns.items()
    ]
    per_value = df.select(F.inline(F.array_compact(F.array(*records)))).groupBy(
        "position", *places.values()).agg(F.count("*").alias("_n"))
    return per_value.groupBy("position").agg(
        F.sum("_n").alias("tested"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("unexpected"))


def evaluate_suite(df: DataFrame, suite: str | list[dict], parameters: dict | None = None,
                   observed: dict | None = None) -> DataFrame:
    """One row per expectation: tested and unexpected counts, observed share and success.

    The row rules of the suite share one aggregate, or take ``observed``, the values of
    :func:`row_metrics` from a write. All unique columns share one count per value.
    """
    rules, present = _rules(suite), set(df.columns)

    def cell(i: int, rule: dict, tested: Column, unexpected: Column) -> Column:
        return F.struct(
            F.lit(i).alias("position"),
            F.lit(rule["kind"]).alias("kind"),
            F.lit(rule.get("column")).cast("string").alias("column_name"),
            F.lit(float(rule.get("mostly", 1.0))).alias("mostly"),
            tested.cast("bigint").alias("tested"),
            unexpected.cast("bigint").alias("unexpected"),
        )

    def metric(name: str) -> Column:
        return F.col(name) if observed is None else F.lit(observed[name])

    cells, uniques = [], {}
    for i, rule in enumerate(rules):
        if rule["kind"] == COLUMNS:
            odd = len(present.symmetric_difference(rule["columns"]))
            cells.append(cell(i, rule, F.lit(len(rule["columns"])), F.lit(odd)))
        elif rule["column"] not in present:
            cells.append(cell(i, rule, F.lit(0), F.lit(1)))
        elif rule["kind"] == UNIQUE:
            uniques[i] = rule["column"]
        else:
            tested = metric("_rows" if rule["kind"] == NOT_NULL else f"_set{i}")
            cells.append(cell(i, rule, tested, metric(f"_bad{i}")))

    one = df.sparkSession.range(1) if observed is not None else df.agg(
        *row_metrics(rules, df.columns, parameters))
    parts = [one.select(F.inline(F.array(*cells)))] if cells else []
    if uniques:
        blank = F.array(*[cell(i, rules[i], F.lit(0), F.lit(0)) for i in uniques])
        # a rule without any value has no counts of its own: the zeros stand in for it
        counts = df.sparkSession.range(1).select(F.inline(blank)).unionByName(
            unique_counts(df, uniques).select(
                "position", F.lit(None).cast("string").alias("kind"),
                F.lit(None).cast("string").alias("column_name"),
                F.lit(None).cast("double").alias("mostly"), "tested", "unexpected"))
        parts.append(counts.groupBy("position").agg(
            *[F.max(c).alias(c) for c in _RESULT[1:]]))
    results = reduce(lambda a, b: a.unionByName(b), parts)
    share = 1 - F.try_divide(F.col("unexpected").cast("double"), F.col("tested"))
    whole = F.col("kind") == COLUMNS
    success = F.when(whole, F.col("unexpected") == 0).otherwise(
        F.when(F.col("tested") == 0, F.col("unexpected") == 0).otherwise(share >= F.col("mostly"))
    )
    return results.select(*_RESULT, success.alias("success"))


def summarize(
    results: DataFrame,
    suite: str,
    dataset: str,
    stage: str,
    run_at: datetime | None = None,
) -> DataFrame:
    """One row per suite run, to append to the results table."""
    run_at = run_at or datetime.now(timezone.utc)
    passed = F.count_if(F.col("success"))
    return results.agg(
        F.count("*").alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
    ).select(
        F.lit(suite).alias("suite_name"),
        "success",
        "evaluated_expectations",
        "successful_expectations",
        (F.col("evaluated_expectations") - F.col("successful_expectations")).alias(
            "unsuccessful_expectations"
        ),
        (F.col("successful_expectations") * 100.0 / F.col("evaluated_expectations")).alias(
            "success_percent"
        ),
        F.lit(f"{suite}-{run_at:%Y%m%dT%H%M%SZ}").alias("run_identifier"),
        F.lit(stage).alias("stage"),
        F.lit(dataset).alias("dataset_name"),
        F.lit(run_at).alias("created_at"),
    )


def failure_metric(summaries: DataFrame) -> DataFrame:
    """One metric row per summary: 1 when the suite failed."""
    return summaries.select(
        F.lit(FAILURE_METRIC).alias("metric_name"),
        "suite_name",
        "dataset_name",
        "stage",
        F.when(F.col("success"), 0).otherwise(1).cast("double").alias("value"),
        F.lit("Count").alias("unit"),
    )


def validate_datasets(frames: dict[str, DataFrame], stage: str, run_at=None) -> DataFrame:
    """Summaries of all datasets that have a suite; the others are passed over."""
    out = None
    for dataset, df in frames.items():
        suite = SUITE_BY_DATASET.get(dataset)
        if suite is None:
            continue
        one = summarize(evaluate_suite(df, suite), suite, dataset, stage, run_at)
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no dataset with a suite")
    return out


class ValidationFailed(RuntimeError):
    pass


def enforce(summary: DataFrame, on_fail: str = "report") -> list:
    """Collect the summaries (one row per suite); ``on_fail='raise'`` stops the load on failure."""
    rows = summary.collect()
    failed = [r.suite_name for r in rows if not r.success]
    if failed and on_fail == "raise":
        raise ValidationFailed("suites failed: " + ", ".join(failed))
    return rows
