"""Marts that the stream keeps up to date: mergeable partial aggregates, folded in batch by batch.

A mart is stored as sums, counts and greatest values per key. An update takes the batches that it has
not folded yet, aggregates their rows only, and merges the result into the buckets of the keys that
came. The list of folded batches is a side part of the same table: state and list switch together, so
an update that fails or runs twice counts nothing twice. Old events are not read again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import safe_divide
from tidemark.schemas import MONEY
from tidemark.sinks.versions import KeyedTable
from tidemark.streaming.jobs import StreamPaths
from tidemark.streaming.store import REJECTED, EventStore
from tidemark.streaming import events as ev

SUM, MAX = "sum", "max"
BUCKETS = 16
LEDGER = "batch_key string"
KEY = "mart_key"


@dataclass(frozen=True)
class Partial:
    """A column of the state: how rows make it, and how two states merge."""
    rows: Callable[[], Column]
    merge: str


@dataclass(frozen=True)
class Mart:
    name: str
    keys: dict[str, Callable[[], Column]]
    partials: dict[str, Partial]
    result: dict[str, Callable[[], Column]]
    routes: tuple[str, ...] = ("trades",)


def _count(condition: Callable[[], Column] | None = None) -> Partial:
    return Partial(lambda: F.count_if(condition()) if condition else F.count("*"), SUM)


def _sum(value: Callable[[], Column]) -> Partial:
    return Partial(lambda: F.sum(value()), SUM)


def _set(column: str) -> Partial:
    return Partial(lambda: F.count(column), SUM)


def _greatest(column: str) -> Partial:
    return Partial(lambda: F.max(column), MAX)


def _column(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _columns(*names: str) -> dict[str, Callable[[], Column]]:
    return {n: _column(n) for n in names}


def _money(name: str) -> Callable[[], Column]:
    return lambda: F.col(name).cast(MONEY)


def _mean(total: str, count: str, kind: str) -> Callable[[], Column]:
    return lambda: F.try_divide(F.col(total), F.col(count)).cast(kind)


def _signed_quantity() -> Column:
    return F.when(F.col("side") == "BUY", F.col("quantity")).otherwise(-F.col("quantity"))


def _accepted() -> Column:
    return F.col("rejection_reason").isNull()


MARTS = {m.name: m for m in (
    Mart(
        "stream_trade_performance",
        _columns("processing_date", "security_id", "currency_code", "side")
        | {"trade_date": lambda: F.to_date("event_timestamp")},
        {"amount": _sum(_column("transaction_amount")), "quantity": _sum(_column("quantity")),
         "trades": _count(), "price": _sum(_column("price")), "prices": _set("price"),
         "risk": _sum(lambda: F.col("risk_score").cast("double")), "risks": _set("risk_score")},
        {"total_notional_amount": _money("amount"), "total_quantity": _money("quantity"),
         "trade_count": _column("trades"), "avg_trade_price": _mean("price", "prices", MONEY),
         "avg_risk_score": _mean("risk", "risks", "double")},
    ),
    Mart(
        "trade_minute_metrics",
        _columns("security_id", "currency_code", "side", "processing_date")
        | {"trade_minute": lambda: F.date_trunc("minute", "event_timestamp")},
        {"trades": _count(), "quantity": _sum(_column("quantity")),
         "amount": _sum(_column("transaction_amount")), "price": _sum(_column("price")),
         "prices": _set("price"), "risk": _greatest("risk_score")},
        {"trade_count": _column("trades"), "total_quantity": _money("quantity"),
         "total_transaction_amount": _money("amount"),
         "avg_trade_price": _mean("price", "prices", MONEY), "max_risk_score": _column("risk")},
    ),
    Mart(
        "customer_trade_exposure",
        _columns("customer_id", "account_id", "security_id", "currency_code", "processing_date"),
        {"buys": _count(lambda: F.col("side") == "BUY"), "sells": _count(lambda: F.col("side") == "SELL"),
         "quantity": _sum(_signed_quantity), "amount": _sum(_column("transaction_amount")),
         "risk": _sum(lambda: F.col("risk_score").cast("double")), "risks": _set("risk_score"),
         "latest": _greatest("event_timestamp")},
        {"buy_trade_count": _column("buys"), "sell_trade_count": _column("sells"),
         "net_quantity": _money("quantity"), "gross_notional_amount": _money("amount"),
         "avg_risk_score": _mean("risk", "risks", "double"),
         "latest_event_timestamp": _column("latest")},
    ),
    Mart(
        "stream_reconciliation",
        _columns("processing_date"),
        {"accepted": _count(_accepted),
         "amount": _sum(lambda: F.when(_accepted(), F.col("transaction_amount"))),
         "refused": _count(lambda: ~_accepted())},
        {"accepted_trade_count": _column("accepted"), "accepted_notional_amount": _money("amount"),
         "rejected_event_count": _column("refused"),
         "rejection_ratio": lambda: safe_divide(
             F.col("refused").cast("double"), F.col("accepted") + F.col("refused"))},
        ("trades", REJECTED),
    ),
)}


def _table(spark: SparkSession, paths: StreamPaths, mart: Mart, buckets: int) -> KeyedTable:
    return KeyedTable(spark, paths.at("gold_state", mart.name), KEY, buckets)


def _merged(df: DataFrame, mart: Mart, aggregates: dict[str, Column]) -> DataFrame:
    return df.groupBy(KEY, *mart.keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def _events(store: EventStore, mart: Mart, batches: list[str]) -> DataFrame:
    """Rows of the mart's routes; those of a dataset as they are in its table."""
    out = None
    for route in mart.routes:
        rows = store.rows(route, batches)
        if route != REJECTED:
            rows = ev.route(rows, "trade", ["rejection_reason"])
        else:  # counted only
            rows = rows.withColumn("transaction_amount", F.lit(None).cast(MONEY))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def update_mart(spark: SparkSession, paths: StreamPaths, mart: Mart, buckets: int = BUCKETS) -> int:
    """Fold the batches that came since the last update; returns how many there were."""
    store, table = EventStore(spark, paths.root), _table(spark, paths, mart, buckets)
    base = table.latest()
    new = store.batches().join(table.read_side("ledger-", LEDGER, base), "batch_key", "left_anti")
    batches = [r["batch_key"] for r in new.collect()]
    if not batches:
        return 0
    keyed = _events(store, mart, batches).withColumns(
        {n: c() for n, c in mart.keys.items()})
    # a key may hold nulls: its text does not
    keyed = keyed.withColumn(KEY, F.to_json(F.struct(*mart.keys), {"ignoreNullFields": "false"}))
    partials = _merged(keyed, mart, {n: p.rows() for n, p in mart.partials.items()})
    folder = table.put(partials, "partials")
    landing = spark.read.schema(partials.schema).parquet(f"{table.path}/{folder}")
    how = {n: F.sum(n) if p.merge == SUM else F.max(n) for n, p in mart.partials.items()}
    kinds = {f.name: f.dataType for f in (base.schema if base else partials.schema)}

    def merge(stored: DataFrame, part: DataFrame) -> DataFrame:
        out = _merged(stored.unionByName(part.select(*stored.columns)), mart, how)
        return out.select(*[F.col(c).cast(kinds[c]).alias(c) for c in stored.columns])

    side = table.put(spark.createDataFrame([(b,) for b in batches], LEDGER).coalesce(1), "ledger")
    table.change(landing, merge, base=base,
                 side={f"ledger-{(base.number if base else 0) + 1}": side})
    return len(batches)


def update_marts(spark: SparkSession, paths: StreamPaths, buckets: int = BUCKETS) -> dict[str, int]:
    """Fold new batches into all marts; call it after each batch or on a schedule of its own."""
    return {name: update_mart(spark, paths, mart, buckets) for name, mart in MARTS.items()}


def read_mart(spark: SparkSession, paths: StreamPaths, name: str, buckets: int = BUCKETS) -> DataFrame:
    """The mart in its own columns."""
    mart = MARTS[name]
    state = _table(spark, paths, mart, buckets).read()
    return state.select(*mart.keys, *[c().alias(n) for n, c in mart.result.items()])
