import contextlib
import io
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean

TXN = (
    "transaction_id string, transaction_type string, transaction_amount decimal(18,2), "
    "currency_code string, transaction_status string, risk_score int"
)


def txn(spark, *rows):
    return spark.createDataFrame([(i, t, None if a is None else Decimal(a), c, s, r) for i, t, a, c, s, r in rows], TXN)


@pytest.mark.parametrize(
    "row, reason",
    [
        (("t", "DEBIT", "1", "USD", "POSTED", 5), None),
        (("t", "DEBIT", "0", "USD", "POSTED", 0), None),
        ((None, "DEBIT", "1", "ZZZ", "POSTED", 5), "transaction_id_null"),
        (("t", "DEBIT", "-1", "ZZZ", "POSTED", 5), "invalid_currency"),
        (("t", "DEBIT", "-1", "USD", "BAD", 5), "negative_amount"),
        (("t", "DEBIT", "1", "USD", "BAD", 150), "invalid_status"),
        (("t", "DEBIT", "1", "USD", "POSTED", 150), "validation_failed"),
        (("t", "BAD", "1", "USD", "POSTED", 5), "validation_failed"),
        (("t", "DEBIT", "1", "USD", "POSTED", None), "validation_failed"),
        (("t", "DEBIT", "1", None, "POSTED", 5), "validation_failed"),
        (("t", "DEBIT", None, "USD", "POSTED", 5), "validation_failed"),
        (("t", "DEBIT", "1", "USD", None, 5), "validation_failed"),
    ],
)
def test_rejection_reason(spark, row, reason):
    tagged = clean.tag_dataset(txn(spark, row), "transactions")
    assert tagged.head().rejection_reason == reason
    assert clean.valid_rows(tagged).count() + clean.rejected_rows(tagged).count() == 1


def test_empty_input(spark):
    tagged = clean.tag_dataset(txn(spark), "transactions")
    assert clean.valid_rows(tagged).count() == 0 and clean.rejected_rows(tagged).count() == 0


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "p"), ("b", 1, "q"),
         ("c", 3, "same"), ("c", 3, "same"), (None, 1, "n"), (None, 1, "n"), (None, 2, "m")],
        "k string, at int, v string",
    )
    want = [("a", 2, "z"), ("b", 1, "q"), ("c", 3, "same")]
    assert rows(clean.latest_per_key(df, "k", "at", keep_null_keys=False)) == want
    kept = rows(clean.latest_per_key(df, "k", "at"))
    assert sorted(kept, key=str) == sorted([*want, (None, 1, "n"), (None, 1, "n"), (None, 2, "m")], key=str)


def test_latest_per_key_does_not_depend_on_input_order(spark, rows):
    data = [(f"k{i % 7}", i % 3, f"v{i % 11}") for i in range(500)]
    one = spark.createDataFrame(data, "k string, at int, v string").repartition(5)
    two = spark.createDataFrame(data[::-1], "k string, at int, v string").repartition(3)
    assert rows(clean.latest_per_key(one, "k", "at")) == rows(clean.latest_per_key(two, "k", "at"))


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"))
    out = clean.latest_per_key(df, "k", "at")
    plan = plan_of(out)
    assert plan.index("Exchange") < plan.rindex("partial_max") and plan.count("Exchange") == 1
    assert out.count() == 6666


@pytest.mark.parametrize("keep", [True, False])
def test_latest_per_key_reads_its_input_once(spark, tmp_path, keep):
    path = str(tmp_path / "x")
    spark.createDataFrame([("a", 1, "x"), (None, 2, "y")], "k string, at int, v string").write.parquet(path)
    plan = plan_of(clean.latest_per_key(spark.read.parquet(path), "k", "at", keep_null_keys=keep).filter("k = 'a'"))
    assert plan.count("FileScan") == 1 and "EqualTo(k,a)" in plan


def test_equal_rows_without_a_key_all_stay(spark):
    n = 2 * clean._COPIES + 3
    df = spark.range(n).select(F.lit(None).cast("string").alias("k"), F.lit(1).alias("at"), F.lit("v").alias("v"))
    out = clean.latest_per_key(df.unionByName(df.limit(1).withColumn("v", F.lit("w"))), "k", "at")
    assert {r["v"]: r["count"] for r in out.groupBy("v").count().collect()} == {"v": n, "w": 1}
    assert out.columns == ["k", "at", "v"]


def test_rows_of_keys_only(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert rows(clean.latest_per_key(df, "k", [])) == [("a",), (None,), (None,)]


def test_several_keys_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, 2, 1), (1, 2, 5)], "a int, b int, at int")
    assert rows(clean.latest_per_key(df, ["a", "b"], "at")) == [(1, 2, 5), (1, None, 1), (1, None, 2)]


def test_load_metadata(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(3).write.parquet(path)
    got = clean.with_load_metadata(spark.read.parquet(path), run_at=F.lit("2024-05-06 07:08:09").cast("timestamp"))
    r = got.head()
    assert r.source_file.endswith(".parquet") and str(r.processing_date) == "2024-05-06"
    assert clean.with_load_metadata(spark.range(1), "name").head().source_file == "name"


def test_record_rules(spark):
    df = spark.createDataFrame(
        [("c", "n", "e", "US", 5, None), ("c", "n", "e", "XX", 101, None), ("c", "n", "e", None, None, None)],
        "customer_id string, full_name string, email string, country_code string, risk_score int, created_at timestamp")
    got = [r.broken_rules for r in clean.broken_rules(df, "customers").collect()]
    assert got == [[], ["country_code", "risk_score"], ["country_code", "risk_score"]]


def test_latest_per_key_with_map_columns(spark):
    schema = "k string, at int, m map<string,int>"
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"x": 2}), (None, 1, {"x": 1}), (None, 1, {"x": 2})], schema)
    kept = clean.latest_per_key(df, "k", "at").collect()
    assert len(kept) == 3 and [r.m for r in kept if r.k == "a"] == [{"x": 2}]
