import datetime as dt

import pytest

from tidemark.operators import reshape


def test_pivot_golden(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    got = df.groupBy("size").agg(*reshape.pivot_columns("color", ["red", "blue", "blue's"]))
    assert got.columns == ["size", "red", "blue", "blue's"]
    assert rows(got) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    plain = reshape.pivot_columns("color", ["Blue's 1"], quote_identifiers=False)
    assert df.groupBy("size").agg(*plain).columns[1] == "blues_1"


def test_pivot_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    assert reshape.pivot_values(df, "v") == ["b", "a"]
    assert [r.value for r in reshape.column_values(df, "v", max_records=1).collect()] == ["b"]
    with pytest.raises(ValueError):
        reshape.pivot_values(df, "v", limit=1)


def test_unpivot(spark, rows):
    df = spark.createDataFrame([(1, True, "x", 9)], "id int, flag boolean, s string, gone int")
    got = reshape.unpivot(df, exclude=["id"], remove=["GONE"], field_name="prop", value_name="val")
    assert rows(got) == [(1, "flag", "true"), (1, "s", "x")]


def test_union_relations(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, 5)], "id int, fav int")
    got = reshape.union_relations({"a": a, "b": b}, source_column="src")
    assert got.columns == ["src", "id", "name", "fav"]
    assert rows(got) == [("a", 1, "x", None), ("b", 2, None, 5)]
    assert reshape.union_relations({"a": a, "b": b}, {"id": "string"}, include=["ID"], source_column=None).dtypes == [("id", "string")]
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, exclude=["id", "name"])


def test_date_spine_end_is_excluded(spark, rows):
    def spine(part, lo, hi, kind="date"):
        df = spark.createDataFrame([(lo, hi)], f"start_date {kind}, end_date {kind}")
        return [r[0] for r in rows(reshape.date_spine(df, part))]

    days = spine("day", dt.date(2018, 1, 1), dt.date(2018, 1, 10))
    assert days[0] == dt.date(2018, 1, 1) and days[-1] == dt.date(2018, 1, 9) and len(days) == 9
    assert spine("month", dt.date(2018, 1, 1), dt.date(2018, 3, 1)) == [dt.date(2018, 1, 1), dt.date(2018, 2, 1)]
    assert len(spine("hour", dt.datetime(2018, 1, 1), dt.datetime(2018, 1, 2), "timestamp")) == 24
    assert spine("quarter", dt.date(2018, 1, 1), dt.date(2018, 8, 1))[-1] == dt.date(2018, 7, 1)
    with pytest.raises(ValueError):
        spine("eon", dt.date(2018, 1, 1), dt.date(2018, 1, 2))


def test_series_star_nulls_reindex(spark, rows):
    assert [r[0] for r in rows(reshape.generate_series(spark, 3))] == [1, 2, 3]
    df = spark.createDataFrame([("", "x", 1)], "a string, b string, n int")
    assert reshape.star(df, ["A"], "p_", "_s").columns == ["p_b_s", "p_n_s"]
    assert reshape.empty_to_null(df).head().a is None and reshape.empty_to_null(df, ["b"]).head().a == ""
    assert rows(reshape.reindex(df, ["n", "zz", "a"])) == [(1, None, "")]


def test_relations_by_prefix(spark):
    for name in ("tp_one", "tp_two", "other_three"):
        spark.range(1).createOrReplaceTempView(name)
    assert list(reshape.relations_by_prefix(spark, "tp_")) == ["tp_one", "tp_two"]
    assert list(reshape.relations_by_pattern(spark, "tp_.*", exclude=".*two")) == ["tp_one"]
