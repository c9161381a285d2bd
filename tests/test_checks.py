import collections
import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tidemark.operators import checks
from tidemark.operators.neighbours import with_neighbour


def test_row_tests(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, " "), (None, ""), (9, None)], "n int, s string")
    assert rows(checks.accepted_range(df, "n", 2, 5), "n") == [(1,), (9,)]
    assert rows(checks.accepted_range(df, "n", 1, inclusive=False), "n") == [(1,)]
    assert checks.accepted_range(df, "n").count() == 0
    assert rows(checks.expression_is_true(df, "n < 5"), "n") == [(9,)]
    assert rows(checks.expression_is_true(df, "< 5", "n"), "n") == [(9,)]
    assert checks.not_empty_string(df, "s").count() == 2
    assert checks.not_empty_string(df, "s", trim_whitespace=False).count() == 1
    assert rows(checks.not_null(df, "s"), "n") == [(9,)]


def test_value_tests(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    assert rows(checks.unique(df, "v")) == [("a", 2)]
    assert rows(checks.accepted_values(df, "v", ["a"])) == [("b", 1)]
    assert rows(checks.not_accepted_values(df, "v", ["a", "z"])) == [("a",)]
    assert rows(checks.unique_combination(df, ["v"])) == [("a",), (None,)]


def test_two_tables(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert rows(checks.relationships(a, "x", b.filter("x = 2"), "x")) == [(1,), (1,)]
    assert rows(checks.relationships(a, "x", b, "x", to_condition="x > 1", from_condition="x < 2")) == [(1,), (1,)]
    assert rows(checks.cardinality_equality(a, "x", b, "x")) == [(1, 1), (1, 2)]
    assert rows(checks.equality(a, b)) == []
    c = spark.createDataFrame([(1, 1.004), (2, None)], "k int, v double")
    d = spark.createDataFrame([(1, 1.001), (3, None)], "k int, v double")
    assert checks.equality(c, d).count() == 4
    assert rows(checks.equality(c, d, precision=2), "which_diff", "k") == [("a_minus_b", 2), ("b_minus_a", 3)]
    assert rows(checks.equality(c, d, ["k"])) == [("a_minus_b", 2), ("b_minus_a", 3)]
    with pytest.raises(ValueError):
        checks.equality(c, a)


def test_row_counts(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "g string")
    b = spark.createDataFrame([("x",), ("z",), (None,)], "g string")
    assert rows(checks.equal_rowcount(a, b)) == [(4, 3, 1)]
    grouped = rows(checks.equal_rowcount(a, b, ["g"]))
    assert ("x", "x", 2, 1, 1) in grouped and sum(r[4] or 0 for r in grouped) == 1 and len(grouped) == 5
    assert rows(checks.fewer_rows_than(a, b), "row_count_delta") == [(1,)]
    assert rows(checks.fewer_rows_than(b, b), "row_count_delta") == [(1,)]
    assert rows(checks.fewer_rows_than(b, a), "row_count_delta") == [(0,)]
    assert rows(checks.equal_rowcount(a.limit(0), b), "count_a", "diff_count") == [(0, 3)]


def test_group_tests(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 1), ("c", 2), ("d", 5), ("d", None)], "g string, v int")
    assert rows(checks.at_least_one(df, "v", ["g"])) == [("b", 0)]
    assert rows(checks.at_least_one(df, "v")) == []
    assert rows(checks.at_least_one(df.filter("g = 'b'"), "v")) == [(0,)]
    assert rows(checks.not_constant(df, "v", ["g"])) == [("a", 1), ("d", 1)]
    assert rows(checks.not_null_proportion(df, "v", 0.5, group_by=["g"])) == [("b", 0.0)]
    assert rows(checks.not_null_proportion(df, "v", 0.0, 0.9, ["g"]), "g") == [("a",), ("c",)]


def test_recency(spark, rows):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 10)), ("b", dt.datetime(2024, 1, 2, 9))], "g string, t timestamp")
    now = F.lit("2024-01-02 10:00:00").cast("timestamp")
    assert rows(checks.recency(df, "t", "hour", 23, group_by=["g"], as_of=now), "g") == [("a",)]
    assert rows(checks.recency(df, "t", "day", 1, group_by=["g"], as_of=now), "g") == []
    assert rows(checks.recency(df, "t", "day", 0, ignore_time=True, group_by=["g"], as_of=now), "g") == [("a",)]


def test_sequential_values(spark, rows):
    df = spark.createDataFrame([("a", 0), ("a", 2), ("a", 4), ("b", 1), ("b", 5), ("b", 5), ("b", None)], "g string, n int")
    assert rows(checks.sequential_values(df, "n", 2, group_by=["g"])) == [("b", 5, 1, 1), ("b", 5, 5, 1)]
    assert rows(checks.sequential_values(df.filter("g = 'a'"), "n", 2)) == []


RANGES = {
    "no_gaps": [(1, 0, 2), (1, 2, 4), (2, 0, 2), (2, 2, None)],
    "with_gaps": [(1, 0, 2), (1, 3, 4)],
    "overlap": [(1, 0, 3), (1, 2, 4)],
    "zero": [(1, 0, 2), (1, 2, 2), (1, 2, 4)],
    "copies": [(1, 0, 2), (1, 0, 2), (1, 5, 6)],
    "null_lower": [(1, None, 2), (1, 0, 2), (1, None, None), (1, 3, 5)],
}


def brute_ranges(data, gaps, zero):
    """Row-by-row statement of the rule, ordered by (lower, upper), nulls last."""
    big = float("inf")
    ok = {"allowed": lambda u, n: u <= n, "not_allowed": lambda u, n: u == n, "required": lambda u, n: u < n}[gaps]
    failing = collections.Counter()
    for g in {r[0] for r in data}:
        part = sorted([r for r in data if r[0] == g], key=lambda r: (big if r[1] is None else r[1], big if r[2] is None else r[2]))
        for i, (_, lo, hi) in enumerate(part):
            following = part[i + 1][1] if i + 1 < len(part) else None
            bounded = lo is not None and hi is not None and (lo <= hi if zero else lo < hi)
            known = lo is not None and i == max((j for j, r in enumerate(part) if r[1] is not None), default=-1)
            follows = ok(hi, following) if hi is not None and following is not None else known
            if not (bounded and follows):
                failing[(g, lo, hi)] += 1
    return failing


def found_ranges(df, gaps, zero):
    out = collections.Counter()
    for r in checks.mutually_exclusive_ranges(df, "lo", "hi", ["g"], gaps, zero).collect():
        out[(r.g, r.lower_bound, r.upper_bound)] += r.failing_rows
    return out


@pytest.mark.parametrize("name", RANGES)
@pytest.mark.parametrize("gaps", ["allowed", "not_allowed", "required"])
@pytest.mark.parametrize("zero", [False, True])
def test_ranges(spark, name, gaps, zero):
    df = spark.createDataFrame(RANGES[name], "g int, lo int, hi int")
    assert found_ranges(df, gaps, zero) == brute_ranges(RANGES[name], gaps, zero)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=14),
       st.sampled_from(["allowed", "not_allowed", "required"]), st.booleans())
def test_ranges_random(spark, data, gaps, zero):
    df = spark.createDataFrame(data, "g int, lo int, hi int")
    assert found_ranges(df, gaps, zero) == brute_ranges(data, gaps, zero)


@pytest.mark.parametrize("direction", ["lag", "lead"])
@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("ranges", [16, 4096])
def test_neighbour_equals_window(spark, rows, direction, groups, ranges):
    """A hot group, a tiny group and a null group against the plain window."""
    rng = random.Random(5)
    data = {("hot", rng.randrange(10_000)) for _ in range(3000)} | {("b", 1), ("b", 9000), (None, 3), (None, 4)}
    if not groups:
        data = {("x", n) for _, n in data}
    df = spark.createDataFrame(sorted(data, key=str), "g string, n long")
    w = Window.partitionBy(*groups).orderBy("n")
    want = df.withColumn("m", (F.lead if direction == "lead" else F.lag)("n").over(w))
    assert rows(with_neighbour(df, groups, "n", direction, "m", ranges=ranges)) == rows(want)


def test_neighbour_of_dates(spark, rows):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i * i),) for i in range(40)]
    df = spark.createDataFrame(days, "d date")
    got = {r.d: r.m for r in with_neighbour(df, [], "d", "lead", "m", ranges=8).collect()}
    assert got == {a[0]: b[0] for a, b in zip(days, days[1:])} | {days[-1][0]: None}
    assert with_neighbour(df.limit(0), [], "d", "lead", "m").count() == 0
