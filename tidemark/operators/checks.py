"""Table tests. Each returns the failing rows; an empty result is a pass.

Tests on single rows are filters that push down to the scan. Tests on values or groups aggregate
first (partial aggregation takes the weight out of hot values) and report a value once with its
number of failing rows where listing every copy would only repeat it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.neighbours import with_neighbour


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- single rows -------------------------------------------------------------------------------
def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_range(
    df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    c, broken = F.col(column), F.lit(False)
    if min_value is not None:
        low = _col(min_value) if isinstance(min_value, Column) else F.lit(min_value)
        broken = broken | (c < low if inclusive else c <= low)
    if max_value is not None:
        high = _col(max_value) if isinstance(max_value, Column) else F.lit(max_value)
        broken = broken | (c > high if inclusive else c >= high)
    return df.filter(broken)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    return df.filter(f"not ({column + ' ' if column else ''}{expression})")


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    c = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.select(c.alias(column)).filter(F.col(column) == "")


def imbalance_over(df: DataFrame, limit: float = 0.75) -> DataFrame:
    """Reconciliation rows whose net flow imbalance ratio is over the tolerance."""
    return df.filter(F.coalesce(F.col("net_flow_imbalance_ratio"), F.lit(0)) > limit)


def negative_amounts(df: DataFrame, column: str = "transaction_amount") -> DataFrame:
    return df.filter(F.col(column) < 0)


# ---- values ------------------------------------------------------------------------------------
def unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1").select(
        *columns
    )


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))
    return counted.filter(~F.col("value_field").isin(values))


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.select(F.col(column).alias("value_field")).distinct().filter(
        F.col("value_field").isin(values)
    )


# ---- two tables --------------------------------------------------------------------------------
def relationships(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str = "true",
    to_condition: str = "true",
) -> DataFrame:
    """Rows whose value has no match in the other table.

    Spark broadcasts the other side when its size allows; beyond that it is a sort-merge anti join,
    where adaptive execution splits a hot value of the large side over several tasks.
    """
    left = df.filter(from_condition).filter(F.col(column).isNotNull()).select(
        F.col(column).alias("id")
    )
    right = to.filter(to_condition).filter(F.col(field).isNotNull()).select(
        F.col(field).alias("id")
    )
    return left.join(right, "id", "left_anti")


def _tagged_counts(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per distinct value on either side: one union, one shuffle, nulls compare equal."""
    both = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        b.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    )
    return both.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose row count differs between two columns: (value, num_rows) of each side."""
    counts = _tagged_counts(
        df.select(F.col(column).alias("value")), to.select(F.col(field).alias("value")), ["value"]
    )
    return (
        counts.filter("_a <> _b")
        .select("value", F.explode(F.array("_a", "_b")).alias("num_rows"))
        .filter("num_rows > 0")
    )


def equality(
    df: DataFrame,
    compare: DataFrame,
    compare_columns: list[str] | None = None,
    exclude_columns=(),
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows found on one side only, tagged a_minus_b or b_minus_a.

    Same result as two EXCEPTs, in one shuffle instead of two joins, and copies of a row collapse
    before the shuffle.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    skip = {c.lower() for c in exclude_columns}
    if not compare_columns:
        ours = [c for c in df.columns if c.lower() not in skip]
        theirs = [c for c in compare.columns if c.lower() not in skip]
        if {c.lower() for c in ours} != {c.lower() for c in theirs}:
            raise ValueError("the tables have different columns")
        compare_columns = ours

    def shaped(frame: DataFrame) -> DataFrame:
        out = []
        for c in compare_columns:
            fractional = isinstance(frame.schema[c].dataType, T.FractionalType)
            value = F.col(c)
            if precision is not None and fractional:
                value = F.round(value.cast("decimal(28,6)"), precision)
            out.append(value.alias(c))
        return frame.select(out)

    counts = _tagged_counts(shaped(df), shaped(compare), compare_columns)
    side = F.when(F.col("_b") == 0, "a_minus_b").when(F.col("_a") == 0, "b_minus_a")
    return (
        counts.withColumn("which_diff", side)
        .filter(F.col("which_diff").isNotNull())
        .select("which_diff", *compare_columns)
    )


def _group_counts(df: DataFrame, compare: DataFrame, groups: list[str], a: str, b: str) -> DataFrame:
    if not groups:
        # Two one-row counts meet in one aggregate instead of a join without a key.
        left = df.agg(F.count("*").alias(a)).withColumn(b, F.lit(None).cast("bigint"))
        right = compare.agg(F.count("*").alias(b)).withColumn(a, F.lit(None).cast("bigint"))
        return left.unionByName(right).agg(F.max(a).alias(a), F.max(b).alias(b))
    left = df.groupBy(*[F.col(c).alias(f"{c}_a") for c in groups]).agg(F.count("*").alias(a))
    right = compare.groupBy(*[F.col(c).alias(f"{c}_b") for c in groups]).agg(F.count("*").alias(b))
    on = reduce(lambda x, y: x & y, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in groups])
    keys = [f"{c}_{side}" for c in groups for side in "ab"]
    return left.join(right, on, "full").select(*keys, a, b)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: list[str] = ()) -> DataFrame:
    """Counts per group with diff_count; the test fails on the sum of non-null differences."""
    counts = _group_counts(df, compare, list(group_by), "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: list[str] = ()) -> DataFrame:
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    counts = _group_counts(
        df, compare, list(group_by), "count_our_model", "count_comparison_model"
    )
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return counts.withColumn("row_count_delta", delta.cast("bigint"))


# ---- groups ------------------------------------------------------------------------------------
def at_least_one(df: DataFrame, column: str, group_by: list[str] = ()) -> DataFrame:
    """Groups (or the table) in which every value of the column is null."""
    seen = F.count(F.col(column)).alias("filler_column")
    if not group_by:
        # The probe stops at the first non-null value instead of counting them all.
        df = df.select(column).filter(F.col(column).isNotNull()).limit(1)
    return df.groupBy(*group_by).agg(seen).filter("filler_column = 0")


def not_constant(df: DataFrame, column: str, group_by: list[str] = ()) -> DataFrame:
    """Groups with one distinct value. Two values decide it, so min and max are enough."""
    low, high = F.min(column).alias("_low"), F.max(column).alias("_high")
    return (
        df.groupBy(*group_by)
        .agg(low, high)
        .filter("_low = _high")
        .select(*group_by, F.lit(1).cast("bigint").alias("filler_column"))
    )


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: list[str] = ()
) -> DataFrame:
    share = (F.count(F.col(column)) / F.count("*")).alias("not_null_proportion")
    proportion = F.col("not_null_proportion")
    return df.groupBy(*group_by).agg(share).filter((proportion < at_least) | (proportion > at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    ignore_time: bool = False,
    group_by: list[str] = (),
    as_of: Column | None = None,
) -> DataFrame:
    """Groups whose newest value is older than ``interval`` date parts before ``as_of`` (now)."""
    kind = "date" if ignore_time else df.schema[field].dataType.simpleString()
    now = as_of if as_of is not None else F.current_timestamp()
    threshold = (now - F.expr(f"interval {int(interval)} {datepart}")).cast(kind)
    newest = F.max(field).cast(kind).alias("most_recent")
    return (
        df.groupBy(*group_by)
        .agg(newest)
        .withColumn("threshold", threshold)
        .filter("most_recent < threshold")
    )


# ---- ordered values ----------------------------------------------------------------------------
def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: list[str] = (),
) -> DataFrame:
    """Values that are not their predecessor plus the interval, with the number of such rows."""
    groups = list(group_by)
    step = F.expr(f"interval {int(interval)} {datepart}") if datepart else F.lit(interval)
    distinct = (
        df.filter(F.col(column).isNotNull()).groupBy(*groups, column).agg(F.count("*").alias("_n"))
    )
    value, before = F.col(column), F.col("_before")
    # The first copy of a value follows the value before it; the other copies follow the value itself.
    cases = F.array(
        F.struct(before.alias("previous_value"), F.lit(1).cast("bigint").alias("failing_rows")),
        F.struct(value.alias("previous_value"), (F.col("_n") - 1).alias("failing_rows")),
    )
    return (
        with_neighbour(distinct, groups, column, "lag", "_before", measured_on=df)
        .select(*groups, column, F.inline(cases))
        .filter("failing_rows > 0")
        .filter(value != F.col("previous_value") + step)
    )


_GAPS = {
    "not_allowed": lambda upper, following: upper == following,
    "allowed": lambda upper, following: upper <= following,
    "required": lambda upper, following: upper < following,
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: list[str] = (),
    gaps: str = "allowed",
    zero_length_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty, overlap the next one or leave a gap the rule forbids.

    Copies of a range collapse to one row with a count. Within ranges of equal start only the one
    that ends last looks at the next start, all others at their own start, so the ordered step runs
    over distinct starts alone.
    """
    if gaps not in _GAPS:
        raise ValueError(f"gaps must be one of {sorted(_GAPS)}")
    groups = list(partition_by)
    ranges = df.groupBy(
        *groups, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound")
    ).agg(F.count("*").alias("_n"))
    starts = ranges.groupBy(*groups, "lower_bound").agg(
        F.max("upper_bound").alias("_last_upper"),
        F.max(F.col("upper_bound").isNull()).alias("_open_end"),
    )
    column = df.select(F.col(lower).alias("lower_bound"))
    starts = with_neighbour(
        starts, groups, "lower_bound", "lead", "_next", measured_on=column
    )
    on = [F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}")) for g in groups]
    on.append(F.col("r.lower_bound") == F.col("s.lower_bound"))
    high, last = F.col("r.upper_bound"), F.col("_last_upper")
    ends_last = ((high == last) & ~F.col("_open_end")) | (high.isNull() & F.col("_open_end"))
    joined = (
        ranges.alias("r")
        .join(starts.alias("s"), reduce(lambda a, b: a & b, on), "left")
        .select(
            "r.*", "_next", F.coalesce(ends_last, F.lit(False)).cast("bigint").alias("_last")
        )
    )
    low, high = F.col("lower_bound"), F.col("upper_bound")
    bounded = F.coalesce(low <= high if zero_length_allowed else low < high, F.lit(False))
    rule = _GAPS[gaps]
    cases = F.array(
        F.struct(
            F.col("_next").alias("next_lower_bound"),
            F.col("_last").alias("failing_rows"),
            F.coalesce(rule(high, F.col("_next")), F.col("_next").isNull()).alias("_follows"),
        ),
        F.struct(
            low.alias("next_lower_bound"),
            (F.col("_n") - F.col("_last")).alias("failing_rows"),
            F.coalesce(rule(high, low), F.lit(False)).alias("_follows"),
        ),
    )
    return (
        joined.withColumn("_bounded", bounded)
        .select(*groups, "lower_bound", "upper_bound", "_bounded", F.inline(cases))
        .filter((F.col("failing_rows") > 0) & ~(F.col("_bounded") & F.col("_follows")))
        .drop("_bounded", "_follows")
    )
