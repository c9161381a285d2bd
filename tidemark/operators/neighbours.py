"""Previous or next value in key order, without one task per key.

A plain ``lag`` or ``lead`` sorts each partition key in one task: a key with a third of the rows, or
no key at all, does not scale. Here the order column is cut into value ranges. Each range is a window
of its own, and one extra row per (key, range) carries the value across the border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _as_number(df: DataFrame, column: str) -> Column:
    """A double that never decreases as the column grows; only used to choose a range."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column)).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(column)).cast("double")
    return F.col(column).cast("double")


def range_count(df: DataFrame) -> int:
    """Enough ranges to give every shuffle partition a few."""
    return max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


_GROUPS = 64


def _cuts(measured: DataFrame, order: str, ranges: int) -> Column:
    """About evenly spaced values of the order column, as a scalar subquery: nothing runs before the
    query itself does. Partitions are merged in groups first, so the last merge gets a fixed number
    of small summaries. A struct of blocks of cuts and of each block's last cut, so that finding a
    range among n takes about twice the root of n comparisons."""
    shares = [i / ranges for i in range(1, ranges)]
    values = measured.select(_as_number(measured, order).alias("_value")).filter(
        "_value is not null").withColumn("_group", F.spark_partition_id() % _GROUPS)
    parts = values.groupBy("_group").agg(
        F.percentile_approx("_value", shares, 4 * ranges).alias("_values"))
    cuts = parts.select(F.explode("_values").alias("_value")).agg(
        F.sort_array(F.array_distinct(F.percentile_approx("_value", shares, 4 * ranges))).alias("_cuts"))
    width = _block_width(ranges)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / width).cast("int")),
        lambda i: F.slice("_cuts", i * width + 1, F.lit(width)))
    known = cuts.select(F.when(F.size("_cuts") > 0, blocks).otherwise(
        F.array().cast("array<array<double>>")).alias("blocks"))
    return known.select(F.struct(
        "blocks", F.transform("blocks", lambda b: F.element_at(b, -1)).alias("last"))).scalar()


def _block_width(ranges: int) -> int:
    return max(1, int(ranges ** 0.5))


def _range_of(number: Column, cuts: Column, width: int) -> Column:
    """How many cuts lie below a number."""
    block = F.size(F.filter(cuts["last"], lambda b: b < number))
    part = F.coalesce(F.get(cuts["blocks"], block), F.array().cast("array<double>"))
    return block * width + F.size(F.filter(part, lambda b: b < number))


def with_neighbour(
    df: DataFrame,
    partition_by: list[str],
    order: str,
    direction: str,
    name: str,
    ranges: int | None = None,
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Add the value of ``order`` before (``lag``) or after (``lead``) each row as ``name``.

    ``order`` must be unique within ``partition_by`` (group by it first); a null is nobody's
    neighbour. The border values are at most ``ranges`` per key, so the small window over them is
    bounded. The cut points come from the order column of ``measured_on`` (a frame that is cheap to
    scan, such as the input before grouping); how well they balance affects speed only, not the
    result.
    """
    if direction not in ("lag", "lead"):
        raise ValueError("direction must be 'lag' or 'lead'")
    ranges = ranges or range_count(df)
    measured = measured_on if measured_on is not None else df
    bucket = _range_of(_as_number(df, order), F.col("_cuts"), _block_width(ranges))
    # As a column first: a subquery may not stand inside the functions that search it.
    body = df.withColumn("_cuts", _cuts(measured, order, ranges)).withColumn(
        "_range", bucket).drop("_cuts").withColumn("_border", F.lit(False))

    across = Window.partitionBy(*partition_by).orderBy("_range")
    ahead = direction == "lead"
    # The other columns ride along so that both branches need the same input and share its shuffle.
    others = [c for c in df.columns if c not in {*partition_by, order}]
    edges = body.groupBy(*partition_by, "_range").agg(
        (F.min if ahead else F.max)(order).alias(order), *[F.max(c).alias(c) for c in others]
    )
    carried = (F.lead if ahead else F.lag)(order).over(across)
    border = (
        edges.withColumn(order, carried)
        .filter(F.col(order).isNotNull())
        .withColumn("_border", F.lit(True))
    )
    inside = Window.partitionBy(*partition_by, "_range").orderBy(order)
    return (
        body.unionByName(border)
        .withColumn(name, (F.lead if ahead else F.lag)(order).over(inside))
        .filter(~F.col("_border"))
        .drop("_range", "_border")
    )
