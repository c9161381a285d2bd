"""Generic table operators: star, null checks, unions, pivot, unpivot, spines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def star(df: DataFrame, exclude=(), prefix: str = "", suffix: str = "") -> DataFrame:
    skip = {c.lower() for c in exclude}
    return df.select(
        [F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in df.columns if c.lower() not in skip]
    )


def empty_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Empty text becomes null in every text column (or the listed ones)."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = [c for c in text if columns is None or c in columns]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in chosen}) if chosen else df


def reindex(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns in this order; missing ones are null."""
    return df.select(
        [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )


def union_relations(
    relations: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include=(),
    exclude=(),
    source_column: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """Union by name over the superset of columns; a missing column is a null of its type."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    include, exclude = {c.lower() for c in include}, {c.lower() for c in exclude}
    override = column_override or {}

    def kept(name: str) -> bool:
        return name.lower() in include if include else name.lower() not in exclude

    types: dict[str, T.DataType | str] = {}
    for df in relations.values():
        for f in df.schema.fields:
            if kept(f.name):
                types.setdefault(f.name, override.get(f.name, f.dataType))
    if not types:
        raise ValueError("no columns left to union")
    parts = []
    for name, df in relations.items():
        df = df.filter(where) if where else df
        columns = [
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()
        ]
        if source_column:
            columns.insert(0, F.lit(name).alias(source_column))
        parts.append(df.select(columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def relations_by_pattern(
    spark: SparkSession, pattern: str, database: str | None = None, exclude: str | None = None
) -> dict[str, DataFrame]:
    """Catalog tables and views whose name matches a regular expression."""
    names = sorted(t.name for t in spark.catalog.listTables(database))
    chosen = [
        n for n in names
        if re.fullmatch(pattern, n) and not (exclude and re.fullmatch(exclude, n))
    ]
    qualified = {n: f"`{database}`.`{n}`" if database else f"`{n}`" for n in chosen}
    return {n: spark.table(q) for n, q in qualified.items()}


def relations_by_prefix(spark: SparkSession, prefix: str, **kwargs) -> dict[str, DataFrame]:
    return relations_by_pattern(spark, re.escape(prefix) + ".*", **kwargs)


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude=(),
    remove=(),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per kept column and input row. ``exclude`` columns stay as ids, ``remove`` go."""
    skip = {c.lower() for c in [*exclude, *remove]}
    melted = [c for c in df.columns if c.lower() not in skip]
    cast = df.select(*exclude, *[F.col(c).cast(cast_to).alias(c) for c in melted])
    return cast.unpivot(list(exclude), melted, field_name, value_name)


_COMPARE = {
    "=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}
_AGGREGATES = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg}


def slug(name: str) -> str:
    """Lower-case identifier: spaces and dashes become ``_``, other marks go."""
    text = re.sub(r"[ -]+", "_", name.strip().lower())
    text = re.sub(r"[^a-z0-9_]+", "", text)
    return f"_{text}" if text[:1].isdigit() else text


def pivot_columns(
    column: str,
    values: list,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One aggregate per value, for use in ``groupBy(...).agg(*pivot_columns(...))``.

    Unlike ``.pivot`` a value a group never has gives an aggregate of ``else_value``, not null, and
    no pass over the data is spent on finding values.
    """
    out = []
    for value in values:
        match = _COMPARE[cmp](F.col(column), F.lit(value))
        then = then_value if isinstance(then_value, Column) else F.lit(then_value)
        other = else_value if isinstance(else_value, Column) else F.lit(else_value)
        cell = F.when(match, then).otherwise(other)
        if distinct:
            cell = F.sum_distinct(cell) if agg == "sum" else F.count_distinct(cell)
        else:
            cell = _AGGREGATES[agg](cell)
        name = f"{prefix}{value}{suffix}"
        out.append(cell.alias(name if quote_identifiers else slug(name)))
    return out


def column_values(
    df: DataFrame,
    column: str,
    order_by: list[Column] | None = None,
    max_records: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values of a column with their frequency, most frequent first."""
    counted = (df.filter(where) if where else df).groupBy(F.col(column).alias("value")).count()
    ordered = counted.orderBy(*(order_by or [F.desc("count"), F.asc("value")]))
    return ordered.limit(max_records) if max_records is not None else ordered


def pivot_values(df: DataFrame, column: str, limit: int = 1000, **kwargs) -> list:
    """The values of ``column_values`` as a list for ``pivot_columns``.

    They become columns, so their number must be small: more than ``limit`` is an error, never a cut.
    """
    rows = column_values(df, column, **kwargs).select("value").take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values; too many columns to pivot")
    return [r.value for r in rows]


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """1..upper, spread over the cluster."""
    if upper < 1:
        raise ValueError("upper must be at least 1")
    return spark.range(1, upper + 1).select(F.col("id").alias("generated_number"))


_DATEPARTS = {"second", "minute", "hour", "day", "week", "month", "quarter", "year"}


def date_spine(bounds: DataFrame, datepart: str, start: str = "start_date", end: str = "end_date"):
    """One row per date part from ``start`` (included) to ``end`` (excluded).

    ``bounds`` is a frame with the two columns, so both ends may come from data without a collect.
    """
    if datepart not in _DATEPARTS:
        raise ValueError(f"unknown datepart {datepart}")
    name = f"date_{datepart}"
    step = F.expr("interval 3 month" if datepart == "quarter" else f"interval 1 {datepart}")
    points = bounds.select(
        F.explode(F.sequence(F.col(start), F.col(end), step)).alias(name), F.col(end).alias("_end")
    )
    return points.filter(F.col(name) < F.col("_end")).select(name)
