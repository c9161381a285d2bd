"""URL parts. ``parse_url`` is not used: it gives null for addresses without a scheme."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tidemark.functions.scalars import blank_to_null, col


def _without(text: Column, *schemes: str) -> Column:
    return reduce(lambda t, s: F.replace(t, F.lit(s), F.lit("")), schemes, text)


def _part(text: Column, mark: str, position: int) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(position))


def url_host(c: Column | str) -> Column:
    bare = _without(col(c), "android-app://", "http://", "https://")
    return _part(_part(bare, "/", 1), "?", 1)


def url_path(c: Column | str) -> Column:
    bare = _without(col(c), "http://", "https://")
    slash = F.position(F.lit("/"), bare)
    cut = F.when(slash > 0, slash).otherwise(F.position(F.lit("?"), bare) - 1)
    return _part(F.right(bare, F.length(bare) - cut), "?", 1)


def url_parameter(c: Column | str, name: str) -> Column:
    return blank_to_null(_part(_part(col(c), name + "=", 2), "&", 1))
