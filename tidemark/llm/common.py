"""Shared pieces of the text operators: words, staged tables and vectorised word hashes.

A word is a maximal run of characters other than space and U+0009..U+000D. All five characters are
single bytes in UTF-8, so words can be cut on the bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch

SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null or a text without words."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(parts, lambda w: w != "")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def for_python(df: DataFrame) -> DataFrame:
    """Let the Python workers import this package from where the driver has it."""
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "").split(":")
    if root not in known:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, known)])
    return df


def splitmix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    values = splitmix(np.arange(256, dtype=np.uint64))
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {flag: _byte_values(flag) for flag in (False, True)}
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int) -> np.ndarray:
    out = np.empty(_BLOCK + 1, dtype=np.uint64)
    out[0] = 1
    size = 1
    step = base
    while size < out.size:
        n = min(size, out.size - size)
        out[size:size + n] = out[:n] * np.uint64(step)
        size += n
        step = step * step & _MASK
    return out


_POWERS: dict[str, np.ndarray] = {}


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        _POWERS["up"] = _powers(_BASE)
        _POWERS["down"] = _powers(pow(_BASE, -1, 1 << 64))
    return _POWERS["up"], _POWERS["down"]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of the documents ``data[offsets[i]:offsets[i + 1]]``, and the
    index of each document's first word (one entry more than documents)."""
    if data.size == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(offsets.size, dtype=np.int64)
    solid = ~_IS_SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[first] = solid[first]
    end = solid.copy()
    end[:-1] &= ~solid[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = solid[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = False) -> np.ndarray:
    """64-bit hash of each word; ``lower`` folds A-Z."""
    up, down = _power_tables()
    values = _VALUES[lower]
    out = np.empty(starts.size, dtype=np.uint64)
    i = 0
    while i < starts.size:
        at = int(starts[i])
        j = max(int(np.searchsorted(ends, at + _BLOCK, side="right")), i + 1)
        if ends[i] - at > _BLOCK:  # one word longer than a block
            out[i] = _long_word(data[at:int(ends[i])], values, up)
            i += 1
            continue
        stop = int(ends[j - 1])
        sums = np.zeros(stop - at + 1, dtype=np.uint64)
        np.cumsum(values[data[at:stop]] * up[:stop - at], out=sums[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return splitmix(out ^ splitmix((ends - starts).astype(np.uint64)))


def _long_word(data: np.ndarray, values: np.ndarray, up: np.ndarray) -> np.uint64:
    total, scale = 0, 1
    for i in range(0, data.size, _BLOCK):
        part = data[i:i + _BLOCK]
        piece = int(np.sum(values[part] * up[:part.size], dtype=np.uint64))
        total = (total + piece * scale) & _MASK
        scale = scale * int(up[_BLOCK]) & _MASK
    return np.uint64(total)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(
        0, dtype=np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, text: str = "text",
           limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text each (a longer document stays whole)."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.cumsum(np.asarray(
        pc.binary_length(column).fill_null(0).cast(pa.int64())))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        stop = max(int(np.searchsorted(sizes, base + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def repeatable_turn(content: list, turns: int) -> int:
    """One of ``turns`` groups for a packet, chosen by its content: a task that is run again sends the
    same rows to the same groups."""
    values = np.array(content, dtype=np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        mixed = splitmix(np.add.reduce(splitmix(values + np.arange(
            values.size, dtype=np.uint64)), keepdims=True))
    return int(mixed[0] % np.uint64(turns))


def planes(values: np.ndarray) -> bytes:
    """Bytes by significance: the like high bytes of sorted numbers lie together and compress."""
    return values.view(np.uint8).reshape(values.size, values.itemsize).T.tobytes()


def from_planes(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    rows = np.frombuffer(raw, dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


def chain(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values."""
    out = np.full(max(0, values.size - width + 1), width, dtype=np.uint64)
    for i in range(width if out.size else 0):
        out = splitmix(out * np.uint64(3) ^ values[i:i + out.size])
    return out
