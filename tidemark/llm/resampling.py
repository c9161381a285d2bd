"""Importance resampling towards a target distribution, drawn by distributed quickselect.

Features of a text are all runs of one and two consecutive words, hashed to ``BUCKETS`` buckets. One
pass counts the buckets of the corpus, one those of the target texts; the log ratio of the two smoothed
distributions is an array of integer gains, one per bucket. A second pass over the texts looks every
feature up in that array: a document's weight is the floored mean. Gumbel noise, derived from the id,
turns the highest scores into a draw without replacement in proportion to the weights.

The draw is a quickselect over the composite key (score descending, id, the other results, row number).
Each round draws random pivot keys from the open interval, counts all rows below, at and above each
pivot exactly, and goes on in the part that holds the k-th row, until a pivot is that row. No row is
sorted or moved for it. Only the winners are then range-sorted and numbered, in two levels.

Defined cases: a null or wordless text has no features and weight 0; a null id is hashed as the text
``null`` and loses ties; rows that repeat are separate documents, and of equal rows any may be drawn,
which gives the same result; an empty corpus gives an empty result; without target texts all target
counts are 0; other columns are ignored unless named in ``carry``, and lose against results of the
same name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import for_python, pieces, staged, text_bytes

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
PIVOTS = 24
_RESULTS = ("doc_id", "n_features", "weight", "score", "rank")

# a word byte is a digit, a letter or any byte of a character beyond ASCII
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()
_STEPWISE = 64  # longer words are fed to the checksum one by one


def _fed(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the words at ``starts``, all words side by side, byte by byte."""
    state = state.copy()
    at = np.flatnonzero((sizes > 0) & (sizes <= _STEPWISE))
    for i in range(int(sizes[at].max(initial=0))):
        at = at[sizes[at] > i]
        old = state[at]
        state[at] = _CRC[(old ^ data[starts[at] + i]) & np.uint32(255)] ^ (old >> np.uint32(8))
    for j in np.flatnonzero(sizes > _STEPWISE):
        word = data[starts[j]:starts[j] + sizes[j]].tobytes()
        state[j] = ~np.uint32(zlib.crc32(word, int(~state[j])))
    return state


def features(data: np.ndarray, offsets: np.ndarray, buckets: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature of the texts ``data[offsets[i]:offsets[i + 1]]``, the text it belongs
    to, and each text's number of words."""
    solid = np.zeros(data.size + 1, dtype=bool)
    solid[:-1] = _IS_WORD[data]
    begin = solid[:-1].copy()
    begin[1:] &= ~solid[:-2]
    end = solid[:-1] & ~solid[1:]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[first] = solid[first]
    end[last] = solid[last]
    starts = np.flatnonzero(begin)
    sizes = np.flatnonzero(end) + 1 - starts
    owner = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(owner, minlength=offsets.size - 1)
    data = _LOWER[data]
    full = np.full(starts.size, 0xFFFFFFFF, dtype=np.uint32)
    one = _fed(full, data, starts, sizes)
    pair = np.flatnonzero(owner[:-1] == owner[1:])
    space = _CRC[(one[pair] ^ np.uint32(0x20)) & np.uint32(255)] ^ (one[pair] >> np.uint32(8))
    two = _fed(space, data, starts[pair + 1], sizes[pair + 1])
    hashed = ~np.concatenate([one, two])
    return (hashed % np.uint32(buckets)).astype(np.int64), np.concatenate(
        [owner, owner[pair]]), n_words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> dict[int, int]:
    """Features of all texts per bucket. Tasks send one row per bucket they met; the driver gets at
    most ``buckets`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in pieces(batch):
                found, _, _ = features(*text_bytes(part.column(0)), buckets)
                total += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    rows = for_python(texts.select("text")).mapInArrow(count, "bucket long, n long").groupBy(
        "bucket").agg(F.sum("n").alias("n")).collect()
    return {r["bucket"]: r["n"] for r in rows}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """The integer gain of each bucket: thousandths of the log ratio of the smoothed shares."""
    all_s, all_t = sum(corpus.values()), sum(target.values())
    return [math.floor(1000 * math.log(
        float((target.get(b, 0) + 1) * (all_s + buckets))
        / float((corpus.get(b, 0) + 1) * (all_t + buckets)))) for b in range(buckets)]


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def scored(docs: DataFrame, gain: list[int], seed: int = 7, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and the carried columns of every document."""
    table, buckets = np.array(gain, dtype=np.int64), len(gain)
    carry = tuple(c for c in carry if c not in (*_RESULTS, "n_words"))
    source = docs.select("doc_id", F.col("text").alias("_text"), *carry)
    kept = [f for f in source.schema.fields if f.name != "_text"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text"):
                found, owner, n_words = features(*text_bytes(part.column(1)), buckets)
                # whole numbers below 2 ** 53 are exact as doubles
                total = np.bincount(owner, table[found], part.num_rows).astype(np.int64)
                n = np.bincount(owner, minlength=part.num_rows)
                weight = total // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(f.name)) for f in kept]
                    + [pa.array(x.astype(np.int64)) for x in (n_words, n, weight)],
                    [f.name for f in kept] + ["n_words", "n_features", "weight"])

    schema = source.select(*[f.name for f in kept]).schema.add("n_words", "long").add(
        "n_features", "long").add("weight", "long")
    return for_python(source).mapInArrow(weigh, schema).withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed))


# ---- quickselect ---------------------------------------------------------------------------------
def _key(df: DataFrame) -> tuple[Column, list[tuple[str, Column]]]:
    parts = [("a", -F.col("score")), ("b", F.col("doc_id").isNull()), ("c", F.col("doc_id")),
             ("d", F.col("weight")), ("e", F.col("n_features")), ("f", F.col("_row"))]
    return F.struct(*[c.alias(n) for n, c in parts]), parts


def kth_key(rows: DataFrame, key: Column, k: int, total: int, pivots: int = PIVOTS,
            seed: int = 0) -> Column:
    """The k-th smallest of ``total`` unique keys (from 1), as a literal.

    A round draws up to ``pivots`` keys of the open interval by the least hashes, and counts all rows
    of the interval below, at and between them. The driver holds these keys and counts only.
    """
    kind = rows.select(key.alias("k")).schema["k"].dataType
    if not 1 <= k <= total:
        raise ValueError(f"{k} is not a place among {total} rows")

    def literal(row) -> Column:
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, kind.fields, strict=True)])

    low = high = None  # the open interval; rows at or below low are counted in before
    before, step = 0, seed
    while True:
        inside = rows.select(key.alias("k"))
        if low is not None:
            inside = inside.filter(F.col("k") > low)
        if high is not None:
            inside = inside.filter(F.col("k") < high)
        drawn = inside.select("k", F.xxhash64("k", F.lit(step)).alias("h")).orderBy("h", "k").limit(
            pivots).collect()
        marks = [literal(r["k"]) for r in sorted(
            drawn, key=lambda r: [(x is None, x) for x in r["k"]])]
        # part 2 i lies between marks, part 2 i + 1 is a mark
        part = F.aggregate(F.array(*marks), F.lit(0), lambda n, m: n + (
            F.col("k") > m).cast("int") + (F.col("k") >= m).cast("int"))
        counts = dict(inside.groupBy(part.alias("part")).count().collect())
        for i in range(2 * len(marks) + 1):
            if before + counts.get(i, 0) >= k:
                break
            before += counts.get(i, 0)
        if i % 2:
            return marks[i // 2]
        low = marks[i // 2 - 1] if i else low
        high = marks[i // 2] if i // 2 < len(marks) else high
        step += 1


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in a total order: range-sorted parts, each numbered by itself,
    and one count per part."""
    parts = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id()), "resample-ranks")
    part = F.shiftright("_at", 33)  # above is the partition, below the row's place in it
    sizes = parts.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return parts.withColumn("_part", part).join(starts, "_part").withColumn(
        "rank", (F.col("_start") + inside + 1).cast("long")).drop("_part", "_at", "_start")


def draw(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
         pivots: int = PIVOTS) -> DataFrame:
    """``scores`` with the ``rank`` of the drawn rows: of those with enough words, ``percent`` in a
    hundred (rounded down) with the highest scores, ties to the smaller id."""
    table = staged(scores.withColumn("_row", F.monotonically_increasing_id()), "resample-scores")
    key, parts = _key(table)
    able = F.col("n_words") >= min_words
    n = table.filter(able).count()
    k = n * percent // 100
    if k == 0:
        return table.withColumn("rank", F.lit(None).cast("long")).drop("_row")
    wins = able & (key <= kth_key(table.filter(able), key, k, n, pivots))
    losers = table.filter(~wins).withColumn("rank", F.lit(None).cast("long"))
    return ranked(table.filter(wins), [c for _, c in parts]).unionByName(losers).drop("_row")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = 7, buckets: int = BUCKETS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every document with n_features, weight, score and, if drawn, its rank."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), buckets)
    return draw(scored(docs, gain, seed, carry), percent, min_words)


def resample_sql(seed: int = 7, buckets: int = BUCKETS) -> str:
    """The same draw in one SQL statement; the checksum is folded over the bytes of each feature."""
    return rf"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
texts AS (
  SELECT 'd' AS side, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL
  SELECT 't', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  FROM benchmark),
ws AS (
  SELECT side, id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
runs AS (
  SELECT side, id, unnest(w) AS f FROM ws
  UNION ALL
  SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM ws),
grams AS (SELECT DISTINCT f FROM runs),
bytes AS (
  SELECT f, list_transform(range(0, octet_length(encode(f))),
    lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT) AS b FROM grams),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % {buckets} AS bucket
  FROM bytes, crc),
counted AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t
  FROM runs JOIN hashed USING (f) GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::BIGINT AS all_s, coalesce(sum(t), 0)::BIGINT AS all_t
         FROM counted),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + {buckets}))::DOUBLE
    / ((s + 1) * (all_t + {buckets}))::DOUBLE))::BIGINT AS g FROM counted, sums),
per AS (
  SELECT id, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
  FROM runs JOIN hashed USING (f) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scores AS (
  SELECT ws.id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || ws.id),
           1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM ws LEFT JOIN per ON ws.id = per.id WHERE side = 'd'),
drawn AS (
  SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scores
  WHERE n_words >= {MIN_WORDS}
  QUALIFY rank <= ({PERCENT} * count(*) OVER ()) // 100)
SELECT s.id AS doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight,
       score::BIGINT AS score, rank::BIGINT AS rank
FROM scores s LEFT JOIN drawn USING (id)
"""
