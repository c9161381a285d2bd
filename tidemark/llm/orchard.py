"""Centroid clustering with Orchard's search for the nearest centroid.

Vectors are turned into integers once, so that all distances, sums and means are exact. Before each
round the driver orders, for every centroid, the other centroids by their distance from it. The search
of a vector starts at some centroid and walks along that centroid's list. A centroid met for the first
time is measured and marked; when it is nearer (or as near with a smaller number), the search jumps to
the start of its list. It ends when the next centroid of the list lies strictly beyond twice the
current distance: by the triangle inequality, neither it nor any later one can be nearer or tie. The
vectors of a batch search side by side in numpy, and each starts where the batch's middle vector ended.

A round is one pass over the stored vectors. A task sends one sum per cluster and component; the driver
holds the centroids and these sums only, both bounded by the number of centroids.

Defined cases: vectors that are null, have another length, or a null, NaN or infinite component take no
part, nor do vectors with a scaled component beyond 2 ** 27, whose distances would not fit into a long;
rows that repeat count each; a null id is hashed as the text ``null``; with fewer vectors than wanted
centroids there are as many centroids as vectors; empty clusters keep their centroid; an empty table
gives an empty result; an inertia beyond a long is null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import for_python, staged

CENTROIDS = 8
ROUNDS = 10
DIMENSION = 64
SCALE = 1024
LIMIT = 1 << 27
RESULT = ("cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, "
          "centroid array<int>")
_ROWS = 4_096
_LONG = (1 << 63) - 1


def usable(vector: Column, dimension: int) -> Column:
    inside = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) <= LIMIT), F.lit(False)))
    return F.coalesce((F.size(vector) == dimension) & inside, F.lit(False))


def integers(vectors: DataFrame, dimension: int = DIMENSION, vector: str = "embedding") -> DataFrame:
    """vec_id and the integer components of the vectors that take part."""
    return vectors.filter(usable(F.col(vector), dimension)).select(
        "vec_id", F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int")).alias(
            "point"))


def first_centroids(points: DataFrame, count: int, seed: int) -> np.ndarray:
    """The points whose ids have the least hashes, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = points.select(digest.alias("h"), "point").orderBy("h", "point").limit(count).collect()
    return np.array([r["point"] for r in rows], dtype=np.int64)


@dataclass(frozen=True)
class Lists:
    """For each centroid the other centroids, nearest first, and their squared distances."""
    centroids: np.ndarray
    others: np.ndarray
    apart: np.ndarray

    @staticmethod
    def of(centroids: np.ndarray) -> Lists:
        k = len(centroids)
        others = np.zeros((k, max(k - 1, 0)), dtype=np.int64)
        apart = np.zeros_like(others)
        for c in range(k):
            d = ((centroids - centroids[c]) ** 2).sum(axis=1)
            order = np.lexsort((np.arange(k), d))
            order = order[order != c]
            others[c], apart[c] = order, d[order]
        return Lists(centroids, others, apart)


def search(points: np.ndarray, lists: Lists, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each point's nearest centroid, ties to the smaller number."""
    n, k = len(points), len(lists.centroids)
    now = np.full(n, start, dtype=np.int64)
    best = ((points - lists.centroids[start]) ** 2).sum(axis=1)
    seen = np.zeros((n, k), dtype=bool)
    seen[:, start] = True
    place = np.zeros(n, dtype=np.int64)
    going = np.arange(n)
    while going.size:
        going = going[place[going] < k - 1]
        # a quarter of the squared gap is compared without overflow: gap > 4 best
        gap = lists.apart[now[going], place[going]]
        going = going[gap // 4 + (gap % 4 > 0) <= best[going]]
        there = lists.others[now[going], place[going]]
        place[going] += 1
        fresh = ~seen[going, there]
        row, to = going[fresh], there[fresh]
        seen[row, to] = True
        d = ((points[row] - lists.centroids[to]) ** 2).sum(axis=1)
        nearer = (d < best[row]) | ((d == best[row]) & (to < now[row]))
        row = row[nearer]
        now[row], best[row], place[row] = to[nearer], d[nearer], 0
    return now, best


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int
            ) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            part = batch.slice(i, _ROWS)
            column = part.column(part.schema.get_field_index("point"))
            yield part, np.asarray(column.flatten(), dtype=np.int64).reshape(-1, dimension)


def _searched(batches: Iterator[pa.RecordBatch], lists: Lists
              ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    start = 0
    for part, points in _blocks(batches, lists.centroids.shape[1]):
        start = int(search(points[len(points) // 2:][:1], lists, start)[0][0])
        yield part, points, *search(points, lists, start)


def sums(points: DataFrame, lists: Lists) -> tuple[np.ndarray, list[int], list[int]]:
    """Componentwise sums, counts and summed distances of the clusters (exact whole numbers)."""
    k, dimension = lists.centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimension), dtype=np.int64)
        count, far = [0] * k, [0] * k
        for _, x, cluster, distance in _searched(batches, lists):
            for c in np.unique(cluster):
                own = cluster == c
                total[c] += x[own].sum(axis=0)
                count[c] += int(own.sum())
                far[c] += sum(map(int, distance[own])) if distance.max() > _LONG // _ROWS else int(
                    distance[own].sum())
        if sum(count):
            slots = dimension + 2
            values = [v for c in range(k) for v in (*map(int, total[c]), count[c], far[c])]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(k), slots), pa.int32()),
                pa.array(np.tile(np.arange(slots), k), pa.int32()),
                pa.array([Decimal(v) for v in values], pa.decimal128(28, 0)),
            ], ["cluster", "slot", "value"])

    rows = for_python(points.select("point")).mapInArrow(
        add, "cluster int, slot int, value decimal(28,0)").groupBy("cluster", "slot").agg(
        F.sum("value").alias("value")).collect()
    table = np.zeros((k, dimension + 2), dtype=object)
    for r in rows:
        table[r["cluster"], r["slot"]] = int(r["value"])
    return table[:, :dimension], list(table[:, dimension]), list(table[:, dimension + 1])


def moved(centroids: np.ndarray, total: np.ndarray, count: list[int]) -> np.ndarray:
    """Floored means; empty clusters stay."""
    out = centroids.copy()
    for c, n in enumerate(count):
        if n:
            out[c] = [v // n for v in total[c]]
    return out


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS,
            dimension: int = DIMENSION, seed: int = 3, vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and centroid (integers) of
    every vector that takes part."""
    points = staged(integers(vectors, dimension, vector), "orchard-points")
    now = first_centroids(points, centroids, seed)
    schema = T.StructType([points.schema["vec_id"], *T.StructType.fromDDL(RESULT).fields])
    if not len(now):
        return vectors.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        total, count, _ = sums(points, Lists.of(now))
        now = moved(now, total, count)
    lists = Lists.of(now)
    _, _, far = sums(points, lists)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]

    def held(v: int) -> int | None:
        return v if v <= _LONG else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, at, distance in _searched(batches, lists):
            yield pa.RecordBatch.from_arrays([
                part.column(part.schema.get_field_index("vec_id")),
                pa.array(at, pa.int32()), pa.array(distance, pa.int64()),
                pa.array([held(far[c]) for c in at], pa.int64()),
                pa.array([held(sum(far))] * len(at), pa.int64()),
                pa.array([digests[c] for c in at], pa.string()),
                pa.array([now[c] for c in at], pa.list_(pa.int32())),
            ], schema.names)

    return for_python(points).mapInArrow(assign, schema)


def cluster_sql(centroids: int = CENTROIDS, rounds: int = ROUNDS, dimension: int = DIMENSION,
                seed: int = 3) -> str:
    """The same rounds in one SQL statement that measures every vector against every centroid."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS p
  FROM embeddings
  WHERE len(embedding) = {dimension}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimension}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), p) - 1 AS c, p FROM kept
  QUALIFY c < {centroids})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(p) AS p, min_by(c, d * 1000 + c) AS c, min(d) AS d
  FROM (SELECT k.row, k.vec_id, k.p, m.c,
               list_sum(list_transform(list_zip(k.p, m.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))
               )::BIGINT AS d
        FROM kept k CROSS JOIN c{i} m) GROUP BY row)""")
        if i < rounds:
            steps.append(f"""
m{i} AS MATERIALIZED (
  SELECT c, list(v ORDER BY i) AS p FROM (
    SELECT c, i, (sum(x) - (((sum(x) % count(*)) + count(*)) % count(*)))::BIGINT // count(*) AS v
    FROM (SELECT c, unnest(p) AS x, unnest(range({dimension})) AS i FROM a{i}) GROUP BY c, i)
  GROUP BY c),
c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.p, o.p) AS p FROM c{i} o LEFT JOIN m{i} m ON o.c = m.c)""")
    return f"""
WITH {','.join(steps)}
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m.p, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON a.c = m.c
"""
