"""Approximate nearest neighbours by a hierarchical navigable small-world graph per shard.

Equal vectors are one node that keeps its least ids, as many as any result can show. Nodes are dealt
to shards by a hash of the vector; a shard's size is bounded, so there are more shards, not larger
ones, when the table grows. Each shard draws a level for every node, links every node on each of its
levels to diverse near nodes (a candidate is linked when it is nearer to the node than to those linked
before it), adds the reverse links, and stores the levels as flat arrays of neighbours. A search
descends greedily to the lowest level and explores it with a bounded list of the nearest nodes found.
Every query is sent to all shards of its dimension, in blocks, and the shards' results are merged by
exact distance in double precision.

Defined cases: rows with a null id, a null, empty or zero vector, or with null, NaN or infinite
components take no part; rows that repeat count once; rows that share an id are not neighbours of each
other; vectors of different lengths never meet; an empty table or no query gives an empty result; with
fewer candidates than wanted all are returned; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import for_python, staged

LINKS = 16
CANDIDATES = 64
EXPLORE = 160
SHARD_ROWS = 16_384
SHARD_BYTES = 64 << 20
QUERY_BLOCK = 2_048
_ROWS = 256


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _nearest(points: np.ndarray, at: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The k of ``among`` nearest to each point ``at``, nearest first, without the point itself."""
    own = points[among]
    square = (own ** 2).sum(axis=1)
    d = square[None, :] - 2 * points[at] @ own.T
    d[among[None, :] == at[:, None]] = np.inf
    k = min(k, among.size - 1)
    part = np.argpartition(d, k - 1, axis=1)[:, :k]
    order = np.argsort(np.take_along_axis(d, part, axis=1), axis=1, kind="stable")
    return among[np.take_along_axis(part, order, axis=1)]


def _diverse(points: np.ndarray, at: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Of each row of candidates, nearest first, those nearer to the node than to any taken before;
    -1 fills the rest."""
    group = points[near]
    to_node = ((group - points[at][:, None, :]) ** 2).sum(axis=2)
    taken = np.zeros(near.shape, dtype=bool)
    closest = np.full(near.shape, np.inf)
    for j in range(near.shape[1]):
        pick = (to_node[:, j] < closest[:, j]) & (taken.sum(axis=1) < links)
        taken[:, j] = pick
        apart = ((group - group[:, j:j + 1, :]) ** 2).sum(axis=2)
        closest = np.where(pick[:, None], np.minimum(closest, apart), closest)
    out = np.full((near.shape[0], links), -1, dtype=np.int32)
    rows, columns = np.nonzero(taken)
    out[rows, (np.cumsum(taken, axis=1) - 1)[rows, columns]] = near[rows, columns]
    return out


def build(points: np.ndarray, links: int = LINKS, candidates: int = CANDIDATES,
          seed: int = 5) -> tuple[np.ndarray, list[np.ndarray]]:
    """Level of every node and, per level from 0, an array (nodes, width) of neighbours, -1 filled."""
    n = points.shape[0]
    rng = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - rng.random(n)) / np.log(links)).astype(np.int32)
    graph = []
    for at_level in range(int(level.max()) + 1 if n else 0):
        nodes = np.flatnonzero(level >= at_level)
        width = 2 * links if at_level == 0 else links
        table = np.full((n, width), -1, dtype=np.int32)
        if nodes.size > 1:
            sources, targets = [], []
            for i in range(0, nodes.size, _ROWS):
                block = nodes[i:i + _ROWS]
                chosen = _diverse(points, block, _nearest(points, block, nodes, candidates), links)
                rows, columns = np.nonzero(chosen >= 0)
                sources.append(block[rows])
                targets.append(chosen[rows, columns])
            a, b = np.concatenate(sources), np.concatenate(targets)
            # links first, then reverse links of the nearest, as many as there is room for
            a, b, back = np.r_[a, b], np.r_[b, a], np.r_[np.zeros(a.size, int), np.ones(a.size, int)]
            _, first = np.unique(a.astype(np.int64) * n + b, return_index=True)
            first = first[np.argsort(back[first], kind="stable")]
            a, b, back = a[first], b[first], back[first]
            d = ((points[a] - points[b]) ** 2).sum(axis=1)
            order = np.lexsort((d, back, a))
            a, b = a[order], b[order]
            start = np.searchsorted(a, a)
            place = np.arange(a.size) - start
            fits = place < width
            table[a[fits], place[fits]] = b[fits]
        graph.append(table)
    return level, graph


def search(points: np.ndarray, level: np.ndarray, graph: list[np.ndarray], query: np.ndarray,
           explore: int = EXPLORE) -> list[tuple[float, int]]:
    """(squared distance, node) of the nodes explored, nearest first."""
    best = int(level.argmax())
    distance = float(((points[best] - query) ** 2).sum())
    for table in reversed(graph[1:]):
        moved = True
        while moved:
            near = table[best]
            near = near[near >= 0]
            moved = False
            if near.size:
                d = ((points[near] - query) ** 2).sum(axis=1)
                i = int(d.argmin())
                if d[i] < distance:
                    best, distance, moved = int(near[i]), float(d[i]), True
    seen = np.zeros(points.shape[0], dtype=bool)
    seen[best] = True
    todo, found = [(distance, best)], [(-distance, best)]
    while todo:
        d, node = heapq.heappop(todo)
        if d > -found[0][0] and len(found) >= explore:
            break
        near = graph[0][node]
        near = near[near >= 0]
        near = near[~seen[near]]
        seen[near] = True
        if not near.size:
            continue
        far = ((points[near] - query) ** 2).sum(axis=1)
        for x, other in zip(far.tolist(), near.tolist(), strict=True):
            if len(found) < explore:
                heapq.heappush(found, (-x, other))
                heapq.heappush(todo, (x, other))
            elif x < -found[0][0]:
                heapq.heapreplace(found, (-x, other))
                heapq.heappush(todo, (x, other))
    return sorted((-d, node) for d, node in found)


def index(vectors: DataFrame, k: int) -> DataFrame:
    """One row per shard: dim, shard, points, level, neighbours of all levels, node ids. Every usable
    row is in it. ``vectors(vec_id, embedding)``."""
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).distinct()
    least = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = rows.withColumn("place", F.row_number().over(least)).filter(
        F.col("place") <= k + 1).groupBy("embedding").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = staged(nodes.withColumn("dim", F.size("embedding")), "vector-nodes")
    per_shard = F.greatest(F.lit(1), F.least(F.lit(SHARD_ROWS), F.floor(
        F.lit(SHARD_BYTES) / (8 * F.col("dim")))))
    shards = nodes.groupBy("dim").agg(F.count("*").alias("n")).select(
        "dim", F.ceil(F.col("n") / per_shard).cast("int").alias("shards"))
    shards = staged(shards, "shard-counts")
    # A shard is little data but much work: a fixed number of partitions, so that small shards are not
    # put together in one task.
    tasks = 2 * (shards.agg(F.sum("shards")).first()[0] or 1)
    dealt = nodes.join(shards, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int")).repartition(
        tasks, "dim", "shard")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ids", key=lambda c: c.map(lambda x: x[0]))
        points = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        level, graph = build(points)
        return pd.DataFrame({
            "dim": [int(pdf["dim"].iloc[0])], "shard": [int(pdf["shard"].iloc[0])],
            "points": [points.tobytes()], "level": [level.tobytes()],
            "neighbours": [[g.tobytes() for g in graph]],
            "counts": [np.array([len(x) for x in pdf["ids"]], dtype=np.int32).tobytes()],
            "ids": [np.concatenate(pdf["ids"].to_numpy()).astype(np.int64).tobytes()]})

    return for_python(dealt).groupBy("dim", "shard").applyInPandas(
        run, "dim int, shard int, points binary, level binary, neighbours array<binary>, "
             "counts binary, ids binary")


def _shard_results(row: pd.Series, queries: pd.DataFrame, k: int, explore: int) -> Iterator[tuple]:
    dim = int(row["dim"])
    points = np.frombuffer(row["points"], dtype=np.float64).reshape(-1, dim)
    level = np.frombuffer(row["level"], dtype=np.int32)
    graph = [np.frombuffer(g, dtype=np.int32).reshape(len(level), -1) for g in row["neighbours"]]
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    ends = np.cumsum(np.frombuffer(row["counts"], dtype=np.int32))
    for query_id, vector in zip(queries["query_id"], queries["vector"], strict=True):
        query = np.asarray(vector, dtype=np.float64)
        got: list[tuple[float, int]] = []
        for _, node in search(points, level, graph, query, explore):
            score = float(np.sqrt(((points[node] - query) ** 2).sum()))
            if len(got) >= k and score > got[k - 1][0]:
                break
            own = ids[ends[node - 1] if node else 0:ends[node]]
            got.extend((score, int(i)) for i in own if i != query_id)
            got.sort()
            del got[k:]
        yield from ((int(query_id), i, score) for score, i in got)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10,
            explore: int = EXPLORE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row of ``queries``, which has the
    columns of ``vectors``. A query's own id is no candidate."""
    shards = staged(index(vectors, k), "vector-index")
    asked = queries.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("query_id"),
        F.col("embedding").cast("array<double>").alias("vector")).distinct()
    asked = staged(asked.withColumn("dim", F.size("vector")), "queries")
    blocks = F.greatest(F.lit(1), F.ceil(F.lit(asked.count()) / QUERY_BLOCK)).cast("int")
    sent = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), blocks)).join(
        shards.select("dim", "shard"), "dim").select(
        *[F.col(c).alias(c) for c in ("query_id", "vector", "dim", "shard", "block")])
    held = shards.withColumn("block", F.explode(F.sequence(
        F.lit(0).cast("long"), blocks.cast("long") - 1)))

    def run(index_rows: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        out = list(_shard_results(index_rows.iloc[0], some, k, explore)) if (
            len(index_rows) and len(some)) else []
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    key = ["dim", "shard", "block"]
    found = for_python(held).groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(
        run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
