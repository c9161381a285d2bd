"""Centroid clustering: the search and the rounds against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import orchard as O

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def plain(rows, k=8, rounds=10, dimension=64, seed=3):
    import math
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()
    centres = [p for _, p in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        at = [nearest(p)[1] for _, p in kept]
        for c in range(len(centres)):
            own = [p for (_, p), a in zip(kept, at, strict=True) if a == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [nearest(p) for _, p in kept]
    inertia = [sum(d for d, n in last if n == c) for c in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, inertia[n], sum(inertia), digest[n])
                   for (i, _), (d, n) in zip(kept, last, strict=True)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                               "centroid_sha256").collect()), key=str)


def vectors(n, dimension=64, seed=0, groups=5):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(dimension)] for _ in range(groups)]
    return [(i, [float(np.float32(m + rng.gauss(0, 0.3))) for m in middle[i % groups]]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "name of a result") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("k", [1, 2, 9, 40])
def test_search_finds_the_nearest_with_ties(k):
    rng = np.random.default_rng(k)
    points = rng.integers(-4, 5, (500, 3))
    centroids = rng.integers(-4, 5, (k, 3))  # small numbers: equal centroids and many ties
    d = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
    for start in {0, k // 2, k - 1}:
        at, best = O.search(points, O.Lists.of(centroids), start)
        assert (at == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_search_leaves_centroids_unmeasured():
    centroids = np.array([[0, 0], [1000, 0], [0, 1000], [5000, 5000]])
    lists = O.Lists.of(centroids)
    assert lists.others[0].tolist() == [1, 2, 3] and lists.apart[0].tolist() == [10 ** 6, 10 ** 6, 5 * 10 ** 7]
    assert O.search(np.array([[3, 4]]), lists)[1].tolist() == [25]


def test_rounds_equal_the_plain_ones(spark):
    rows = vectors(300)
    assert got(O.cluster(frame(spark, rows).repartition(5))) == plain(rows)


def test_odd_vectors(spark):
    rows = vectors(40, seed=2)
    rows += [(i, v) for i, v in rows if i % 3 == 0]  # repeats
    rows += [(None, rows[1][1]), (90, None), (91, []), (92, [1.0] * 63), (93, [float("nan")] * 64),
             (94, [None, *[1.0] * 63]), (95, [float("inf"), *[0.0] * 63]), (96, [0.0] * 64), (97, [0.0] * 64)]
    assert got(O.cluster(frame(spark, rows))) == plain(rows)


def test_all_alike_few_and_none(spark):
    same = [(i, [0.25] * 64) for i in range(30)]
    assert got(O.cluster(frame(spark, same))) == plain(same)
    few = vectors(3, seed=4)
    assert got(O.cluster(frame(spark, few))) == plain(few)
    assert O.cluster(frame(spark, few).limit(0)).count() == 0


def test_too_large_components_take_no_part(spark):
    rows = vectors(12, seed=5)
    assert got(O.cluster(frame(spark, [*rows, (50, [3e38, *[0.0] * 63])]))) == plain(rows)


def test_centroids_are_given(spark):
    row = O.cluster(frame(spark, vectors(50, seed=6))).select("centroid", "centroid_sha256").first()
    assert hashlib.sha256(",".join(map(str, row["centroid"])).encode()).hexdigest() == row["centroid_sha256"]


def test_other_shapes(spark):
    rows = vectors(60, dimension=3, seed=7)
    df = frame(spark, rows).withColumnRenamed("embedding", "v").withColumn("point", F.lit(1))
    out = O.cluster(df, centroids=4, rounds=2, dimension=3, seed=9, vector="v")
    assert got(out) == plain(rows, 4, 2, 3, 9)
