"""Importance resampling: features, weights and the draw against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import texts as T
from tidemark.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def plain_features(text):
    w = WORD.findall((text or "").translate(UPPER))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)], len(w)


def bucket(feature):
    return zlib.crc32(feature.encode()) % R.BUCKETS


def plain(docs, targets, percent=25, min_words=20):
    s = Counter(bucket(f) for _, t in docs for f in plain_features(t)[0])
    t = Counter(bucket(f) for x in targets for f in plain_features(x)[0])
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        found, n_words = plain_features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
                for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(gain), weight, score, None, n_words])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (
        -r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for place, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()),
                  key=str)


def test_features_equal_the_plain_ones():
    texts = ["", "a", "Ab cD-ef\x00gh 9z", "äöü Straße x", "日本 ☃", "w" * 70 + " " + "v" * 300 + " W" * 3, " \n", "A"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    found, owner, n_words = R.features(np.frombuffer(b"".join(raw), np.uint8), offsets, 10000)
    for i, t in enumerate(texts):
        want, n = plain_features(t)
        assert sorted(found[owner == i]) == sorted(map(bucket, want)) and n_words[i] == n


@pytest.mark.parametrize("extra", [False, True])
def test_resample_odd_tables(spark, extra):
    texts = [*T.odd_texts(), *T.near_copies(groups=3)]
    rows = list(enumerate(texts))
    docs = T.documents(spark, texts, extra)
    docs = docs.unionByName(docs.filter("doc_id % 4 = 0")).unionByName(  # repeats, and rows without an id
        docs.filter("doc_id in (3, 20, 21)").withColumn("doc_id", F.lit(None).cast("long")))
    rows += [(i, t) for i, t in rows if i % 4 == 0] + [(None, texts[i]) for i in (3, 20, 21)]
    targets = [texts[9], texts[22], None, ""]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    assert got(R.resample(docs, target)) == plain(rows, targets)
    assert got(R.resample(docs, target, percent=100, min_words=0)) == plain(rows, targets, 100, 0)


def test_no_rows_and_no_target(spark):
    docs = T.documents(spark, ["x y z " * 10, None])
    none = spark.createDataFrame([], "text string")
    assert got(R.resample(docs, none, percent=50)) == plain([(0, "x y z " * 10), (1, None)], [], 50)
    assert R.resample(docs.limit(0), none).count() == 0


def test_carried_columns_come_along(spark):
    docs = T.documents(spark, T.near_copies(groups=2))
    out = R.resample(docs, docs, carry=("source", "rank", "lang"))
    assert out.columns.count("rank") == 1
    lost = out.join(
        docs.select("doc_id", F.col("source").alias("s"), F.col("lang").alias("l")), "doc_id").filter(
        "not (source <=> s and lang <=> l)")
    assert lost.count() == 0


@pytest.mark.parametrize("pivots", [1, 3, 24])
def test_the_kth_key_is_exact(spark, pivots):
    rng = random.Random(pivots)
    scores = [rng.randrange(6) for _ in range(400)]  # few values: nearly all keys tie in the score
    table = spark.createDataFrame(list(enumerate(scores)), "id long, score long").repartition(7)
    key = F.struct((-F.col("score")).alias("a"), F.col("id").alias("b"))
    order = sorted((-s, i) for i, s in enumerate(scores))
    for k in (1, 2, 200, 399, 400):
        bound = R.kth_key(table, key, k, 400, pivots, seed=k)
        assert tuple(table.select(bound.alias("k")).first()["k"]) == order[k - 1]
    with pytest.raises(ValueError):
        R.kth_key(table, key, 401, 400)


def test_ranks_run_through_all_parts(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(50), i) for i in range(3000)]
    df = R.ranked(spark.createDataFrame(rows, "s long, i long").repartition(5), [F.col("s"), F.col("i")])
    assert [(r["s"], r["i"]) for r in df.orderBy("rank").collect()] == sorted(rows)
    assert [r["rank"] for r in df.select("rank").orderBy("rank").collect()] == list(range(1, 3001))
