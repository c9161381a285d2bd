"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation
(one confusion table per labeller, votes independent given the class) estimates how reliable each is;
it needs only how often each pattern of votes occurs, so all documents count and at most 3 to the
number of labellers rows reach the driver. The posterior of a document's pattern is its soft label. On
a bounded sample of documents, half of them likely good, half likely bad, soft labels train a linear
scorer over hashed features: frequencies of byte trigrams and of words by how often they repeat. The
scorer then judges all documents over their whole texts.

Defined cases: a null text or one without words scores 0; with votes of one kind only, the scorer
follows their posterior; an empty table gives an empty result; rows that repeat are judged each; extra
columns are kept by :func:`classify`, but for ones with the names of the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    SPACE, count_words, for_python, let, pieces, splitmix, staged, text_bytes, word_hashes,
    word_spans,
)

GOOD, BAD, NONE = 1, 0, 2
BITS = 16
SAMPLE = 1_500  # documents of either side that the scorer learns from


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE)


def votes(text: Column) -> Column:
    """Array of the labellers' votes on a text."""
    text = F.coalesce(text, F.lit(""))

    def judged(m: Column) -> Column:
        n = F.greatest(m["words"], F.lit(1)).cast("double")
        lines = F.greatest(m["lines"], F.lit(1)).cast("double")
        return F.array(
            _vote(m["words"] >= 100, m["words"] < 20),
            _vote(m["symbols"] / n < 0.02, m["symbols"] / n > 0.2),
            _vote(m["upper"] / F.greatest(m["letters"], F.lit(1)) < 0.1,
                  m["upper"] / F.greatest(m["letters"], F.lit(1)) > 0.5),
            _vote(F.lit(False), m["pipes"] / n > 0.2),
            _vote(m["distinct"] / n > 0.4, m["distinct"] / n < 0.2),
            _vote((m["letters"] / n > 2.5) & (m["letters"] / n < 9),
                  (m["letters"] / n < 1.5) | (m["letters"] / n > 14)),
            _vote(m["ended"] / lines >= 0.8, m["ended"] / lines < 0.2),
            _vote(m["shouts"] / n < 0.02, m["shouts"] / n > 0.3),
        )

    def without(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    words = F.split(text, f"[{SPACE}]+")
    measures = F.struct(
        count_words(text).alias("words"), F.size(F.array_distinct(words)).alias("distinct"),
        without(r"[#*$%&|<>]+").alias("symbols"), without(r"\|+").alias("pipes"),
        without(r"\p{Lu}+").alias("upper"), without(r"\p{L}+").alias("letters"),
        without(r"!+").alias("shouts"), F.size(F.split(text, "\n")).alias("lines"),
        F.regexp_count(text, F.lit(r"(?m)[.!?]$")).alias("ended"))
    return let(measures, judged)


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200,
                  ) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over patterns (p, labellers) of votes with their counts: share of good documents,
    (labellers, class, vote) probabilities, and the posterior of good for each pattern."""
    labellers = patterns.shape[1]
    one_hot = np.eye(3)[patterns]  # (p, labellers, vote)
    says_good = (patterns == GOOD).sum(axis=1)
    says_bad = (patterns == BAD).sum(axis=1)
    good = (says_good + 1) / (says_good + says_bad * 3 + 2)  # a bad vote is the rarer, stronger one
    prior, table = 0.5, np.full((labellers, 2, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        table = np.einsum("cp,plv->lcv", weight, one_hot) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        log = np.einsum("plv,lcv->pc", one_hot, np.log(table)) + np.log([1 - prior, prior])
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            good = new
            break
        good = new
    return float(prior), table, good


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashed feature, weight) arrays of each text; the weights of either kind add up to 1."""
    mask = np.uint64((1 << BITS) - 1)
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    wide = data.astype(np.uint64)
    grams = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:] if (
        wide.size > 2) else wide[:0]
    grams = (splitmix(grams) & mask).astype(np.int64)
    for i in range(offsets.size - 1):
        g = grams[offsets[i]:max(offsets[i], offsets[i + 1] - 2)]
        _, many = np.unique(hashes[first[i]:first[i + 1]], return_counts=True)
        n = max(1, int(many.sum()))
        # a word's share of the text, in powers of two, told apart from how long the text is
        kind = np.floor(np.log2(np.maximum(many, 1))).astype(np.uint64) * np.uint64(64) + np.uint64(
            min(63, int(np.log2(n))))
        at = (splitmix(kind + np.uint64(1 << 40)) & mask).astype(np.int64)
        yield np.concatenate([g, at]), np.concatenate(
            [np.full(g.size, 1 / max(1, g.size)), many / n])


def train(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8,
          rate: float = 0.5, seed: int = 3) -> Scorer:
    """Logistic regression on soft labels, Adagrad over single examples, each of distinct features."""
    weights, bias = np.zeros(1 << BITS), 0.0
    square, bias_square = np.full(1 << BITS, 1e-8), 1e-8
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            at, x = examples[i]
            p = 1 / (1 + np.exp(-np.clip(weights[at] @ x + bias, -30, 30)))
            g = p - labels[i]
            square[at] += (g * x) ** 2
            weights[at] -= rate * g * x / np.sqrt(square[at])
            bias_square += g * g
            bias -= 0.1 * rate * g / np.sqrt(bias_square)
    return Scorer(weights, float(bias))


def _apply(scorer: Scorer, column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    out = np.zeros(len(column))
    for i, (at, x) in enumerate(_features(data, offsets)):
        if at.size:
            out[i] = 1 / (1 + np.exp(-np.clip(scorer.weights[at] @ x + scorer.bias, -30, 30)))
    return out


def soft_labels(docs: DataFrame) -> DataFrame:
    """``docs`` plus votes and posterior. The table of patterns has at most 3^8 rows. The votes cost
    several searches of each text and are read three times, so they are stored with the texts."""
    voted = staged(docs.drop("posterior").withColumn("votes", votes(F.col("text"))), "votes")
    counted = voted.groupBy("votes").agg(F.count("*").alias("n")).collect()
    if not counted:
        return voted.withColumn("posterior", F.lit(0.0))
    counted.sort(key=lambda r: r["votes"])
    patterns = np.array([r["votes"] for r in counted])
    _, _, good = fit_labellers(patterns, np.array([r["n"] for r in counted], dtype=float))
    table = docs.sparkSession.createDataFrame(
        [(r["votes"], float(g)) for r, g in zip(counted, good, strict=True)],
        "votes array<int>, posterior double")
    return voted.join(F.broadcast(table), "votes")


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Scorer from soft labels: of likely good and of likely bad documents, ``sample`` each, picked
    by a hash of the id."""
    order = Window.partitionBy("side").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id")
    rows = labelled.filter(F.octet_length("text") > 0).withColumn(
        "side", F.col("posterior") >= 0.5).select("side", "doc_id", "posterior").withColumn(
        "place", F.row_number().over(order)).filter(F.col("place") <= sample).drop("place", "side")
    schema = "posterior double, feature array<int>, weight array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                got = []
                for at, x in _features(*text_bytes(piece.column(1))):
                    used, inverse = np.unique(at, return_inverse=True)
                    got.append((used.astype(np.int32),
                                np.bincount(inverse, x).astype(np.float32) if used.size else
                                np.zeros(0, np.float32)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([g[0] for g in got], pa.list_(pa.int32())),
                     pa.array([g[1] for g in got], pa.list_(pa.float32()))],
                    names=["posterior", "feature", "weight"])

    texts = labelled.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select(
        "posterior", "text")
    table = for_python(texts).mapInArrow(run, schema).toArrow().combine_chunks()
    posterior = table.column("posterior").to_numpy()
    many = table.column("feature").combine_chunks().value_lengths().to_numpy()
    ends = np.cumsum(many)
    feature, weight = (np.asarray(table.column(c).combine_chunks().flatten())
                       for c in ("feature", "weight"))
    examples = [(feature[e - n:e], weight[e - n:e]) for n, e in zip(many, ends, strict=True)]
    # an order that does not depend on how rows arrive
    mark = [int(np.sum(splitmix(at.astype(np.uint64)), dtype=np.uint64)) for at, _ in examples]
    order = sorted(range(len(examples)), key=lambda i: (posterior[i], mark[i]))
    return train([examples[i] for i in order], posterior[order])


def classify(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``docs`` plus score (0 to 1)."""
    docs = docs.drop("score")
    names, place = docs.columns, docs.columns.index("text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(i) for i in range(len(names))),
                     pa.array(_apply(scorer, piece.column(place)))], names=[*names, "score"])

    return for_python(docs).mapInArrow(run, schema)
