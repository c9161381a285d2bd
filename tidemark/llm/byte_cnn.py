"""Language identification by a byte convolutional network, trained here in numpy.

A text is cut into consecutive windows of ``WINDOW`` bytes that cover all of it. Each window runs
through byte embeddings, filters of several widths, max pooling and softmax; the text gets the mean
of its windows' log probabilities, weighted by their length. Training uses a bounded sample:
``per_language`` labelled documents of each language, picked by a hash of the id, and at most
``windows_per_doc`` windows spread over each of them.

Defined cases: a null text or one without a letter is ``und`` with score 0; a text shorter than a
window is padded with byte 0; labels that are null teach nothing; without any label every text is
``und`` with score 0; with one label every other text gets it; an empty table gives an empty result;
kept columns with the
names of the results are replaced; rows that repeat are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import for_python, pieces, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
NO_LANGUAGE = "und"
_ROWS = 64  # windows in one numpy batch


@dataclass
class Model:
    """``filters`` has one column per filter; rows beyond a filter's width are zero."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray


def _patches(x: np.ndarray) -> np.ndarray:
    """Neighbouring embeddings side by side: (n, positions, widest * EMBEDDING)."""
    n, length, _ = x.shape
    flat = np.ascontiguousarray(x).reshape(n, -1)
    step = EMBEDDING * flat.itemsize
    view = np.lib.stride_tricks.as_strided(
        flat, (n, length - WIDTHS[-1] + 1, WIDTHS[-1] * EMBEDDING),
        (flat.strides[0], step, flat.itemsize))
    return np.ascontiguousarray(view)


def _respond(embedding: np.ndarray, filters: np.ndarray, windows: np.ndarray,
             ) -> tuple[np.ndarray, np.ndarray]:
    patches = _patches(embedding.take(windows, axis=0))
    z = patches.reshape(-1, patches.shape[2]) @ filters
    return patches, z.reshape(len(windows), -1, filters.shape[1])


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6,
          batch: int = 64, rate: float = 0.01, seed: int = 7) -> Model:
    """Adam on cross entropy; ``windows`` is (n, WINDOW) uint8."""
    rng = np.random.default_rng(seed)
    classes, total = len(languages), FILTERS * len(WIDTHS)
    mask = np.zeros((WIDTHS[-1] * EMBEDDING, total), dtype=np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w * EMBEDDING, i * FILTERS:(i + 1) * FILTERS] = 1
    params = {
        "e": rng.normal(0, 0.3, (256, EMBEDDING)),
        "f": rng.normal(0, 0.2, mask.shape) * mask,
        "b": np.zeros(total),
        "d": rng.normal(0, 0.1, (total, classes)),
        "c": np.zeros(classes),
    }
    params = {k: v.astype(np.float32) for k, v in params.items()}
    mean = {k: np.zeros_like(v) for k, v in params.items()}
    square = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    for _ in range(epochs if classes > 1 else 0):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            grads = _gradients(params, windows[pick], labels[pick])
            grads["f"] *= mask
            step += 1
            for k, g in grads.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                params[k] -= rate * (mean[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(languages, *(params[k] for k in "efbdc"))


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _gradients(params: dict, windows: np.ndarray, labels: np.ndarray) -> dict:
    n = len(windows)
    rows = np.arange(n)[:, None]
    patches, z = _respond(params["e"], params["f"], windows)
    best = z.argmax(axis=1)
    h = np.maximum(np.take_along_axis(z, best[:, None, :], axis=1)[:, 0] + params["b"], 0)
    p = _softmax(h @ params["d"] + params["c"])
    p[rows[:, 0], labels] -= 1
    p /= n
    dh = (p @ params["d"].T) * (h > 0)
    grads = {"d": h.T @ p, "c": p.sum(axis=0), "b": dh.sum(axis=0),
             "f": np.einsum("nfk,nf->kf", patches[rows, best], dh),
             "e": np.zeros_like(params["e"])}
    back = dh[:, :, None] * params["f"].T[None]
    for j in range(WIDTHS[-1]):
        np.add.at(grads["e"], windows[rows, best + j],
                  back[:, :, j * EMBEDDING:(j + 1) * EMBEDDING])
    return grads


def log_probabilities(model: Model, windows: np.ndarray) -> np.ndarray:
    _, z = _respond(model.embedding, model.filters, windows)
    h = np.maximum(z.max(axis=1) + model.bias, 0)
    z = h @ model.dense + model.dense_bias
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the given texts: start, length, index of the text."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    owner = np.repeat(np.arange(size.size), count)
    number = np.arange(owner.size) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][owner] + number * WINDOW
    return start, np.minimum(WINDOW, offsets[1:][owner] - start), owner


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    return np.where(inside, data[np.minimum(at, data.size - 1)], 0).astype(np.uint8)


def predict_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean log probability of every text, (texts, languages); texts without bytes get 0."""
    start, length, owner = cut_windows(data, offsets)
    out = np.zeros((offsets.size - 1, len(model.languages)))
    for at in range(0, start.size, _ROWS):
        s = slice(at, at + _ROWS)
        got = log_probabilities(model, gather(data, start[s], length[s]))
        np.add.at(out, owner[s], got * length[s][:, None])
    return out / np.maximum(np.diff(offsets), 1)[:, None]


def training_sample(docs: DataFrame, usable: Column, per_language: int, windows_per_doc: int,
                    ) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A bounded sample on the driver: per language at most ``per_language`` documents, of each at
    most ``windows_per_doc`` windows from places spread evenly over the whole text."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id")
    picked = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "doc_id").withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= per_language).select("lang", "doc_id")
    text = F.encode("text", "UTF-8")
    size = F.octet_length("text")
    places = F.transform(
        F.sequence(F.lit(0), F.lit(windows_per_doc - 1)),
        lambda i: F.substring(
            text, (F.floor(F.greatest(size - WINDOW, F.lit(0)) * i / max(1, windows_per_doc - 1))
                   + 1).cast("int"), F.lit(WINDOW)))
    rows = docs.filter(usable & F.col("lang").isNotNull() & (size > 0)).join(
        F.broadcast(picked), ["lang", "doc_id"]).select(
        "lang", F.explode(F.array_distinct(places)).alias("bytes")).collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["bytes"])))
    languages = sorted({r["lang"] for r in rows})
    index = {lang: i for i, lang in enumerate(languages)}
    windows = np.zeros((len(rows), WINDOW), dtype=np.uint8)
    for i, r in enumerate(rows):
        windows[i, :len(r["bytes"])] = np.frombuffer(bytes(r["bytes"]), dtype=np.uint8)
    return windows, np.array([index[r["lang"]] for r in rows], dtype=np.int64), languages


def fit(docs: DataFrame, usable: Column, per_language: int = 250,
        windows_per_doc: int = 4) -> Model:
    windows, labels, languages = training_sample(docs, usable, per_language, windows_per_doc)
    return train(windows, labels, languages)


def _has_letter(column: pa.Array) -> np.ndarray:
    return np.array([x is not None and any(map(str.isalpha, x)) for x in column.to_pylist()],
                    dtype=bool)


def with_letters(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield piece.filter(pa.array(_has_letter(
                    piece.column(piece.schema.get_field_index("text"))), pa.bool_()))

    return for_python(docs).mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The kept columns plus lang_pred and score, the mean probability of the predicted language."""
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    kept = docs.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema),
                        "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "__text"):
                column = piece.column(piece.schema.get_field_index("__text"))
                letters = _has_letter(column)
                names = np.full(piece.num_rows, NO_LANGUAGE, dtype=object)
                score = np.zeros(piece.num_rows)
                if model.languages and letters.any():
                    logs = predict_texts(model, *text_bytes(column))
                    best = logs.argmax(axis=1)
                    probability = np.exp(logs)
                    top = probability.max(axis=1) / probability.sum(axis=1)
                    names[letters] = np.array(model.languages, dtype=object)[best[letters]]
                    score[letters] = np.clip(top[letters], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(i) for i in range(len(keep))]
                    + [pa.array(names, pa.string()), pa.array(score)],
                    names=[*keep, "lang_pred", "score"])

    return for_python(docs).select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
