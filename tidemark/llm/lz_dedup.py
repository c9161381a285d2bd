"""Substring dedup by relative Lempel-Ziv parsing against an index of the whole corpus.

The index. A document is read as phrases: runs of neighbouring ``window``-word windows that have the
same least ``anchor``-word gram. Where a phrase begins and ends depends on its words alone, so equal
passages fall into equal phrases wherever they stand. The reference blocks of the index are ranges of
phrase hashes; a block knows the earliest place (document, then word) of each of its phrases. A phrase
belongs to one block, so asking its owner asks every block.

The parse. Each document is factored greedily: a phrase found earlier is copied from its earliest
place, and a factor grows as long as the next phrase continues at the next place of the same
reference. Such a factor spans at least ``window`` words: a duplicate span.

Factor boundaries. Where a copied passage ends inside a phrase, the phrase is new though some of its
windows are not. These are the first places of phrases whose anchor also has other phrases; their
windows are looked up one by one in a window index built the same way.

Groups of copies are combined where they are read: a batch of phrases sends one place per phrase to
its block, and an anchor with several phrases in one batch goes to the boundary check from there, so
no block holds more than a few entries per batch for any passage, however often it occurs.

Defined cases: a null text has no words; a text shorter than a window keeps them all; a null id
counts as the least id; rows equal in id and text count as one document and share its result, and
rows that share an id with different texts are told apart by a text hash and ordered by it; an empty
table gives an empty result; extra columns stay as they are in :func:`dedup_texts`, but for ones with
the names of its results, which are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    chain, for_python, from_planes, pieces, planes, splitmix, staged, text_bytes, word_hashes,
    word_spans,
)

WINDOW, ANCHOR = 20, 8
_FLUSH = 1 << 19  # phrases combined in one batch
_NO_ID = -(1 << 63)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# doc and text name a document, at is the word a span starts with, size its words
_PLACE = [("doc", np.int64), ("text", np.int64), ("at", np.uint32), ("size", np.uint32)]
_FIELDS = [("key", np.uint64), ("anchor", np.uint64), *_PLACE,
           ("ref_doc", np.int64), ("ref_at", np.uint32), ("kind", np.uint8)]
_NAMES = [n for n, _ in _FIELDS]
_PACKED = "part long, " + ", ".join(f"`{n}` binary" for n in _NAMES)
_PACKED_SCHEMA = pa.schema([("part", pa.int64()), *((n, pa.binary()) for n in _NAMES)])
# to be looked up, found earlier, to be checked window by window, one of several of an anchor
_OPEN, _COPY, _CHECK, _TELL = 0, 1, 2, 3

Table = dict[str, np.ndarray]


def _pick(t: Table, rows: np.ndarray) -> Table:
    return {n: v[rows] for n, v in t.items()}


def _join(tables: list[Table]) -> Table:
    return {n: np.concatenate([t[n] for t in tables]) for n, _ in _FIELDS}


def _pack(t: Table, part: np.ndarray) -> list[dict]:
    order = np.lexsort((t["key"], part))
    t, part = _pick(t, order), part[order]
    edges = np.flatnonzero(np.diff(part, prepend=part[0] - 1, append=part[-1] + 1)) if part.size else []
    return [{"part": int(part[a]), **{n: planes(np.ascontiguousarray(v[a:b])) for n, v in t.items()}}
            for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _unpack(pdf: pd.DataFrame) -> Table:
    return {n: np.concatenate([from_planes(raw, kind) for raw in pdf[n]]) for n, kind in _FIELDS}


def _resolved(t: Table) -> Table:
    """Of the open places of each key the least stays open; the others become copies of it. Equal
    places (rows that repeat) count once."""
    order = np.lexsort((t["at"], t["text"], t["doc"], t["key"]))
    t = _pick(t, order)
    same = np.zeros(order.size, dtype=bool)
    same[1:] = t["key"][1:] == t["key"][:-1]
    twin = same.copy()
    for n in ("doc", "text", "at"):
        twin[1:] &= t[n][1:] == t[n][:-1]
    head = np.maximum.accumulate(np.where(same, 0, np.arange(order.size)))
    t["kind"] = np.where(same, _COPY, t["kind"]).astype(np.uint8)
    t["ref_doc"] = np.where(same, t["doc"][head], t["ref_doc"])
    t["ref_at"] = np.where(same, t["at"][head], t["ref_at"]).astype(np.uint32)
    return _pick(t, ~twin)


def _phrases(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int,
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """owner, first word (in the batch), words, phrase hash and anchor hash of all phrases."""
    grams = chain(hashes, anchor)
    reach = window - anchor + 1
    owner = np.repeat(np.arange(first.size - 1), np.maximum(np.diff(first) - window + 1, 0))
    if not owner.size:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    many = np.bincount(owner, minlength=first.size - 1)
    start = first[owner] + np.arange(owner.size) - (np.cumsum(many) - many)[owner]
    low = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1)
    place = start + low[start]
    new = np.ones(owner.size, dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, owner.size)) + window - 1
    begin = start[heads]
    up, down = _power_run(_ODD, hashes.size), _power_run(_UNDO, hashes.size)
    sums = np.zeros(hashes.size + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    raw = (sums[begin + size] - sums[begin]) * down[begin]
    phrase = splitmix(raw ^ splitmix(size.astype(np.uint64)))
    return owner[heads], begin, size, phrase, grams[place[heads]]


def _power_run(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    return (key >> np.uint64(32)).astype(np.int64) * ranges >> 32


def _combined(tables: Iterator[Table], ranges: int) -> Iterator[pa.RecordBatch]:
    """Batches of open places, combined and sent to the blocks that own them; copies found on the
    way go to groups beyond the blocks. A row's group depends on the row alone, so that a task that is
    run again sends it to the same one."""
    held: list[Table] = []
    spare = max(16, ranges // 8)

    def flush() -> pa.RecordBatch:
        t = _resolved(_join(held))
        place = splitmix(t["doc"].astype(np.int64).view(np.uint64) ^ splitmix(t["at"].astype(np.uint64)))
        part = np.where(t["kind"] == _OPEN, _range_of(t["key"], ranges),
                        ranges + (place % np.uint64(spare)).astype(np.int64))
        t["key"] = np.where(t["kind"] == _OPEN, t["key"], 0).astype(np.uint64)
        t["anchor"] = np.where(t["kind"] == _OPEN, t["anchor"], 0).astype(np.uint64)
        return pa.RecordBatch.from_pylist(_pack(t, part), schema=_PACKED_SCHEMA)

    total = 0
    for t in tables:
        held.append(t)
        total += t["key"].size
        if total >= _FLUSH:
            yield flush()
            held, total = [], 0
    if total:
        yield flush()


def _table(key: np.ndarray, anchor: np.ndarray, doc: np.ndarray, text: np.ndarray, at: np.ndarray,
           size: np.ndarray | int) -> Table:
    n = key.size
    return {"key": key, "anchor": anchor, "doc": doc, "text": text, "at": at.astype(np.uint32),
            "size": np.broadcast_to(np.asarray(size, dtype=np.uint32), (n,)).copy(),
            "ref_doc": np.zeros(n, dtype=np.int64), "ref_at": np.zeros(n, dtype=np.uint32),
            "kind": np.zeros(n, dtype=np.uint8)}


def _longs(piece: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(piece.column(piece.schema.get_field_index(name)).to_numpy(False), np.int64)


def _words_of(piece: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(piece.column(piece.schema.get_field_index(name)))
    starts, ends, first = word_spans(data, offsets)
    return word_hashes(data, starts, ends), first


def _phrase_places(docs: DataFrame, ranges: int, window: int, anchor: int) -> DataFrame:
    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[Table]:
        for batch in batches:
            for piece in pieces(batch, "_words"):
                hashes, first = _words_of(piece, "_words")
                owner, begin, size, phrase, gram = _phrases(hashes, first, window, anchor)
                yield _table(phrase, gram, _longs(piece, "_doc")[owner],
                             _longs(piece, "_text")[owner], begin - first[owner], size)

    return for_python(docs).select("_doc", "_text", F.col("text").alias("_words")).mapInArrow(
        lambda batches: _combined(tables(batches), ranges), _PACKED)


def _window_places(docs: DataFrame, checks: DataFrame, ranges: int, window: int) -> DataFrame:
    """The windows of the spans to be checked."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[Table]:
        for batch in batches:
            for piece in pieces(batch, "_words"):
                hashes, first = _words_of(piece, "_words")
                keys = chain(hashes, window)
                spans = piece.column(piece.schema.get_field_index("spans"))
                owner = np.repeat(np.arange(piece.num_rows), np.asarray(spans.value_lengths()))
                at = np.asarray(spans.flatten().field("at"), dtype=np.int64)
                many = np.asarray(spans.flatten().field("size"), dtype=np.int64) - window + 1
                owner, at = np.repeat(owner, many), np.repeat(at, many)
                at = at + np.arange(at.size) - np.repeat(np.cumsum(many) - many, many)
                key = keys[first[owner] + at]
                yield _table(key, np.zeros_like(key), _longs(piece, "_doc")[owner],
                             _longs(piece, "_text")[owner], at, window)

    rows = for_python(docs).join(checks, ["_doc", "_text"]).select(
        "_doc", "_text", "spans", F.col("text").alias("_words"))
    return rows.mapInArrow(lambda batches: _combined(tables(batches), ranges), _PACKED)


def _asked_blocks(places: DataFrame, ranges: int) -> DataFrame:
    """Each block finds copies of its phrases. First places go on to the owner of their anchor,
    unless the block itself holds several phrases of it: then they need the boundary check, and the
    owner is told by one of them."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t = _unpack(pdf)
        part = np.full(t["key"].size, int(pdf["part"].iloc[0]))
        if part[0] < ranges:
            t = _resolved(t)
            is_open = t["kind"] == _OPEN
            anchors, inverse, many = np.unique(
                t["anchor"][is_open], return_inverse=True, return_counts=True)
            several = np.zeros(t["key"].size, dtype=bool)
            several[is_open] = many[inverse] > 1
            t["kind"][several] = _CHECK
            told = np.flatnonzero(several)
            told = told[np.unique(t["anchor"][told], return_index=True)[1]]
            news = _pick(t, told)
            news["kind"] = np.full(told.size, _TELL, dtype=np.uint8)
            t = _join([t, news])
            done = (t["kind"] == _COPY) | (t["kind"] == _CHECK)
            part = np.where(done, ranges + int(pdf["part"].iloc[0]), _range_of(t["anchor"], ranges))
            t["key"] = np.zeros_like(t["key"])
            t["anchor"] = np.where(done, 0, t["anchor"]).astype(np.uint64)
        return pd.DataFrame(_pack(t, part), columns=["part", *_NAMES])

    return places.groupBy("part").applyInPandas(run, _PACKED)


def _asked_anchors(places: DataFrame, ranges: int) -> DataFrame:
    """Spans copied or to be checked, as plain rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t = _unpack(pdf)
        if pdf["part"].iloc[0] < ranges:
            _, inverse = np.unique(t["anchor"], return_inverse=True)
            many = np.bincount(inverse, np.where(t["kind"] == _TELL, 2, 1))
            t["kind"] = np.where((t["kind"] == _OPEN) & (many[inverse] > 1), _CHECK, t["kind"])
        return _rows(_pick(t, (t["kind"] == _COPY) | (t["kind"] == _CHECK)))

    return places.groupBy("part").applyInPandas(run, _SPANS)


def _asked_windows(places: DataFrame, ranges: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t = _unpack(pdf)
        if pdf["part"].iloc[0] < ranges:
            t = _resolved(t)
        return _rows(_pick(t, t["kind"] == _COPY))

    return places.groupBy("part").applyInPandas(run, _SPANS)


_SPANS = ("_doc long, _text long, at int, size int, ref_doc long, ref_at int, `check` boolean")


def _rows(t: Table) -> pd.DataFrame:
    return pd.DataFrame({
        "_doc": t["doc"], "_text": t["text"], "at": t["at"].astype(np.int32),
        "size": t["size"].astype(np.int32), "ref_doc": t["ref_doc"],
        "ref_at": t["ref_at"].astype(np.int32), "check": t["kind"] == _CHECK})


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_doc"),
                       F.xxhash64("text").alias("_text"))


def copied_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(_doc, _text, at, size, ref_doc, ref_at): spans of whole windows that occur earlier."""
    named = _identified(docs)
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, size >> 23)  # about 200,000 phrases in a block
    places = _asked_blocks(_phrase_places(named, ranges, window, anchor), ranges)
    spans = staged(_asked_anchors(places, ranges), "spans")
    checks = spans.filter("check").groupBy("_doc", "_text").agg(
        F.collect_list(F.struct("at", "size")).alias("spans"))
    windows = _asked_windows(_window_places(named, checks, ranges, window), ranges)
    return spans.filter("not check").union(windows).drop("check")


def parse(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Greedy factors (at, size, ref_doc, ref_at) from copied spans of a document: the longest span
    from where the parse stands, then whatever continues it at the next place of its reference."""
    factors: list[tuple[int, int, int, int]] = []
    for at, size, ref_doc, ref_at in sorted(spans, key=lambda x: (x[0], -x[1], x[2], x[3])):
        if factors:
            a, n, doc, r = factors[-1]
            if at + size <= a + n:
                continue
            if doc == ref_doc and ref_at - at == r - a and at <= a + n:
                factors[-1] = (a, at + size - a, doc, r)
                continue
        factors.append((at, size, ref_doc, ref_at))
    return factors


def dedup_texts(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with the words of duplicate spans removed from the text (kept words are joined by
    one space where any word goes), plus n_words, n_removed and the factors."""
    docs = docs.drop("n_words", "n_removed", "factors")
    lists = copied_spans(docs, window, anchor).groupBy("_doc", "_text").agg(
        F.collect_list(F.struct("at", "size", "ref_doc", "ref_at")).alias("_spans"))
    named = _identified(docs).join(lists, ["_doc", "_text"], "left").select(*docs.columns, "_spans")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        "n_words long, n_removed long, factors "
                        "array<struct<at:int,size:int,ref_doc:long,ref_at:int>>"])
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column(place).to_pylist()
                spans = piece.column(len(docs_columns)).to_pylist()
                n_words, n_removed, factors = [], [], []
                for i, (text, found) in enumerate(zip(texts, spans, strict=True)):
                    words = _WORD.findall(text) if text else []
                    got = parse([(x["at"], x["size"], x["ref_doc"], x["ref_at"])
                                 for x in found or []])
                    if got:
                        gone = np.zeros(len(words) + 1, dtype=np.int32)
                        np.add.at(gone, [a for a, *_ in got], 1)
                        np.add.at(gone, [a + n for a, n, *_ in got], -1)
                        stay = np.cumsum(gone[:-1]) == 0
                        texts[i] = " ".join(w for w, s in zip(words, stay, strict=True) if s)
                        n_removed.append(int(len(words) - stay.sum()))
                    else:
                        n_removed.append(0)
                    n_words.append(len(words))
                    factors.append([dict(zip(("at", "size", "ref_doc", "ref_at"), f, strict=True))
                                    for f in got])
                columns = [piece.column(i) for i in range(len(docs_columns))]
                columns[place] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(factors, _FACTORS)],
                    names=[*docs_columns, "n_words", "n_removed", "factors"])

    docs_columns = docs.columns
    return for_python(named).mapInArrow(run, schema)


_FACTORS = pa.list_(pa.struct([
    ("at", pa.int32()), ("size", pa.int32()), ("ref_doc", pa.int64()), ("ref_at", pa.int32())]))
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
