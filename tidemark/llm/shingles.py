"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.common import chain, pieces, splitmix, text_bytes, word_hashes, word_spans

WIDTH = 5


def sets_of(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """One sorted array of distinct shingle hashes per text: all runs of ``width`` words with A-Z in
    lower case; the whole sequence when there are fewer; nothing without words."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends, lower=True)
    shingles = chain(hashes, width)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(shingles[a:b - width + 1])
        elif b > a:
            yield chain(hashes[a:b], int(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


def set_key(shingles: np.ndarray) -> int:
    """64-bit hash of a set, as a signed number; 0 for the empty set."""
    if not shingles.size:
        return 0
    total = splitmix(np.uint64(np.sum(splitmix(shingles), dtype=np.uint64))
                     + np.uint64(shingles.size).reshape(1))
    return int(total.view(np.int64)[0])


def sets_in(batches: Iterator[pa.RecordBatch], text: str,
            ) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for piece in pieces(batch, text):
            yield piece, list(sets_of(piece.column(piece.schema.get_field_index(text))))
