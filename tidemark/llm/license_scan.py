"""License scans: exact phrases and a fuzzy search for short notices.

A text is brought to its words: A-Z lower-cased, words of digits, letters and characters beyond ASCII,
joined by one space. Phrases are found as exact runs of words. Notices are found with up to one edit
(a character inserted, left out or replaced) for every ``CHARS_PER_EDIT`` characters: a notice with E
edits allowed is split into E + 1 pieces, and by the pigeonhole principle every match holds at least one
piece unchanged. Texts without any piece are done after these exact searches. Each place of a piece
gives the word starts, at most E characters from where the notice would begin, at which the ``regex``
library's bounded-error matching tries the whole notice; it reports the best span that ends with a
word, and its edits. Of overlapping spans of a notice the one with the fewest edits stays. Words that
tell licenses apart (``must``) have to be in the span unchanged.

Defined cases: null counts as an empty text; texts without words have no labels and score 0; very long
texts are searched whole; rows that repeat give a row each; an empty table gives an empty result;
columns named like results give way to them.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import for_python, pieces

CHARS_PER_EDIT = 10

# Phrases and the labels they give.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Label, notice in words, words that must be unchanged.
NOTICES = (
    ("mit", "under the mit license", ("mit",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software", ()),
    ("apache-2", "apache license version 2", ("apache", "2")),
    ("apache-2", "licensed under the apache license version 2 0", ("apache", "2")),
    ("cc-by-nc", "creative commons attribution noncommercial", ()),
    ("cc-by-nc", "creative commons attribution non commercial", ()),
    ("cc-by-sa", "creative commons attribution sharealike", ()),
    ("cc-by-sa", "creative commons attribution share alike", ()),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted", ()),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted", ()),
    ("gpl", "gnu general public license", ("gnu",)),
    ("lgpl", "gnu lesser general public license", ("gnu",)),
    ("agpl", "gnu affero general public license", ("gnu",)),
    ("mpl-2", "mozilla public license version 2", ("2",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ()),
)

RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans array<struct<label: string, notice: string, "
          "first_word: long, last_word: long, edits: int, words: string>>")

_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def normal(text: bytes) -> tuple[bytes, int]:
    """A space, then each word and a space; and the number of words."""
    words = [w for w in text.translate(_TABLE).split(b" ") if w]
    return b" ".join([b"", *words, b""]) if words else b" ", len(words)


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    must: tuple[str, ...]
    edits: int
    seeds: tuple[tuple[int, bytes], ...]  # where a piece begins in the notice, and the piece
    pattern: regex.Pattern

    @staticmethod
    def of(label: str, text: str, must: tuple[str, ...] = (),
           chars_per_edit: int = CHARS_PER_EDIT) -> Notice:
        edits = len(text) // chars_per_edit
        cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
        seeds = tuple((a, text[a:b].encode()) for a, b in zip(cuts, cuts[1:], strict=False))
        # (?b) asks for the match with the fewest edits; it ends where a word does
        pattern = regex.compile(f"(?b)(?:{regex.escape(text, literal_spaces=True)})"
                                f"{{e<={edits}}}(?= )")
        return Notice(label, text, must, edits, seeds, pattern)


def places(data: bytes | str, piece: bytes | str) -> Iterator[int]:
    at = data.find(piece)
    while at >= 0:
        yield at
        at = data.find(piece, at + 1)


def verified(words: str, notice: Notice, found: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """Start, end and edits of the notice's spans in ``words``, given places of its pieces."""
    starts = set()
    for offset, piece in found:
        for at in places(words, piece):
            begin = at - offset
            for s in range(max(1, begin - notice.edits), min(begin + notice.edits + 1, len(words))):
                if words[s - 1] == " " and words[s] != " ":
                    starts.add(s)
    hits = []
    for s in starts:
        # one character more than the longest match, so that the space after it can be seen
        hit = notice.pattern.match(words, s, min(len(words), s + len(notice.text) + notice.edits + 1))
        if hit and set(notice.must) <= set(hit.group().split()):
            hits.append((sum(hit.fuzzy_counts), s, hit.end()))
    kept: list[tuple[int, int, int]] = []  # in order; of overlapping spans, the one with fewest edits
    for edits, start, end in sorted(hits):
        at = bisect.bisect(kept, (start,))
        if (at == 0 or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
            kept.insert(at, (start, end, edits))
    return kept


def scan_text(text: bytes, phrases: list[tuple[bytes, str]], notices: list[Notice]) -> tuple:
    """One row of results without the id."""
    data, n_words = normal(text)
    at, base = [], set()
    for phrase, label in phrases:
        for place in places(data, phrase):
            at.append(place)
            base.add(label)
    spans, best, words = [], 1.0 if base else 0.0, None
    for notice in notices:
        found = [(offset, piece.decode()) for offset, piece in notice.seeds if piece in data]
        if not found:
            continue
        words = data.decode("utf-8", "replace") if words is None else words
        for start, end, edits in verified(words, notice, found):
            first = words.count(" ", 0, start) - 1
            inside = words[start:end]
            best = max(best, 1.0 - edits / len(notice.text))
            spans.append((notice.label, notice.text, first, first + inside.count(" "), edits, inside))
    labels = base | {s[0] for s in spans}
    starts = [data.count(b" ", 0, place + 1) - 1 for place in (min(at), max(at))] if at else [None, None]
    return (n_words, len(at), *starts, ",".join(sorted(base)), ",".join(sorted(labels)), best,
            [dict(zip(("label", "notice", "first_word", "last_word", "edits", "words"), s, strict=True))
             for s in spans])


def scan(docs: DataFrame, phrases: tuple = PHRASES, notices: tuple = NOTICES,
         chars_per_edit: int = CHARS_PER_EDIT, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, n_words, n_base, first_word, last_word, base_labels, labels, score and the
    spans of the notices found. No shuffle: every text is judged by itself."""
    result = T.StructType.fromDDL(RESULT)
    carry = tuple(c for c in carry if c not in result.names)
    source = docs.select(*carry, F.col("text").alias("_text"))
    schema = T.StructType([f for f in source.schema if f.name != "_text"] + result.fields)
    exact = [(f" {p} ".encode(), label) for p, label in phrases]
    fuzzy = [(label, text, must) for label, text, must in notices]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [Notice.of(*n, chars_per_edit) for n in fuzzy]
        for batch in batches:
            for part in pieces(batch, "_text"):
                texts = part.column(part.schema.get_field_index("_text")).cast(pa.large_binary())
                rows = [scan_text(t.as_py() or b"", exact, compiled) for t in texts]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in carry]
                    + [pa.array(list(c), k) for c, k in zip(columns, _ARROW, strict=True)],
                    schema.names)

    return for_python(source).mapInArrow(run, schema)


_ARROW = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
    pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()),
                        ("last_word", pa.int64()), ("edits", pa.int32()), ("words", pa.string())])),
]
