"""License scans against a plain search by edit distances."""

import functools
import random
import re

import pytest

from tests.llm import texts as T
from tidemark.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}
KEYS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def plain_base(text):
    w = WORD.findall((text or "").translate(UPPER))
    at, labels = [], set()
    for phrase, label in L.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return w, at, labels


def edit_ends(notice, text):
    """Distance of the notice from every beginning of ``text``."""
    row = list(range(len(notice) + 1))
    out = [row[-1]]
    for ch in text:
        new = [row[0] + 1]
        for j, p in enumerate(notice, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (p != ch)))
        row = new
        out.append(row[-1])
    return out


@functools.cache
def plain(text):
    w, at, base = plain_base(text)
    labels, score = set(base), 1.0 if base else 0.0
    for label, notice, must in L.NOTICES:
        allowed = len(notice) // L.CHARS_PER_EDIT
        for i in range(len(w)):
            rest, ends = " ".join(w[i:]), []
            reach = rest[:len(notice) + allowed + 1]
            for end, d in enumerate(edit_ends(notice, reach)):
                if d <= allowed and end and reach[end - 1] != " " and (end == len(rest) or rest[end] == " "):
                    ends.append((d, end))
            if ends:
                fewest = min(ends)[0]
                found = [reach[:e] for d, e in ends if d == fewest]
                if any(set(must) <= set(f.split()) for f in found):
                    labels.add(label)
                    score = max(score, 1 - fewest / len(notice))
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


def edited(rng, notice, n):
    s = list(notice)
    for _ in range(n):
        i = rng.randrange(len(s))
        s[i] = rng.choice([s[i] + rng.choice("abcxyz "), rng.choice("abcxyz"), ""])
    return "".join(s)


def planted(seed=1, n=90):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        _, notice, _ = rng.choice(L.NOTICES)
        body = edited(rng, notice, rng.choice([0, 0, 1, 1, 2, 3, len(notice) // 10, len(notice) // 10 + 2]))
        if rng.random() < 0.4:
            body = body.title().replace(" ", rng.choice([" ", ", ", "\n * "]))
        out.append(f"{T.sentence(rng, rng.randint(0, 12))} {body} {T.sentence(rng, rng.randint(0, 9))}")
    return out


def got(df):
    return [tuple(r[k] for k in KEYS) for r in df.orderBy("doc_id").collect()]


def test_planted_notices_equal_the_plain_search(spark):
    texts = planted()
    rows = got(L.scan(T.documents(spark, texts)))
    wrong = [(t, a, plain(t)) for t, a in zip(texts, rows, strict=True) if a != pytest.approx(plain(t))]
    assert not wrong
    assert sum(bool(r[5]) for r in rows) > 40 and sum(not r[5] for r in rows) > 5


def test_odd_texts_and_clashing_names(spark):
    texts = [*(t for t in T.odd_texts() if len(t or "") < 2000), "under the MIT license", "Under the MIT-license. cc by nc cc by nc CC BY NC",
             "Apache License, Version 2.0 apache license version 20", "xunder the mit license", "cc by nd"]
    df = T.documents(spark, texts, extra=True)
    out = L.scan(df, carry=("doc_id", "n_words", "source"))
    assert out.columns == ["doc_id", "source", *KEYS, "spans"]
    assert got(out) == [pytest.approx(plain(t)) for t in texts]
    assert L.scan(df.limit(0)).count() == 0
    assert got(L.scan(df.unionByName(df))) == [pytest.approx(plain(t)) for t in texts for _ in range(2)]


def test_words_that_tell_licenses_apart(spark):
    texts = ["under the mpl license", "apache license version 1", "apache licence version 2",
             "gnu lesser general public license", "this is fre and unencumbered sofware released into the public domain"]
    assert [r[5] for r in got(L.scan(T.documents(spark, texts)))] == ["", "", "apache-2", "lgpl", "unlicense"]


def test_spans_say_where_and_how_far(spark):
    text = "Some words, then: Permission is hereby granted, free of charge, to any persn obtaining a copy of this software!"
    span = L.scan(T.documents(spark, [text])).first()["spans"][0]
    assert (span["label"], span["first_word"], span["last_word"], span["edits"]) == ("mit", 3, 18, 1)
    assert span["words"].split()[-7:] == "persn obtaining a copy of this software".split()


def test_a_very_long_text_is_searched_whole(spark):
    rng = random.Random(3)
    filler = T.sentence(rng, 60_000)
    text = f"{filler} redistribution and use in source and binary form with or without modification are permitted {filler} cc by nc"
    r = L.scan(T.documents(spark, [text, "x" * 300_000])).orderBy("doc_id").first()
    assert (r["n_words"], r["first_word"], r["labels"]) == (120_017, 120_014, "bsd,cc-by-nc")
