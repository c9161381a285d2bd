"""Near-duplicate join, substring dedup, line dedup, components."""

import hashlib
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm import texts as T
from tidemark.llm import line_runs, lz_dedup, ngram_join
from tidemark.llm.common import from_planes
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES, SQL


def shingles(text):
    ws = T.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(ws) >= 5:
        return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}
    return {tuple(ws)} if ws else set()


def classes(ids, linked):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def brute_join(texts):
    sets = [shingles(t) for t in texts]
    n = range(len(sets))
    links = [(i, j) for i in n for j in n if i < j and sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    found = classes(n, links)
    return {i: (len(sets[i]), found[i]) for i in n}


def joined(spark, texts, **options):
    df = ngram_join.join_documents(T.documents(spark, texts, extra=True), **options)
    assert df.columns[:3] == ["doc_id", "n_shingles", "component_id"]
    return {r[0]: (r[1], r[2]) for r in df.collect()}


def test_join_equals_brute_force(spark):
    texts = T.odd_texts() + T.near_copies()
    assert joined(spark, texts) == brute_join(texts)


def brute_links(texts):
    sets = [shingles(t) for t in texts]
    return {i: sum(bool(a) and i != j and 100 * len(a & b) >= 75 * len(a | b)
                   for j, b in enumerate(sets)) for i, a in enumerate(sets)}


@pytest.mark.parametrize("block", [None, 150])
def test_links_of_every_document_are_counted(spark, monkeypatch, block):
    if block:  # components in several blocks
        monkeypatch.setattr(ngram_join, "_PAIR_BLOCK", block)
        monkeypatch.setattr(ngram_join, "_SET_COST", 0)
    texts = T.odd_texts() + T.near_copies(seed=8, groups=3, size=25)
    texts += texts[-7:] + texts[-7:-4]
    want = brute_links(texts)
    got = ngram_join.join_documents(T.documents(spark, texts, extra=True))
    assert {r["doc_id"]: r["n_links"] for r in got.collect()} == want
    assert len(set(want.values())) > 3


@pytest.mark.parametrize("share", [1, 2, 8, 10**9])
def test_links_in_strips_of_rare_and_frequent_tokens(monkeypatch, share):
    monkeypatch.setattr(ngram_join, "_DENSE_SHARE", share)
    monkeypatch.setattr(ngram_join, "_CELLS", 100)
    rng = random.Random(share)
    sets = [set(rng.sample(range(18), rng.randint(9, 17))) for _ in range(60)]
    table = pd.DataFrame({
        "key": range(60), "n": [len(s) for s in sets], "weight": [rng.randint(1, 4) for _ in sets],
        "tokens": [np.array(sorted(s), dtype=np.uint64).tobytes() for s in sets]})
    probes, targets = table[25:], table[:35]

    def want(mine, others):
        return [sum(int(table["weight"][j]) for j in others.index if i != j and 100 * len(
            sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])) for i in mine.index]

    of_probes, of_targets = ngram_join._weights_of_links(probes, targets, 75)
    assert of_probes.tolist() == want(probes, targets)
    assert of_targets.tolist() == want(targets, probes) and any(of_targets)


def test_links_of_the_query_are_counted(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op3_ngram_join"](spark, sf).collect()
    assert {r["doc_id"]: r["n_links"] for r in got} == brute_links([texts[i] for i in range(len(texts))])


def test_links_of_rows_without_id(spark):
    rows = spark.createDataFrame(
        [(None, "a b c d e f"), (4, "a b c d e f"), (None, None), (4, "a b c d e f")],
        "doc_id long, text string")
    got = ngram_join.join_documents(rows).select("n_shingles", "n_links").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (2, 2), (2, 2), (2, 2)]


def test_join_in_many_blocks(spark, monkeypatch):
    # tiny blocks: every step deals its sets over several tasks
    monkeypatch.setattr(ngram_join, "_BLOCK", 150)
    monkeypatch.setattr(ngram_join, "_RANGE", 200)
    monkeypatch.setattr(ngram_join, "_FLUSH", 300)
    texts = T.near_copies(seed=8, groups=3, size=25)
    assert joined(spark, texts) == brute_join(texts)


@pytest.mark.parametrize("shared, linked", [(6, True), (5, False)])
def test_join_at_the_threshold(spark, shared, linked):
    # sets of 7 shingles: 6 shared of 8 is 75 %, 5 of 9 is not
    base = [f"w{i}" for i in range(11)]
    other = base[:shared + 4] + [f"v{i}" for i in range(7 - shared)]
    got = joined(spark, [" ".join(base), " ".join(other)])
    assert (got[0][1] == got[1][1]) == linked


def test_join_without_documents_or_ids(spark):
    assert joined(spark, []) == {}
    rows = spark.createDataFrame(
        [(None, "a b c d e f"), (4, "a b c d e f"), (None, None), (4, "a b c d e f")],
        "doc_id long, text string")
    got = ngram_join.join_documents(rows).collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == [
        ("4", 2, 4), ("4", 2, 4), ("None", 0, None), ("None", 2, 4)]
    assert ngram_join.one_of_each(rows).count() == 2


def test_one_of_each(spark):
    texts = T.odd_texts() + T.near_copies()
    want = brute_join(texts)
    kept = {r[0] for r in ngram_join.one_of_each(T.documents(spark, texts)).collect()}
    assert kept == {i for i, (n, c) in want.items() if i == c or n == 0}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    pairs += [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(50)]
    rng.shuffle(pairs)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == classes(nodes, [p for p in pairs if p[0] != p[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_windows(texts, size):
    words = [T.WORD.findall(t or "") for t in texts]
    first, gone = {}, [set() for _ in texts]
    for i, ws in enumerate(words):
        for s in range(len(ws) - size + 1):
            if first.setdefault(tuple(ws[s:s + size]), (i, s)) != (i, s):
                gone[i].update(range(s, s + size))
    return words, gone


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_substring_dedup_equals_brute_force(spark, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(lz_dedup, "_FLUSH", 40)
    rng = random.Random(seed)
    passages = [T.sentence(rng, rng.randint(18, 70)) for _ in range(4)]
    texts = T.odd_texts() + T.near_copies(seed, 3, 5)
    for _ in range(25):
        p = rng.choice(passages).split()
        a = rng.randrange(len(p))
        texts.append(" ".join([T.sentence(rng, rng.randint(0, 30)), *p[a:], *rng.choice(
            passages).split()[:rng.randint(1, 60)], T.sentence(rng, 9)]))
    words, gone = brute_windows(texts, 20)
    got = lz_dedup.dedup_texts(T.documents(spark, texts, extra=True)).collect()
    assert len(got) == len(texts)
    for r in got:
        i = r["doc_id"]
        assert (r["n_words"], r["n_removed"]) == (len(words[i]), len(gone[i]))
        if gone[i]:
            assert r["text"] == " ".join(w for k, w in enumerate(words[i]) if k not in gone[i])
        else:
            assert r["text"] == texts[i]
        for f in r["factors"]:  # every factor really stands at its reference
            assert words[i][f["at"]:f["at"] + f["size"]] == words[f["ref_doc"]][
                f["ref_at"]:f["ref_at"] + f["size"]]


def test_factors_grow_along_their_reference():
    spans = [(0, 20, 5, 100), (1, 20, 5, 101), (3, 25, 5, 103), (10, 20, 6, 0), (40, 22, 5, 140)]
    assert lz_dedup.parse(spans) == [(0, 28, 5, 100), (10, 20, 6, 0), (40, 22, 5, 140)]


def test_substring_dedup_of_rows_without_id(spark):
    text = T.sentence(random.Random(3), 40)
    rows = spark.createDataFrame([(None, text), (1, text), (1, text)], "doc_id long, text string")
    got = lz_dedup.dedup_texts(rows).select("doc_id", "n_removed").collect()
    assert sorted((str(r[0]), r[1]) for r in got) == [("1", 40), ("1", 40), ("None", 0)]
    assert lz_dedup.dedup_texts(rows.limit(0)).count() == 0


def brute_lines(texts, size):
    lines = [[x for x in (t or "").split("\n") if T.WORD.search(x)] for t in texts]
    first, gone = {}, [set() for _ in texts]
    for i, ls in enumerate(lines):
        for s in range(len(ls) - size + 1):
            if first.setdefault(tuple(ls[s:s + size]), (i, s)) != (i, s):
                gone[i].update(range(s, s + size))
    return lines, gone


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_line_dedup_equals_brute_force(spark, size):
    rng = random.Random(size)
    pool = [f"line {i}" for i in range(6)]
    texts = T.odd_texts() + ["\n".join(rng.choices([*pool, "", f"own {k}"], k=rng.randint(1, 20)))
                             for k in range(40)]
    lines, gone = brute_lines(texts, size)
    got = line_runs.dedup_lines(T.documents(spark, texts, extra=True), size).collect()
    assert len(got) == len(texts)
    for r in got:
        i = r["doc_id"]
        assert (r["n_lines"], r["n_removed"]) == (len(lines[i]), len(gone[i]))
        assert r["text"] == ("\n".join(x for k, x in enumerate(lines[i]) if k not in gone[i])
                             if gone[i] else texts[i])


def test_repeated_long_lines_go(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    texts = [r[1] for r in rows.collect()]
    lines, gone = brute_lines(texts, 2)
    for i, single in enumerate(brute_lines(texts, 1)[1]):
        gone[i] |= {k for k in single if len(T.WORD.findall(lines[i][k])) >= 20}
    assert sum(map(len, gone)) > sum(map(len, brute_lines(texts, 2)[1]))
    got = QUERIES["op5_long_line_dedup"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in got} == {
        i: (len(lines[i]), len(g)) for i, g in enumerate(gone)}
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(map(tuple, got)) == sorted(duck.sql(SQL["op5_long_line_dedup"]).fetchall())


def test_a_long_line_alone_goes_and_a_short_one_stays(spark):
    long, short = T.sentence(random.Random(4), 25), "see also"
    texts = [long, f"own\n{long}\nmore", long, f"{short}\nx", f"{short}\ny"]
    got = line_runs.dedup_lines(T.documents(spark, texts), min_words=20).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {
        0: long, 1: "own\nmore", 2: "", 3: texts[3], 4: texts[4]}


def test_line_dedup_without_rows_or_ids(spark):
    rows = spark.createDataFrame([(None, "a\nb"), (1, "a\nb"), (1, "a\nb")],
                                 "doc_id long, text string")
    got = line_runs.dedup_lines(rows).select("doc_id", "text").collect()
    assert sorted((str(r[0]), r[1]) for r in got) == [("1", ""), ("1", ""), ("None", "a\nb")]
    assert line_runs.dedup_lines(rows.limit(0)).count() == 0


def test_queries_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy(
        "doc_id").collect()
    assert [r[0] for r in docs] == list(range(len(docs)))
    texts = [r[1] for r in docs]
    got = QUERIES["op3_ngram_join"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_join(texts)
    words, gone = brute_windows(texts, 20)
    for r in QUERIES["op4_lz_dedup"](spark, sf).collect():
        i = r["doc_id"]
        kept = " ".join(w for k, w in enumerate(words[i]) if k not in gone[i])
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (
            len(words[i]), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest())
    lines, gone = brute_lines(texts, 2)
    counts = {r["doc_id"]: r["n_removed"] for r in QUERIES["op5_line_dedup"](spark, sf).select(
        "doc_id", F.col("n_removed")).collect()}
    assert counts == {i: len(g) for i, g in enumerate(gone)}


# ---- routing -------------------------------------------------------------------------------------
def test_a_task_that_runs_again_sends_its_rows_to_the_same_groups(spark, tmp_path):
    path = str(tmp_path / "docs")
    texts = T.near_copies(groups=3, size=6) + ["the same words again and again in this text " * 4] * 30
    T.documents(spark, texts).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    plain = ngram_join._token_ranges(docs, 8, np.zeros(0, np.uint64)).collect()
    frequent = np.unique(np.concatenate([from_planes(bytes(r["tokens"]), np.uint64) for r in plain]))[::9]
    once, again = ([sorted((r["part"], bytes(r["tokens"]), bytes(r["keys"])) for r in ngram_join._token_ranges(
        docs, 8, frequent).collect()) for _ in range(2)])
    assert once == again and max(r[0] for r in once) >= 8

    def tables(order):
        n = np.arange(order.size)
        t = lz_dedup._table((order % 7).astype(np.uint64) << np.uint64(40), order.astype(np.uint64), order, order, n * 0, 9)
        return iter([t])

    def routed(order):
        out = []
        for b in lz_dedup._combined(tables(order), 8):
            out += [(r["part"], len(r["doc"])) for r in b.to_pylist()]
        return sorted(out)

    rows = np.arange(500)
    assert routed(rows) == routed(rows) == routed(rows[::-1].copy())
