"""Language ID, weak labels, risk rules, URL filters, mixing, graph search."""

import binascii
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import texts as T
from tidemark.llm import byte_cnn, fair_mix, graph_search, redirects, risk_rules, weak_labels
from tidemark.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"


# ---- language ID ---------------------------------------------------------------------------------
WORDS = {"xx": "ka ki ku ko ke".split(), "yy": "zra zri zru zro zre".split(),
         "zz": "öm äm üm ém èm".split()}


def spoken(spark, n=60):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(WORDS[lang], k=2)) for _ in range(
            rng.randint(3, 120))), lang, "s", 0))
    return spark.createDataFrame(rows, T.SCHEMA)


def test_language_of_held_out_texts(spark):
    docs = spoken(spark)
    held = byte_cnn.held_out(F.col("doc_id"))
    model = byte_cnn.fit(docs, ~held, per_language=20)
    assert model.languages == sorted(WORDS)
    got = byte_cnn.predict(docs, model, ["doc_id", "lang"]).collect()
    assert all(r["lang"] == r["lang_pred"] and 0 <= r["score"] <= 1 for r in got)


def test_held_out_is_the_checksum(spark):
    ids = spark.range(200).withColumn("h", byte_cnn.held_out(F.col("id"))).collect()
    assert all(r["h"] == (binascii.crc32(str(r["id"]).encode()) % 4 == 2) for r in ids)


def test_language_of_odd_texts(spark):
    docs = T.documents(spark, T.odd_texts(), extra=True)
    model = byte_cnn.fit(docs, F.lit(True), per_language=5)
    got = byte_cnn.predict(docs, model, docs.columns)
    assert got.columns.count("score") == 1 and "key" in got.columns
    for r in got.collect():
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("a", "b") and 0 <= r["score"] <= 1
    assert byte_cnn.predict(docs.limit(0), model, ["doc_id"]).count() == 0
    unlabelled = byte_cnn.fit(docs, F.lit(False))
    assert unlabelled.languages == []
    assert {r["lang_pred"] for r in byte_cnn.predict(docs, unlabelled, ["doc_id"]).collect()} == {"und"}


def test_windows_cover_a_text_exactly():
    sizes = [0, 1, byte_cnn.WINDOW, byte_cnn.WINDOW + 1, 1000]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    start, length, owner = byte_cnn.cut_windows(np.zeros(offsets[-1], np.uint8), offsets)
    for i, size in enumerate(sizes):
        mine = owner == i
        spans = [x for s, n in zip(start[mine], length[mine], strict=True) for x in range(s, s + n)]
        assert spans == list(range(offsets[i], offsets[i] + size))


def test_gradients_match_differences(monkeypatch):
    monkeypatch.setattr(byte_cnn, "WINDOW", 12)
    rng = np.random.default_rng(0)
    total = byte_cnn.FILTERS * len(byte_cnn.WIDTHS)
    params = {"e": rng.normal(size=(256, byte_cnn.EMBEDDING)),
              "f": rng.normal(size=(byte_cnn.WIDTHS[-1] * byte_cnn.EMBEDDING, total)),
              "b": rng.normal(size=total), "d": rng.normal(size=(total, 3)) * 0.1, "c": np.zeros(3)}
    windows, labels = rng.integers(97, 110, (4, 12)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        _, z = byte_cnn._respond(params["e"], params["f"], windows)
        h = np.maximum(z.max(axis=1) + params["b"], 0)
        p = byte_cnn._softmax(h @ params["d"] + params["c"])
        return -np.log(p[np.arange(4), labels]).mean()

    grads = byte_cnn._gradients(params, windows, labels)
    for name in params:
        flat = np.argmax(np.abs(grads[name]))
        at = np.unravel_index(flat, grads[name].shape)
        old, step = params[name][at], 1e-6
        params[name][at] = old + step
        up = loss()
        params[name][at] = old - step
        down = loss()
        params[name][at] = old
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-7)


# ---- weak labels ---------------------------------------------------------------------------------
def test_em_finds_reliable_labellers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.8
    accuracy = [0.95, 0.9, 0.85, 0.6]
    votes = np.stack([np.where(rng.random(4000) < 0.2, weak_labels.NONE, np.where(
        rng.random(4000) < a, truth, ~truth).astype(int)) for a in accuracy], axis=1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    prior, table, good = weak_labels.fit_labellers(patterns, counts.astype(float))
    assert prior == pytest.approx(0.8, abs=0.05)
    found = table[:, 1, 1] / (table[:, 1, 0] + table[:, 1, 1])
    assert np.allclose(found, accuracy, atol=0.06)
    assert ((good[inverse.ravel()] > 0.5) == truth).mean() > 0.93


def test_quality_agrees_with_labels(spark):
    got = QUERIES["op2_weak_label_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = labels.join(got, "doc_id").select("quality", "kept").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.3


def test_quality_of_odd_texts(spark):
    docs = T.documents(spark, T.odd_texts(), extra=True)
    labelled = weak_labels.soft_labels(docs)
    scored = weak_labels.classify(labelled, weak_labels.fit(labelled, 5)).collect()
    assert len(scored) == docs.count()
    assert all(0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 for r in scored)
    assert all(r["score"] == 0 for r in scored if not r["text"])
    assert weak_labels.soft_labels(docs.limit(0)).count() == 0


# ---- risk rules ----------------------------------------------------------------------------------
def repeats(ws):
    places = defaultdict(list)
    for i in range(len(ws) - 2):
        places[tuple(ws[i:i + 3])].append(i)
    return len({i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)})


def test_counts_equal_brute_force(spark):
    texts = [*T.odd_texts(), "a b c a b c a", "x x x x", "a b a b a", "l\nl\n\nl\nm　\n m"]
    for r in risk_rules.measured(T.documents(spark, texts, extra=True)).collect():
        t = texts[r["doc_id"]] or ""
        ws = T.WORD.findall(t)
        ls = [x for x in t.split("\n") if T.WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)),
            repeats(ws))


@pytest.mark.parametrize("n, p", [(10, 0.3), (200, 0.05), (5000, 0.0125), (300000, 0.01)])
def test_binomial_bound_is_exact(spark, n, p):
    ks = sorted({0, 1, int(n * p / 2), int(n * p - math.sqrt(n * p)), int(n * p)})
    df = spark.createDataFrame([(k, n) for k in ks if k >= 0], "k long, n long")
    got = df.select("k", risk_rules.binomial_at_most(F.col("k"), F.col("n"), p).alias("x")).collect()
    for r in got:
        want = math.fsum(math.exp(
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
            + (n - i) * math.log(1 - p)) for i in range(r["k"] + 1))
        assert r["x"] == pytest.approx(want, rel=1e-6, abs=1e-290)


def test_cutoffs_keep_good_documents(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1200):  # good texts of language a have some symbols, those of b none; c is rare
        lang = "c" if i % 200 == 0 else "ab"[i % 2]
        text = T.sentence(rng, 60) + " #" * (4 if lang == "a" else 0)
        rows.append((i, text, lang, "s", 0))
    docs = spark.createDataFrame(rows, T.SCHEMA)
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    measures = risk_rules.with_measures(risk_rules.measured(docs))
    limits = {r["lang"]: r for r in risk_rules.cutoffs(measures, labels).collect()}
    assert limits["a"]["max_symbols_per_word"] == 0.1 and limits["b"]["max_symbols_per_word"] == 0.02
    assert limits["c"]["max_symbols_per_word"] is None  # too few labels certify nothing
    assert all(r["kept"] for r in risk_rules.judge(docs, labels).collect())
    junk = spark.createDataFrame([(9000, T.sentence(rng, 60) + " #" * 40, "a", "s", 0)], T.SCHEMA)
    judged = {r["doc_id"]: r["kept"] for r in risk_rules.judge(docs.union(junk), labels).collect()}
    assert not judged.pop(9000) and all(judged.values())


def test_rules_without_rows_or_labels(spark):
    docs = T.documents(spark, T.odd_texts(), extra=True)
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = risk_rules.judge(docs, labels).collect()
    assert len(got) == docs.count() and all(r["kept"] != r["base_failed"] for r in got)
    assert risk_rules.judge(docs.limit(0), labels.limit(0)).count() == 0


# ---- URL filters ---------------------------------------------------------------------------------
def canonical(url):
    return f'<html><link href="{url}" rel="canonical"></html>'


def test_decisions_reach_aliases(spark):
    pages = [
        (1, "http://bad.com/de/x", None),
        (2, "http://a.net/1", canonical("http://bad.com/de/x")),  # alias of a blocked URL
        (3, "https://www.a.net/1/?utm_source=x#top", None),  # another spelling of 2
        (4, "http://b.net/", '<meta http-equiv="refresh" content="0; url=//a.net/1">'),
        (5, "http://c.org/x", canonical("http://bad.com/de/x")),  # explicit allow, own
        (6, "http://d.net/", canonical("http://c.org/q")),  # alias of an allowed URL
        (7, "http://e.net/", canonical("http://f.com/de/only-a-target")),
        (8, "http://g.net/", canonical("/other")), (9, None, "x"), (10, "no scheme", None),
        (10, "no scheme", None), (None, "HTTP://SUB.Example.ORG/es/q?x#y", None),
        (11, "http://h.net/", canonical("http://bad.com/de/z")),
        (12, "http://h.net", canonical("http://ok.org/")),  # blocked and allowed aliases
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn(
        "rule", F.lit("clash")).withColumn("component", F.lit(1))
    got = redirects.judge(df, URL_RULES)
    rows = {r["page_id"]: r for r in got.collect()}
    assert got.count() == len(pages)
    verdicts = {i: rows[i]["verdict"] for i in range(1, 13)}
    assert verdicts == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow",
                        7: "block", 8: "allow", 9: "allow", 10: "allow", 11: "allow", 12: "allow"}
    r = rows[None]
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (
        "sub.example.org", "/es/q", "example.org/es/", "block")
    assert (rows[9]["host"], rows[9]["path"], rows[9]["rule"]) == ("", "", None)
    without = redirects.judge(df.filter("page_id < 5"), URL_RULES)  # nobody allows the group now
    assert {r["page_id"]: r["verdict"] for r in without.collect()} == dict.fromkeys(range(1, 5), "block")
    assert redirects.judge(df.limit(0), URL_RULES).count() == 0


def test_given_redirects_count(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a", None)], "page_id long, url string, html string")
    edges = spark.createDataFrame(
        [("http://x.net/a", "http://y.net/"), ("http://y.net/", "http://z.com/de/1")], "a string, b string")
    assert redirects.judge(pages, URL_RULES, edges).first()["verdict"] == "block"
    assert redirects.judge(pages, URL_RULES).first()["verdict"] == "allow"


# ---- mixing --------------------------------------------------------------------------------------
def brute_targets(sizes, weights=(1, 2, 3)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full, left = {}, set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        share = {s: (left - sum(3 * sizes[x] for x in full)) * weight[s] / sum(
            weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > 3 * sizes[s]}
        if not over:
            return {**{s: 3.0 * sizes[s] for s in full}, **share}
        full |= over


def test_mix_reaches_its_targets(spark, monkeypatch):
    monkeypatch.setattr(fair_mix, "ROWS_PER_BUCKET", 20)
    rng = random.Random(6)
    rows = [(i, T.sentence(rng, rng.randint(1, 12)), None, rng.choice(["a"] * 20 + ["b", "c", None]), 0)
            for i in range(900)] + [(1000, None, None, "d", 0), (1001, "", None, "e", 0)]
    docs = spark.createDataFrame(rows, T.SCHEMA).withColumn("rank", F.lit(1))
    got = fair_mix.mix(docs).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
    want = brute_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    assert sum(taken.values()) <= sum(sizes.values())
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 12
    again = {(r["doc_id"], r["taken"]) for r in fair_mix.mix(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}
    rows_out = fair_mix.mixed(docs).groupBy("doc_id").count().collect()
    assert {(r[0], r[1]) for r in rows_out} == {(r["doc_id"], r["copies"]) for r in got if r["copies"]}


def test_mix_of_odd_tables(spark):
    docs = T.documents(spark, T.odd_texts(), extra=True)
    assert fair_mix.mix(docs).count() == docs.count()
    assert fair_mix.mix(docs.limit(0)).count() == 0
    empty = T.documents(spark, [None, "", " "])
    assert [r["taken"] for r in fair_mix.mix(empty).collect()] == [0, 0, 0]
    twice = spark.createDataFrame([(1, "a b", None, "s", 0)] * 3 + [(None, "c d", None, "s", 0)], T.SCHEMA)
    got = fair_mix.mix(twice)
    assert got.agg(F.sum("taken")).first()[0] == 8 and got.count() == 4
    assert fair_mix.mixed(twice).count() == 4


# ---- graph search --------------------------------------------------------------------------------
def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    return good, lambda q, i: sorted(
        (float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in good if j != i and len(v) == len(q))[:k]


def test_search_finds_what_brute_force_finds(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "SHARD_ROWS", 400)
    monkeypatch.setattr(graph_search, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16)) * 3
    rows = [(i, (centres[i % 12] + rng.normal(size=16)).round(3).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[3][1]) for i in range(40)]  # one vector many times
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [math.nan] * 16), (5003, [None] * 16),
             (5004, [1.0] * 3), (5100, [2.0] * 3), (None, [1.0] * 16), (5005, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = graph_search.nearest(df, df.filter("vec_id % 100 = 0 or vec_id in (3, 5000, 5001)")).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["score"], r["vec_id"]))
    good, nearest = brute_nearest(rows, 10)
    vectors = dict(good)
    asked = [i for i, _ in good if i % 100 == 0 or i == 3]
    assert sorted(found) == sorted(asked)
    hits = 0
    for i in asked:
        want = nearest(vectors[i], i)
        hits += len({j for _, j in want} & {j for _, j in found[i]}) / max(1, len(want))
        assert found[i] == sorted(found[i]) and len(found[i]) == len(want)
    assert hits / len(asked) >= 0.95
    assert [j for _, j in found[3]] == list(range(2000, 2010))  # ties go to the least ids
    assert found[5100] == [(pytest.approx(math.sqrt(3)), 5004)]


def test_search_without_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert graph_search.nearest(df, df).count() == 0
    one = spark.createDataFrame([(100, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert graph_search.nearest(one, one).count() == 0
