"""SentencePiece scan against the library; the pipeline against a plain version."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import texts as T
from tests.llm.test_pairs_and_spans import brute_join, brute_lines
from tidemark.llm import byte_cnn, fair_mix, line_runs, piece_batch, piece_scan
from tidemark.llm.queries import MODEL, QUERIES, SQL

PARTS = [" ", "  ", "a", "b", "the", "ing", "er", "\n", "日", "本", "☃", "é", "Z", "0", "12", ".", ",",
         "qu", "    ", "\t", *"ethanior"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return piece_scan.load_pieces(MODEL)


def plain(model, text):
    return np.frombuffer(piece_scan.encode_words(model, piece_scan.normal(text)), np.int32).tolist()


def test_words_equal_the_library(library, model):
    rng = random.Random(1)
    for _ in range(800):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 60)))
        assert plain(model, text) == library.encode(text)


def test_pairs_equal_merging(model):
    rng = random.Random(2)
    pieces = [p for p in rng.sample(sorted(model.ids), 400) if piece_scan.merge(model, p) == [p]]
    for _ in range(4000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        assert piece_scan._apart(model, a, b) == (piece_scan.merge(model, a + b) == [a, b])


def matrices(model, text, chunk):
    text = piece_scan.normal(text)
    cuts = [*range(0, len(text), chunk), len(text)]
    return text, cuts, [piece_scan.transfer(model, text, a, b)
                        for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 16, 17, 33])
def test_chunks_equal_the_whole(model, chunk):
    rng = random.Random(chunk)
    for k in range(120):
        text = "".join(rng.choices(PARTS, k=rng.randint(1, 90)))
        if k % 3 == 0:
            text = text.replace(" ", "") or "x"
        whole, cuts, steps = matrices(model, text, chunk)
        states = piece_scan.scan(steps)
        got = b"".join(piece_scan.trace(model, whole, a, b, *s) for a, b, s in zip(
            cuts[:-1], cuts[1:], states, strict=True))
        assert np.frombuffer(got, np.int32).tolist() == plain(model, text)


def test_products_are_associative(model):
    _, _, steps = matrices(model, "the thin thing " * 6, 7)
    a, b, c = (set(m) for m in steps[2:5])
    left = piece_scan.combine(piece_scan.combine(a, b), c)
    assert left == piece_scan.combine(a, piece_scan.combine(b, c)) and left


def test_states_through_the_tree_equal_one_scan(spark, model):
    docs = {1: "the thin thing " * 40, 2: "nospaces" * 70, 3: "日本語 x" * 9, 4: "a"}
    rows, want = [], {}
    for i, t in docs.items():
        text, cuts, steps = matrices(model, t, 11)
        want[i] = piece_scan.scan(steps)
        rows += [(i, len(t), k, [(*a, *b) for a, b in m]) for k, m in enumerate(steps)]
    df = spark.createDataFrame(rows, f"{piece_scan._AT} steps {piece_scan._STEPS}").repartition(3)
    most = max(map(len, want.values()))
    assert most > piece_scan.SEGMENT ** 2  # three levels and more
    got = {}
    for r in piece_scan.cut_states(df, most).orderBy("_doc", "k").collect():
        got.setdefault(r["_doc"], []).append(((r["a"], r["o"]), (r["a2"], r["o2"])))
    assert got == want


@pytest.mark.parametrize("chunk", [50, 10_000])
def test_tables_equal_the_library_and_come_back(spark, library, model, chunk):
    texts = [*T.odd_texts(), "nospaces" * 400, "日本語" * 300, " lead and  gaps ", T.odd_texts()[10]]
    docs = T.documents(spark, texts, extra=True)
    encoded = piece_scan.encode(docs, model, chunk=chunk)
    assert encoded.columns.count("ids") == 1 and "key" in encoded.columns
    rows = piece_scan.decode(encoded, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["decoded"] == text
        assert r["ids"] == (None if text is None else library.encode(text))
    assert piece_scan.encode(docs.limit(0), model).count() == 0


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op1_sentencepiece"](spark, sf).collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]]) and r["round_trip"]
        assert r["n_ids"] == len(r["ids"])


def test_stages_equal_a_plain_version(spark, library, monkeypatch):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, sf), "test-stage")
        if name != "sentencepiece":
            assert out.columns == corpus_pipeline.COLUMNS
        kept[name] = out.orderBy("doc_id").collect()
        docs = out
    held = ~byte_cnn.held_out(F.col("doc_id"))
    source = spark.read.parquet(f"{sf}/documents.parquet")
    judged = byte_cnn.predict(source, byte_cnn.fit(source, held), ["doc_id"]).filter(
        "lang_pred <> 'und'")
    first = kept["language ID"]
    assert [r["doc_id"] for r in first] == sorted(r[0] for r in judged.select("doc_id").collect())
    lettered = [i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")]
    assert [r["doc_id"] for r in first] == sorted(lettered)  # every document with a letter stays
    assert all(r == rows[r["doc_id"]] for r in first)

    lines, gone = brute_lines([r["text"] for r in first], 2)
    for i, again in enumerate(brute_lines([r["text"] for r in first], 1)[1]):
        gone[i] |= {k for k in again if len(T.WORD.findall(lines[i][k])) >= line_runs.MIN_WORDS}
    want = []
    for r, ls, g in zip(first, lines, gone, strict=True):
        text = "\n".join(x for k, x in enumerate(ls) if k not in g) if g else r["text"]
        if not g or len(g) < len(ls):
            want.append((r["doc_id"], text, len(text) if g else r["n_chars"]))
    second = kept["line dedup"]
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in second] == want

    found = brute_join([r["text"] for r in second])
    third = kept["near duplicates"]
    assert third == [r for i, r in enumerate(second) if found[i][0] == 0 or found[i][1] == i]

    copies = {r["doc_id"]: r["copies"] for r in fair_mix.mix(spark.createDataFrame(
        third, source.schema)).collect()}
    assert [r["doc_id"] for r in kept["mixing"]] == [
        r["doc_id"] for r in third for _ in range(copies[r["doc_id"]])]

    assert [(r["doc_id"], r["ids"]) for r in kept["sentencepiece"]] == [
        (r["doc_id"], library.encode(r["text"])) for r in kept["mixing"]]


WORDS = {
    "de": "der die und nicht ist auch eine wird mit durch Haus Wasser schnell immer".split(),
    "en": "the and not is also with through house water quick always this that".split(),
    "fr": "les des est pas aussi une avec pour maison eau vite toujours cette que".split(),
    "es": "los del es no tambien una con para casa agua siempre esta que muy".split(),
    "it": "gli della non anche con per casa acqua sempre questa che molto sono".split(),
}


@pytest.mark.parametrize("labelled", [True, False])
def test_no_clean_document_is_rejected(spark, labelled):
    rng = random.Random(6)
    rows = []
    for lang, words in WORDS.items():
        other = WORDS[rng.choice([x for x in WORDS if x != lang])]
        for _ in range(40):
            rows.append((lang, " ".join(rng.choices(words, k=60))))
        for _ in range(15):  # short, and half of another language
            rows.append((lang, rng.choice(words)))
            rows.append((lang, " ".join(rng.choices(words, k=30) + rng.choices(other, k=30))))
    bad = [None, "", " 12 + 3 ", "###$$$"]
    table = [(i, t, lang if labelled else None, "s", len(t)) for i, (lang, t) in enumerate(rows)]
    table += [(len(rows) + i, t, None, "s", 0) for i, t in enumerate(bad)]
    docs = spark.createDataFrame(table, T.SCHEMA)
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(map(tuple, kept.collect())) == table[:len(rows)]
    if labelled:  # the former threshold lost some of them
        model = byte_cnn.fit(docs, ~byte_cnn.held_out(F.col("doc_id")))
        assert byte_cnn.predict(docs, model, ["doc_id"]).filter(
            "lang_pred <> 'und' and score < 0.5").count() > 0


def test_languages_outside_the_list_go(spark, monkeypatch):
    rows = [(i, " ".join(WORDS[x] * 6), x, "s", 9) for i, x in enumerate(["de", "fr"] * 20)]
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ("de",))
    kept = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, T.SCHEMA), "")
    assert {r["lang"] for r in kept.collect()} == {"de"}


def test_the_judged_language_goes_on_where_none_is_stated(spark):
    langs = ["de", "fr"] * 20
    rows = [(i, " ".join(WORDS[x] * 6 + [f"w{i}"]), x if i % 5 else None, "s", 9) for i, x in enumerate(langs)]
    docs = spark.createDataFrame(rows, T.SCHEMA)
    found = corpus_pipeline.language_id(spark, docs, "")
    assert sorted((r["doc_id"], r["lang"]) for r in found.collect()) == list(enumerate(langs))
    later = corpus_pipeline.line_dedup(spark, found, "")
    assert {r["lang"] for r in later.collect()} == {"de", "fr"}


def test_pipeline_takes_odd_and_empty_tables(spark, tmp_path):
    docs = T.documents(spark, [*T.odd_texts(), *T.near_copies(3, 3, 6)], extra=True)
    docs = docs.union(docs.filter("doc_id in (0, 3, 6)")).withColumn(
        "doc_id", F.when(F.col("doc_id") != 4, F.col("doc_id")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*corpus_pipeline.COLUMNS, "ids"]
    assert out.filter("text is null or ids is null").count() == 0
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_queries_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(SQL) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "near duplicates", "mixing", "sentencepiece"]


# ---- words side by side --------------------------------------------------------------------------
def test_words_side_by_side_equal_the_library(model, library):
    rng = random.Random(11)
    letters = "abcdefgh theinrs.,'ABC-öé日本☃▁0129\n\t"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 90))) for _ in range(300)] + ["x" * 63, "y" * 64, "é" * 65]
    words = set().union(*[piece_scan._WORD.findall(piece_scan.normal(t)) for t in texts])
    piece_scan.learn(model, words)
    for t in texts:
        assert plain(model, t) == library.encode(t)
    model.words.clear()
    for w in sorted(words)[::7]:
        alone = piece_scan.encode_word(model, w)
        assert model.paths.encode([w]).get(w, alone) == alone


def test_words_are_cut_where_no_piece_joins(model, library):
    """Words that differ only in what stands behind them are one word, encoded once."""
    model.words.clear()
    model.older.clear()
    texts = [f"thoureen{end}" for end in (".", ",", "***", "!!", ".\n\n", " ", "")]
    words = [model.word.findall(piece_scan.normal(t)) for t in texts]
    assert ["".join(w) for w in words] == [piece_scan.normal(t) for t in texts]
    piece_scan.learn(model, set().union(*words))
    assert sum("thoureen" in w for w in model.words) == 1
    for t in texts + ["  a" + " " * 300 + ".  ", "日本。\tx" + " " * 300]:
        assert plain(model, t) == library.encode(t)


def test_a_cut_at_the_beginning_of_a_word_needs_no_scan_of_the_chunk(model, monkeypatch):
    text = piece_scan.normal("the thin thing " * 400)
    cut = text.index(piece_scan.MARK, 3000)
    steps = []
    ends = piece_scan._ends
    monkeypatch.setattr(piece_scan, "_ends", lambda m, t, start, before, stop: steps.append(
        stop - start) or ends(m, t, start, before, stop))
    matrices = [piece_scan.transfer(model, text, 0, cut), piece_scan.transfer(model, text, cut, len(text))]
    states = piece_scan.scan(matrices)
    got = b"".join(piece_scan.trace(model, text, a, b, *s) for (a, b), s in zip(
        [(0, cut), (cut, len(text))], states, strict=True))
    assert got == piece_scan.encode_words(model, text)
    assert max(steps) < 100


def test_the_states_of_cuts_are_found_in_many_tasks(spark, model):
    """Behind the join with the states from above the rows lie where the groups need them, in all tasks."""
    rows = []
    for doc in range(40):
        _, _, steps = matrices(model, "the thin thing " * 8, 11)
        rows += [(doc, 120, k, [(*a, *b) for a, b in m]) for k, m in enumerate(steps)]
    df = spark.createDataFrame(rows, f"{piece_scan._AT} steps {piece_scan._STEPS}")
    states = piece_scan.cut_states(df, 11)
    assert states.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert states.count() == len(rows)


def test_lists_are_decoded_side_by_side(model):
    import pyarrow as pa
    lists = [[], None, [model.byte_ids[0xC3], 5], [*range(300, 340)], [-1], None, []]
    got = piece_scan.decode_lists(model, pa.array([[1], *lists], pa.list_(pa.int32())).slice(1))
    for ids, text in zip(lists, got, strict=True):
        raw = None if ids is None else b"".join(model.decoded[i] for i in ids)
        assert text == (None if raw is None else raw.removeprefix(b" ").decode("utf-8", "replace"))


def test_numbers_by_key():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 63, 30_000, dtype=np.uint64))
    table = piece_batch.Numbers(4)
    for part in np.array_split(keys, 7):
        table.put(part, part.astype(np.int64) >> 1)
    assert (table.get(keys) == keys.astype(np.int64) >> 1).all()
    assert (table.get(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == piece_batch._NONE).all()


def test_a_model_is_shared_by_the_tasks_of_a_worker(model):
    import pickle
    one, two = (pickle.loads(pickle.dumps(model)) for _ in range(2))
    assert one is two and one.ids == model.ids
