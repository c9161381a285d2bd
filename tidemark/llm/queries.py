"""The registered queries of the text operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_cnn, fair_mix, graph_search, license_scan, line_runs, lz_dedup, ngram_join, orchard,
    piece_scan, redirects, resampling, risk_rules, weak_labels,
)
from tidemark.llm.common import words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = piece_scan.load_pieces(MODEL)
    return piece_scan.decode(piece_scan.encode(docs, model), model).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        piece_scan.same_text(F.col("text"), F.col("decoded")).alias("round_trip"))


@query
def op2_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = weak_labels.soft_labels(docs)
    scorer = weak_labels.fit(labelled)
    return weak_labels.classify(labelled.select("doc_id", "text", "posterior"), scorer).select(
        "doc_id", "posterior", "score", (F.col("score") >= 0.5).alias("kept"))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(_table(spark, sf_dir, "documents"))


@query
def op4_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lz_dedup.dedup_texts(docs)
    kept = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(
        F.array_join(words(F.col("text")), " "))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


SQL["op4_lz_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS pos, ws FROM docs WHERE len(ws) >= 20),
windows AS (
  SELECT doc_id, pos, md5(array_to_string(ws[pos:pos + 19], ' ')) AS run FROM starts),
again AS (
  SELECT doc_id, pos FROM windows
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1),
gone AS (
  SELECT DISTINCT doc_id, pos + o AS pos FROM again, (SELECT unnest(range(0, 20)) AS o)),
lists AS (SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.pos) AS text
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM docs) w
  ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos GROUP BY w.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs d LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL["op5_line_dedup"] = line_runs.dedup_sql()


@query
def op5_long_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op5_line_dedup, and a repeated line of MIN_WORDS words is a run by itself."""
    return line_runs.dedup_lines(
        _table(spark, sf_dir, "documents"), min_words=line_runs.MIN_WORDS).select(
        "doc_id", "n_lines", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL["op5_long_line_dedup"] = line_runs.dedup_sql(min_words=line_runs.MIN_WORDS)


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = byte_cnn.held_out(F.col("doc_id"))
    model = byte_cnn.fit(docs, ~held_out)
    return byte_cnn.predict(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_rules.judge(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


SQL["op7_risk_rules"] = risk_rules.judge_sql()

URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@query
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.judge(_table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


SQL["op8_url_filters"] = redirects.judge_sql(URL_RULES)


@query
def op9_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_search.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


@query
def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


SQL["op10_fair_mix"] = fair_mix.mix_sql()


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


SQL["op11_importance_resampling"] = resampling.resample_sql()


@query
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(_table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


SQL["op12_centroid_clustering"] = orchard.cluster_sql()


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.transform("spans", lambda s: F.concat_ws(
            ":", s["label"], s["first_word"], s["last_word"], s["edits"])).alias("found"))
