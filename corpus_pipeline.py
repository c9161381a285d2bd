"""The corpus pipeline: language ID, line dedup, near-duplicate join, mixing, tokenising.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last
return the columns of documents, and the last one these and the ids. Other columns of the input are
dropped. Rows with a null id, null or empty texts, repeated rows and empty tables are handled as the
operators say: texts without letters go at the first stage, rows that repeat become one at the third.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_cnn, fair_mix, line_runs, ngram_join, piece_scan
from tidemark.llm.common import staged
from tidemark.llm.queries import MODEL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LANGUAGES: tuple[str, ...] = ()  # if any are stated, texts judged to be of another one go


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and, if languages are stated, texts of others. The judged language
    becomes the language of a document that states none, in this and all later stages; a stated one stays.
    Where no language was learned, all texts with a letter pass."""
    model = byte_cnn.fit(docs, ~byte_cnn.held_out(F.col("doc_id")))
    if not model.languages:
        return byte_cnn.with_letters(docs.select(*COLUMNS))
    judged = byte_cnn.predict(docs, model, COLUMNS)
    wanted = F.col("lang_pred").isin(*LANGUAGES) if LANGUAGES else F.lit(True)
    return judged.filter((F.col("lang_pred") != byte_cnn.NO_LANGUAGE) & wanted).withColumn(
        "lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs, one long line included; a document that loses all
    its lines goes."""
    found = line_runs.dedup_lines(docs.select(*COLUMNS), min_words=line_runs.MIN_WORDS)
    return found.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(
            F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays."""
    return ngram_join.one_of_each(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return fair_mix.mixed(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their text."""
    return piece_scan.encode(docs.select(*COLUMNS), piece_scan.load_pieces(MODEL))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("mixing", mixing),
    ("sentencepiece", tokens),
]

ORACLE_SQL = None  # the learned language model and the tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
