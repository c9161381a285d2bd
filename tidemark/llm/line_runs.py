"""Line dedup: repeated runs of lines found by prefix doubling over sequences of line ids.

Every line with a word gets an id, its place in the order of line digests. The suffixes of all line
sequences are then ordered by their first 1, 2, 4, ... lines: a suffix's rank for twice the length
comes from the pair (own rank, rank that many lines on). Suffixes that no other shares at a length
have no repeated run of that length and take no further part, so the work shrinks from round to round.
Suffixes of equal rank at a length are one interval of the suffix array in which the longest common
prefix is at least that long. Each interval of ``min_lines`` keeps its first suffix (smallest id,
then smallest line number); the lines that the later ones start with are deleted. The union of those
lines is every later copy of every maximal repeated run.

With ``min_words`` a repeated line of at least that many words also is a run by itself: later copies
of it are deleted wherever they stand. Without it a repeated passage of one line stays.

Defined cases: a null text stays null; lines without a word are never part of a run, and are dropped
only from documents that lose a run; a null id sorts before all others; rows equal in id and text
count as one document and share its result; an empty table gives an empty result; extra columns stay
as they are, but for ones with the names of the results, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, count_words, let, staged

MIN_LINES = 2
MIN_WORDS = 20  # a line of fewer words may be boilerplate
_NO_ID = -(1 << 63)
_KEY = ["_doc", "_text"]


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        "*", F.coalesce(F.col(doc_id), F.lit(_NO_ID)).alias("_doc"),
        F.xxhash64(text).alias("_text"))


def word_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                    lambda x: x.rlike(f"[^{SPACE}]"))


def _first_ranks(lines: DataFrame) -> DataFrame:
    """Repeated lines with the number of line positions that sort before them. Digests are spread
    evenly, so their leading digits cut the order into ranges of like size."""
    counts = staged(lines.groupBy("line").agg(F.count("*").alias("n")).filter("n > 1"), "line-ids")
    ranged = counts.withColumn("range", F.substring("line", 1, 3))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("range").agg(F.sum("n").alias("size")).select(
        "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("range").orderBy("line").rowsBetween(
        Window.unboundedPreceding, -1)
    return ranged.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(
        starts, "range").select("line", (F.col("start") + F.col("within")).alias("rank"))


def _doubled(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks by the first ``length + step`` lines from those by ``length`` >= step lines, for the
    suffixes that share them with another."""
    ahead = ranks.select(*_KEY, (F.col("at") - step).alias("at"), F.col("rank").alias("next"))
    pairs = ranks.join(ahead, [*_KEY, "at"])
    classes = pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).filter("n > 1")
    order = Window.partitionBy("rank").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
    named = classes.select(
        "rank", "next", (F.col("rank") + F.coalesce(F.sum("n").over(order), F.lit(0))).alias("new"))
    return pairs.join(named, ["rank", "next"]).select(*_KEY, "at", F.col("new").alias("rank"))


def _line_ranks(docs: DataFrame, doc_id: str, text: str, min_words: int | None) -> DataFrame:
    """(_doc, _text, at, rank, long): the lines that occur at least twice."""
    def facts(x: Column) -> Column:
        long = F.lit(False) if min_words is None else count_words(x) >= min_words
        return F.struct(F.md5(x).alias("line"), long.alias("long"))

    lines = _identified(docs, doc_id, text).select(
        *_KEY, F.posexplode(F.transform(word_lines(F.col(text)), facts)).alias("at", "x")).select(
        *_KEY, "at", "x.line", "x.long")
    lines = staged(lines, "lines").distinct()
    return staged(
        lines.join(_first_ranks(lines), "line").select(*_KEY, "at", "rank", "long"), "ranks")


def _lengthened(ranks: DataFrame, length: int) -> DataFrame:
    """(_doc, _text, at, rank): from ranks by the first line to ranks by the first ``length`` lines."""
    ranks = ranks.select(*_KEY, "at", "rank")
    known = 1
    while known < length:
        step = min(known, length - known)
        ranks = staged(_doubled(ranks, step), "ranks")
        known += step
    return ranks


def suffix_ranks(docs: DataFrame, length: int, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(_doc, _text, at, rank): the suffixes whose first ``length`` lines occur at least twice."""
    return _lengthened(_line_ranks(docs, doc_id, text, None), length)


def _not_first(ranks: DataFrame) -> DataFrame:
    place = F.struct(*_KEY, "at")
    first = ranks.groupBy("rank").agg(F.min(place).alias("first"))
    return ranks.join(first, "rank").filter(place > F.col("first")).select(*_KEY, "at")


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, doc_id: str = "doc_id",
                 text: str = "text", min_words: int | None = None) -> DataFrame:
    """(_doc, _text, _gone): per document the sorted numbers of its lines with a word that lie in a
    later copy of a repeated run of at least ``min_lines`` lines, or of a line of ``min_words``."""
    ranks = _line_ranks(docs, doc_id, text, min_words)
    lines = _not_first(_lengthened(ranks, min_lines)).select(
        *_KEY, F.explode(F.sequence("at", F.col("at") + min_lines - 1)).alias("at"))
    if min_words is not None:
        lines = lines.union(_not_first(ranks.filter("long")))
    return lines.groupBy(*_KEY).agg(F.sort_array(F.collect_set("at")).alias("_gone"))


def _without(lines: Column, gone: Column) -> Column:
    """The lines that are not gone: the stretches between deleted lines, put together."""
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    return let(bounds, lambda b: F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(gone)),
        lambda i: F.slice(lines, F.get(b, i) + 2, F.get(b, i + 1) - F.get(b, i) - 1))))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, doc_id: str = "doc_id",
                text: str = "text", min_words: int | None = None) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from the text, plus ``n_lines`` and
    ``n_removed`` (lines with a word, before and deleted)."""
    docs = docs.drop("n_lines", "n_removed")
    gone = later_copies(docs, min_lines, doc_id, text, min_words)
    named = _identified(docs, doc_id, text).join(gone, _KEY, "left")
    lines = word_lines(F.col(text))
    kept = let(lines, lambda ls: F.array_join(_without(ls, F.col("_gone")), "\n"))
    rest = [F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept).alias(text)
            if c == text else F.col(c) for c in docs.columns]
    return named.select(
        *rest, F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))


def dedup_sql(min_lines: int = MIN_LINES, min_words: int | None = None) -> str:
    """doc_id, n_lines, n_removed and kept_sha256 for tables with unique ids."""
    long = "" if min_words is None else f"""
  UNION SELECT doc_id, pos FROM (SELECT * FROM lines
    QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1)
  WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {min_words}"""
    run = " || ',' || ".join(
        f"lead(md5(line), {i}) OVER w" if i else "md5(line)" for i in range(min_lines))
    return f"""
WITH docs AS (
  SELECT doc_id, text, list_filter(string_split(coalesce(text, ''), chr(10)),
           lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM docs),
runs AS (SELECT doc_id, pos, {run} AS run FROM lines
         WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT doc_id, pos FROM runs WHERE run IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1),
gone AS (
  SELECT DISTINCT doc_id, pos + o AS pos FROM later,
         (SELECT unnest(range(0, {min_lines})) AS o){long}),
cut AS (
  SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
  WHERE g.pos IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN n_removed IS NULL THEN coalesce(d.text, '')
              ELSE coalesce(k.text, '') END) AS kept_sha256
FROM docs d LEFT JOIN cut USING (doc_id) LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
