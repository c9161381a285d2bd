"""Quality rules whose cutoffs come from labelled holdouts with exact binomial bounds.

Each rule rejects documents whose measure lies above a cutoff. For every stratum (the language) and
rule the labelled good documents are a holdout: of ``n`` good ones, ``k`` lie above the cutoff. A
cutoff is certified when, if its false rejection rate were ``risk / rules``, seeing ``k`` or fewer
rejections would have probability at most ``(1 - confidence) / (strata * rules)``: the exact binomial
(Clopper-Pearson) bound with a Bonferroni correction over strata and rules. Within one stratum and
rule the cutoffs are tested from the loosest to the strictest, a fixed sequence that needs no further
correction, and the strictest certified one is used. A stratum with too few labels certifies nothing
and rejects nothing beyond the base rule.

Defined cases: a null text has no words and fails the base rule; a null language is a stratum of its
own; labels without a document or quality are ignored and a document counts as good when none of its
labels says otherwise; empty tables give an empty result or no cutoffs; rows that repeat are judged
each; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, let, staged, words

# Candidate cutoffs of each rule, strictest first.
RULES: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0),
    "duplicate_line_share": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5),
    "repeated_word_share": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4),
    "chars_per_word": (6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0),
}
RISK, CONFIDENCE = 0.05, 0.95


def repeated_words(ws: Column) -> Column:
    """Words in 3-word windows that occur at least twice in the array, each word counted once."""
    grams = F.when(F.size(ws) >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(1), F.size(ws) - 2),
        lambda i: F.struct(
            F.xxhash64(F.get(ws, i - 1), F.get(ws, i), F.get(ws, i + 1)).alias("h"),
            i.alias("at")))))

    def covered(g: Column) -> Column:
        again = F.filter(g, lambda x, i: F.coalesce(
            F.get(g, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get(g, i + 1)["h"] == x["h"], F.lit(False)))
        places = F.sort_array(F.transform(again, lambda x: x["at"]))
        return F.aggregate(
            places, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, at: F.struct(
                at.alias("last"),
                (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    return F.coalesce(let(grams, covered), F.lit(0).cast("long"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of every document."""
    text = F.coalesce("text", F.lit(""))
    of_words = let(words(text), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        repeated_words(ws).alias("n_repeat_words")))
    of_lines = let(
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")),
        lambda ls: F.struct(F.size(ls).cast("long").alias("n_lines"),
                            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long")
                            .alias("n_dup_lines")))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))
    counted = docs.select(
        "doc_id", "lang", of_words.alias("w"), of_lines.alias("l"),
        symbols.cast("long").alias("n_symbols"))
    return counted.select("doc_id", "lang", "w.*", "l.*", "n_symbols")


def with_measures(counts: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    n = F.greatest("n_words", F.lit(1)).cast("double")
    return counts.select(
        "*", failed.alias("base_failed"),
        (F.col("n_symbols") / n).alias("symbols_per_word"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)).cast("double"))
        .alias("duplicate_line_share"),
        (F.col("n_repeat_words") / n).alias("repeated_word_share"),
        (F.col("word_chars") / n).alias("chars_per_word"))


def log_gamma(x: Column) -> Column:
    """ln gamma(x) for x >= 1: Stirling's series at x + 8, accurate to about 1e-14."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    shifted = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series
    for i in range(8):
        shifted = shifted - F.log(x + i)
    return shifted


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial, for k <= n * p; 1 above (such a k certifies nothing). Terms are added
    from k downwards, where they fall; those left out are below 1e-300 of the first."""
    n, k = n.cast("double"), k.cast("double")
    top = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
                + k * math.log(p) + (n - k) * math.log(1 - p))
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p * (1 - p))) + 200).cast("int")
    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, j: let(
            acc["term"] * (k - j + 1) / (n - k + j) * ((1 - p) / p),
            lambda t: F.struct(t.alias("term"), (acc["sum"] + t).alias("sum"))),
        lambda acc: acc["sum"])
    return F.when(k > n * p, F.lit(1.0)).otherwise(top * total)


def good_ids(labels: DataFrame) -> DataFrame:
    return labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")


def cutoffs(measures: DataFrame, labels: DataFrame, risk: float = RISK,
            confidence: float = CONFIDENCE) -> DataFrame:
    """One row per stratum: its cutoff for each rule, null where none is certified."""
    holdout = measures.filter("not base_failed").join(good_ids(labels), "doc_id", "left_semi")
    above = [F.count_if(F.col(rule) > c).alias(f"{rule}__{i}")
             for rule, cs in RULES.items() for i, c in enumerate(cs)]
    counts = holdout.groupBy("lang").agg(F.count("*").alias("n"), *above)
    strata = holdout.agg(F.count_distinct(F.coalesce("lang", F.lit(""))).alias("strata"))
    share = risk / len(RULES)
    allowed = (1 - confidence) / (F.greatest("strata", F.lit(1)) * len(RULES))

    def strictest(rule: str) -> Column:
        tests = [F.when(binomial_at_most(F.col(f"{rule}__{i}"), F.col("n"), share) <= allowed, c)
                 for i, c in enumerate(RULES[rule])]
        return F.coalesce(*tests)

    # strata is one row: joined on a constant key, not crossed
    return counts.withColumn("one", F.lit(1)).join(strata.withColumn("one", F.lit(1)), "one").select(
        "lang", "n", *[strictest(rule).alias(f"max_{rule}") for rule in RULES])


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK,
          confidence: float = CONFIDENCE) -> DataFrame:
    """Counts, base_failed and kept of every document."""
    measures = with_measures(staged(measured(docs), "quality-counts"))
    limits = cutoffs(measures, labels, risk, confidence).alias("c")
    passes = F.lit(True)
    for rule in RULES:
        passes = passes & F.coalesce(F.col(rule) <= F.col(f"max_{rule}"), F.lit(True))
    return measures.alias("m").join(
        limits, F.col("m.lang").eqNullSafe(F.col("c.lang")), "left").select(
        "m.*", *[f"max_{rule}" for rule in RULES],
        (~F.col("base_failed") & passes).alias("kept"))


def judge_sql(risk: float = RISK, confidence: float = CONFIDENCE) -> str:
    share = risk / len(RULES)
    tests = "\n  UNION ALL ".join(
        f"SELECT lang, '{rule}' AS rule, {c} AS cutoff, count(*) AS n,"
        f" count_if({rule} > {c})::BIGINT AS k FROM holdout GROUP BY lang"
        for rule, cs in RULES.items() for c in cs)
    limits = ", ".join(f"min(cutoff) FILTER (rule = '{rule}') AS max_{rule}" for rule in RULES)
    passes = " AND ".join(f"coalesce({rule} <= max_{rule}, true)" for rule in RULES)
    return f"""
WITH w AS (
  SELECT *, regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '{WORD_SQL}')) AS ls
  FROM documents),
grams AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS pos, ws FROM w WHERE len(ws) >= 3),
again AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, ws[pos], ws[pos + 1], ws[pos + 2]) AS n
  FROM grams),
rep AS (
  SELECT doc_id, count(DISTINCT pos + o) AS n_repeat_words
  FROM again, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g'))
           AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
m AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols / greatest(n_words, 1)::DOUBLE AS symbols_per_word,
         n_dup_lines / greatest(n_lines, 1)::DOUBLE AS duplicate_line_share,
         n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeated_word_share,
         word_chars / greatest(n_words, 1)::DOUBLE AS chars_per_word
  FROM counts),
holdout AS MATERIALIZED (
  SELECT * FROM m WHERE NOT base_failed AND doc_id IN (
    SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)),
strata AS (SELECT count(DISTINCT coalesce(lang, '')) AS strata FROM holdout),
tests AS (
  {tests}),
certified AS (
  SELECT lang, rule, cutoff FROM tests, strata
  WHERE k <= n * {share!r} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(
    lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r})
    + (n - i) * ln(1 - {share!r})))) <= {1 - confidence!r} / (greatest(strata, 1) * {len(RULES)})),
limits AS (SELECT lang, {limits} FROM certified GROUP BY lang)
SELECT m.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {passes} AS kept
FROM m LEFT JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang
"""


WORD_SQL = r"[^\x20\x09-\x0D]+"
