"""Mixing sources to target weights by weighted fair queueing.

Every document of a source is given a place in a seeded shuffle of that source. The finish time of
its copy in epoch ``e`` is ``(e * source size + running size) / target``; all copies are put in one
global order of finish time and the order is cut where the running size would pass the budget, the
total size of all documents.

Defined cases: a null text has size 0; null sources form one source that comes last; a null id is
shuffled as the text ``null``; documents without words take nothing; rows that repeat are separate
documents; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import count_words, staged

ROWS_PER_BUCKET = 4_000


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   max_repeat: int = 3) -> DataFrame:
    """One row per source: rank, weight, source_size, target.

    Targets share the total by weight, stop at ``max_repeat`` times the source and hand the excess
    on by weight. The fixed point is a water level: sources sorted by capacity per weight, the level
    is what is left divided by the weight that is left, and a source is full when its capacity lies
    below its level. The table has one row per source, so its windows are small.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = per_source.select(
        "source", "source_size",
        F.row_number().over(ordered).alias("rank"),
    ).withColumn(
        "weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")),
    ).withColumn("room", F.col("source_size") * max_repeat)
    fill = Window.orderBy(F.col("room") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    levels = ranked.select(
        "*",
        (F.sum("source_size").over(everything)
         - F.coalesce(F.sum("room").over(before), F.lit(0))).alias("left_size"),
        (F.sum("weight").over(everything)
         - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left_weight"),
    ).withColumn(
        "full", F.col("room") * F.col("left_weight") < F.col("left_size") * F.col("weight"))
    first_open = F.min(F.when(~F.col("full"), F.struct(
        F.col("room") / F.col("weight"), "rank", "left_size", "left_weight"))).over(everything)
    return levels.withColumn("open", first_open).select(
        "source", "rank", "weight", "source_size",
        F.when(F.col("full"), F.col("room").cast("double"))
        .otherwise((F.col("weight") * F.col("open.left_size")).cast("double")
                   / F.col("open.left_weight")).alias("target"),
    )


def shuffle_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (1, 2, 3),
        max_repeat: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: how often each document is taken.
    Columns named in ``carry`` come along.

    Running sums are made in two levels (buckets of the shuffle key, cells of the finish time), so
    neither a source with most of the rows nor the global order meets in one task. Only the cell in
    which the budget ends is put in full order.
    """
    sized = staged(docs.select(
        "doc_id", "source", count_words(F.col("text")).alias("size"),
        shuffle_key(F.col("doc_id"), seed).alias("key"), *carry,
    ), "mix-sizes")
    total, rows = sized.agg(F.sum("size"), F.count("*")).first()
    digits = 0
    while 16 ** digits * ROWS_PER_BUCKET < rows:
        digits += 1
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))
    targets = source_targets(sized, weights, max_repeat)

    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")).select(
        "source", "bucket",
        F.coalesce(F.sum("bucket_size").over(by_bucket), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    cell_count = max(16, rows // ROWS_PER_BUCKET)
    queued = sized.withColumn("within", F.sum("size").over(inside)).alias("d").join(
        starts.alias("s"),
        F.col("d.source").eqNullSafe(F.col("s.source"))
        & (F.col("d.bucket") == F.col("s.bucket")),
    ).join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "d.doc_id", "d.source", "d.size", "d.key", *[f"d.{c}" for c in carry], "t.rank",
        "t.source_size", "t.target",
        (F.col("start") + F.col("within")).alias("running"))
    queued = staged(queued, "mix-queue")

    def finish(epoch: Column) -> Column:
        return (epoch * F.col("source_size") + F.col("running")).cast("double") / F.col("target")

    copies = queued.filter("size > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))).alias("epoch"),
    ).withColumn("finish", finish(F.col("epoch").cast("long"))).withColumn(
        "cell", F.least(F.floor(F.col("finish") * cell_count), F.lit(4 * cell_count)))
    cells = copies.groupBy("cell").agg(F.sum("size").alias("cell_size"))
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    edge = cells.withColumn("through", F.sum("cell_size").over(upto)).filter(
        F.col("through") > F.lit(total or 0)).orderBy("cell").first()
    order = ["finish", "rank", "epoch", "key", "doc_id", "size"]
    if edge is None:  # without words there is nothing to cut
        taken = F.lit(0)
    else:
        edge_order = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        last = copies.filter(F.col("cell") == edge["cell"]).withColumn(
            "through", F.sum("size").over(edge_order) + F.lit(edge["through"] - edge["cell_size"]),
        ).filter(F.col("through") <= F.lit(total)).agg(F.max(F.struct(*order)).alias("x")).first()[0]

        def taken_copy(epoch: int) -> Column:
            when = finish(F.lit(epoch).cast("long"))
            cell = F.least(F.floor(when * cell_count), F.lit(4 * cell_count))
            below = cell < F.lit(edge["cell"])
            if last is None:
                return below.cast("int")
            place = F.struct(when.alias("finish"), "rank", F.lit(epoch).alias("epoch"), "key",
                             "doc_id", "size")
            bound = F.struct(*[
                F.lit(last[c]).cast(queued.schema[c].dataType if c in queued.columns
                                    else "int" if c == "epoch" else "double").alias(c)
                for c in order])
            return (below | ((cell == F.lit(edge["cell"])) & (place <= bound))).cast("int")

        taken = F.when(F.col("size") > 0, sum(
            (taken_copy(e) for e in range(1, max_repeat)), taken_copy(0))).otherwise(0)
    return queued.select(
        "doc_id", *carry, "source", "size", "source_size", F.col("target").cast("double"),
        taken.cast("int").alias("copies"), (taken.cast("long") * F.col("size")).alias("taken"))


def mix_sql(seed: str = "mix") -> str:
    """The same mix in one SQL statement, with plain global windows."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD_SQL}')), 0) AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':{seed}') AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank, 3 * source_size AS room
  FROM per),
weighted AS (SELECT *, (rank - 1) % 3 + 1 AS weight FROM ranked),
levels AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(room) OVER w, 0) AS left_size,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS left_weight
  FROM weighted
  WINDOW w AS (ORDER BY room / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, room * left_weight < left_size * weight AS is_full FROM levels),
opened AS (SELECT left_size, left_weight FROM marked WHERE NOT is_full
           ORDER BY room / weight, rank LIMIT 1),
targets AS (
  SELECT source, rank, source_size,
         CASE WHEN is_full THEN room::DOUBLE
              ELSE (weight * o.left_size)::DOUBLE / o.left_weight END AS target
  FROM marked CROSS JOIN opened o),
queued AS (
  SELECT s.doc_id, s.source, s.size, s.key, t.rank, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                           ROWS UNBOUNDED PRECEDING) AS running
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT q.*, e.epoch, (e.epoch * source_size + running)::DOUBLE / target AS finish
  FROM queued q, (SELECT unnest([0, 1, 2]) AS epoch) e WHERE size > 0),
line AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, epoch, key, doc_id, size
                            ROWS UNBOUNDED PRECEDING) AS through FROM copies),
got AS (
  SELECT doc_id, rank, running, sum(size) AS taken FROM line
  WHERE through <= (SELECT sum(size) FROM sized) GROUP BY ALL)
SELECT q.doc_id, q.size::BIGINT AS size, q.source_size::BIGINT AS source_size, q.target,
       coalesce(g.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN got g
  ON q.doc_id IS NOT DISTINCT FROM g.doc_id AND q.rank = g.rank AND q.running = g.running
     AND q.size > 0
"""


WORD_SQL = r"[^\x20\x09-\x0D]+"


def mixed(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (1, 2, 3),
          max_repeat: int = 3) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies, so rows without a copy
    (documents without words among them) go. Rows equal in id, source and text count each."""
    marked = docs.withColumn("_text", F.xxhash64("text"))
    copies = mix(marked, seed, weights, max_repeat, ("_text",)).filter("copies > 0").groupBy(
        "doc_id", "_text", "source").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    same = marked.withColumn("_row", F.row_number().over(
        Window.partitionBy("doc_id", "_text", "source").orderBy(F.lit(1))))
    joined = same.alias("d").join(copies.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))
                                  & (F.col("d._text") == F.col("c._text"))
                                  & F.col("d.source").eqNullSafe(F.col("c.source")))
    # copies of equal rows are shared out among them, the first rows first
    share = F.floor((F.col("_copies") - F.col("_row")) / F.col("_rows")) + 1
    return joined.filter("_row <= _copies").select(
        *[F.col(f"d.{c}") for c in docs.columns],
        F.explode(F.sequence(F.lit(1), F.least(share, F.col("_copies")))).alias("_copy")).select(
        *docs.columns)
