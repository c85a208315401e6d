"""Mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random place within its source. A source's words
are laid end to end in that order by a two-level prefix sum: sums of hash
ranges, then the running sum within one range, so neither a hot source nor
the table meets in one task. The source's budget is cut exactly there, after
as many whole epochs as fit.

Null texts have size 0, null sources form one source, which comes last.
Repeated rows each count. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._text import WORD
from tidemark.plans.scratch import cut, written
from tidemark.sources.tables import table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
MOST_BROADCAST = 1_000_000


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Budgets of sources: (source_key, source, source_size) gains `target`.

    The total is `share` of all sizes, dealt by the weights, which repeat over
    the sources by code point with null last. A target stops at `cap` times
    its source's size and what is over is dealt again by weight, until none
    is above: the level at which the caps, taken in the order of size for
    weight, leave the rest of the total. One row a source.
    """
    all_rows = Window.partitionBy()
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(number - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("source_cap", F.col("source_size") * cap)
        .withColumn("ratio", F.col("source_cap").cast("double") / F.col("weight").cast("double"))
        .withColumn("total", F.sum("source_size").over(all_rows).cast("double") * F.lit(float(share)))
    )
    order = Window.orderBy("ratio", "source_key")
    level = (F.col("total") - F.coalesce(F.sum("source_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double")) / F.sum("weight").over(
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ).cast("double")
    levelled = ranked.withColumn("place", F.row_number().over(order)).withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(all_rows)
    return levelled.withColumn("found", first["level"]).select(
        "source_key",
        "source",
        "source_size",
        F.when(F.col("found").isNull(), F.col("source_cap").cast("double")).otherwise(F.least(F.col("source_cap").cast("double"), F.col("found") * F.col("weight").cast("double"))).alias("target"),
    )


def mix(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Deal the words of `rows` (doc_id, source, size): adds source_size, target, taken and epochs.

    `taken` is the words the mix takes, repeats counted, so that each source
    gives its target rounded; only the document at the cut gives a part.
    `epochs` is how often a document appears, that one whole; never, if it
    has no words. The order is
    that of the id's MD5, so reruns agree on any number of machines.
    """
    keyed = rows.select(
        "doc_id",
        "source",
        "size",
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")).alias("source_key"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place"),
    ).withColumn("range", F.substring("place", 1, 3))
    keyed = written(keyed, "mix-rows")
    ranges = keyed.groupBy("source_key", "source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("source_key", "source").agg(F.sum("range_size").alias("source_size")), weights, share, cap)
    before = F.coalesce(F.sum("range_size").over(Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    budget = F.round("target").cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    ranges = (
        ranges.withColumn("range_start", before)
        .join(targets.select("source_key", "source_size", "target"), "source_key")
        .select("source_key", "range", "range_start", "source_size", "target", F.expr("cast(round(target) as bigint) div greatest(source_size, 1L)").alias("whole"), F.pmod(budget, size).alias("rest"))
    )
    start = F.coalesce(F.sum("size").over(Window.partitionBy("source_key", "range").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("range_start") - F.col("start")))
    return (
        keyed.withColumn("start", start)
        .join(ranges, ["source_key", "range"])
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("whole") * F.col("size") + part).cast("long").alias("taken"),
            F.when(F.col("size") > 0, F.col("whole") + F.when(part > 0, 1).otherwise(0)).otherwise(0).cast("int").alias("epochs"),
        )
    )


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The documents themselves in the mix: all their columns, once for every epoch they are in.

    Rows with one doc_id are taken as copies of one document: each of them
    appears in as many epochs as that id's first place gives.
    """
    taken = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), weights, share, cap)
    times = cut(taken.where("epochs > 0").groupBy("doc_id").agg(F.max("epochs").alias("_epochs")))
    if times.count() <= MOST_BROADCAST:  # two numbers a document; beyond, a shuffled join
        times = F.broadcast(times)
    return (
        docs.join(times, docs["doc_id"].eqNullSafe(times["doc_id"]))
        .select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("_epochs"))).alias("_epoch"))
        .drop("_epoch")
    )


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))).select("doc_id", "size", "source_size", "target", "taken", "epochs")


OP4_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS place FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
numbered AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight FROM sizes),
ratios AS (SELECT *, 2 * source_size AS cap, CAST(2 * source_size AS DOUBLE) / CAST(weight AS DOUBLE) AS ratio,
                  CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total FROM numbered),
levels AS (SELECT *, row_number() OVER o AS n,
                  (total - CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
                  / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
           FROM ratios WINDOW o AS (ORDER BY ratio, source NULLS FIRST)),
found AS (SELECT arg_min(level, n) AS level FROM levels WHERE level <= ratio),
targets AS (SELECT l.source, source_size, least(CAST(cap AS DOUBLE), f.level * CAST(weight AS DOUBLE)) AS target FROM levels l, found f),
placed AS (SELECT r.doc_id, r.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
                  coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
           FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, budget // greatest(source_size, 1) AS whole,
               greatest(0, least(size, budget % greatest(source_size, 1) - start)) AS part FROM placed)
SELECT doc_id, size, source_size, target, CAST(whole * size + part AS BIGINT) AS taken,
       CAST(CASE WHEN size > 0 THEN whole + CASE WHEN part > 0 THEN 1 ELSE 0 END ELSE 0 END AS INTEGER) AS epochs FROM cut
"""
