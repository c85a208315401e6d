"""Packing into length buckets whose boundaries minimise padding.

A histogram of all lengths, of bounded size, goes to the driver; dynamic
programming over it chooses the boundaries. Rows then get their bucket, and
within a bucket a hash-random rank by two-level counts, from which
token-budget batches follow; no bucket is gathered in one task.

Lengths up to `EXACT` have a bin each, longer ones `EXACT` / 2 bins an octave,
counted at the bin's upper end. Null texts have length 0. No row is cut or
dropped: a document longer than the budget is a batch of its own. Repeated
rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.mixing import word_count
from tidemark.plans.scratch import written
from tidemark.sources.tables import table

BUCKETS = 8
BUDGET = 16_384
EXACT = 1024


def bin_edge(length: Column) -> Column:
    """The upper end of a length's bin."""
    step = F.expr(f"shiftleft(1L, cast(greatest(0, floor(log2(greatest(length, 1L)))) - {EXACT.bit_length() - 2} as int))")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step) * step).cast("long")


def boundaries(edges: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The upper bounds of at most `buckets` buckets with the least total of padded lengths.

    edges ascending; each row is padded to its bucket's bound. Exact dynamic
    programming: best[j] over a prefix of j bins is the least over i < j of
    best[i] plus the rows of bins i..j-1 at edge j-1.
    """
    n = len(edges)
    if not n:
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    choice = []
    for _ in range(min(buckets, n)):
        after, source = best.copy(), np.full(n + 1, -1)
        for j in range(1, n + 1):
            cost = best[:j] + (total[j] - total[:j]) * float(edges[j - 1])
            i = int(cost.argmin())
            if cost[i] < after[j]:
                after[j], source[j] = cost[i], i
        choice.append(source)
        best = after
    bounds, j = [], n
    for source in reversed(choice):
        if j and source[j] >= 0:
            bounds.append(int(edges[j - 1]))
            j = int(source[j])
    return bounds[::-1]


def pack(rows: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, length -> bucket (from 0), padded_to, batch (from 0 in its bucket), slot (from 0 in its batch)."""
    placed = written(
        rows.select("doc_id", "length", bin_edge(F.col("length")).alias("edge"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place")).withColumn("range", F.substring("place", 1, 3)),
        "pack-rows",
    )
    histogram = placed.groupBy("edge").agg(F.count("*").alias("n")).toPandas().sort_values("edge")
    bounds = boundaries(histogram["edge"].to_numpy(), histogram["n"].to_numpy(), buckets)
    bucket, padded = F.lit(0), F.lit(bounds[0] if bounds else 0)
    for k, b in enumerate(bounds[:-1]):
        bucket = F.when(F.col("edge") > b, F.lit(k + 1)).otherwise(bucket)
        padded = F.when(F.col("edge") > b, F.lit(bounds[k + 1])).otherwise(padded)
    placed = placed.withColumn("bucket", bucket).withColumn("padded_to", padded.cast("long"))
    counts = placed.groupBy("bucket", "range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("bucket", "range", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("bucket", "range").orderBy("place", "doc_id", "length")) - 1
    holds = F.greatest(F.lit(1), F.expr(f"{budget}L div greatest(padded_to, 1L)"))
    return (
        placed.withColumn("within", within)
        .join(counts, ["bucket", "range"])
        .withColumn("rank", F.col("before") + F.col("within"))
        .withColumn("holds", holds)
        .select("doc_id", "length", "bucket", "padded_to", F.expr("rank div holds").alias("batch"), F.expr("cast(rank % holds as int)").alias("slot"))
    )


def packed_documents(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    return pack(docs.select("doc_id", word_count(F.col("text")).alias("length")), buckets, budget)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
