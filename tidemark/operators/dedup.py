"""Exact duplicates, latest rows and collapsed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import joined_ids


def exact_duplicates(df: DataFrame, business: Sequence[str], least: Sequence[str]) -> DataFrame:
    """One row for equal business columns (nulls equal), with the least of the others."""
    return df.groupBy(*business).agg(*[F.min(c).alias(c) for c in least])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest order columns: one aggregation, no sort of all rows."""
    top = F.max(F.struct(*order, *[c for c in columns if c not in order]))
    return df.groupBy(*keys).agg(top.alias("_top")).select(*keys, *[F.col(f"_top.{c}").alias(c) for c in columns])


def collapsed(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """One row a key with its distinct ids in order, joined."""
    return df.groupBy(*keys).agg(joined_ids(F.col(row_id)).alias("ids"), F.count("*").alias("n"))


def kept_positives(df: DataFrame, label: Column, most: int, row_id: str, seed: int = 0) -> DataFrame:
    """All positives and so many negatives, in the order of an MD5 of their ids, that `most` rows are not exceeded (a sampling operator)."""
    positives = df.where(label)
    left = max(0, most - positives.count())
    order = F.md5(F.concat(F.lit(f"{seed}::"), F.col(row_id).cast("string")))
    return positives.unionByName(df.where(~F.coalesce(label, F.lit(False))).orderBy(order, row_id).limit(left))


def in_cohort(key: Column, salt: str, buckets: int, keep: int) -> Column:
    """Whether a key is in the sample, by 32 bits of an MD5: the same answer for it in every table and engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}::"), key.cast("string"))), 1, 8), 16, 10).cast("long") % buckets < keep
