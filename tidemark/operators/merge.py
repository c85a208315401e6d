"""Insert-only publishing and the scoped upsert, as joins over Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differs(columns: Sequence[str], a: str, b: str) -> Column:
    """Null-safe: whether any of the columns differs between two aliases."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def new_rows(candidate: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """What an insert-only append adds: rows whose id the target doesn't have."""
    return candidate.join(target.select(key), key, "left_anti").select(*candidate.columns)


def conflicts(incoming: DataFrame, existing: DataFrame, key: str, payload: Sequence[str]) -> DataFrame:
    """Ids that both have with different payloads."""
    a, b = incoming.alias("a"), existing.alias("b")
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}")).where(differs(payload, "a", "b")).select(F.col(f"a.{key}").alias(key)).distinct()


def scoped_merge(source: DataFrame, target: DataFrame, scope: DataFrame, scope_key: str, keys: Sequence[str], payload: Sequence[str], kept: Sequence[str] = (), most_shrink: float | None = 0.25) -> DataFrame:
    """The target after an upsert within a scope, with `action`: untouched, same, update, insert.

    Rows outside the scope stay. Within it the source is the truth: what it
    lacks goes, unless that would shrink the scope's rows by more than
    `most_shrink` net, which raises. Columns in `kept` keep the target's value
    on an update. Doing it again changes nothing. A source row outside the
    scope raises.
    """
    slice_ = scope.select(scope_key).distinct()
    outside = target.join(slice_, scope_key, "left_anti")
    inside = target.join(slice_, scope_key, "left_semi")
    if most_shrink is not None:
        if not source.join(slice_, scope_key, "left_anti").isEmpty():
            raise ValueError("the source has rows outside the scope")
        before, after = inside.count(), source.count()
        if before and (before - after) / before > most_shrink:
            raise ValueError(f"the merge would shrink the scope from {before} to {after} rows")
    s, t = source.alias("s"), inside.alias("t")
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    matched = F.col("t._there").isNotNull()
    both = s.join(inside.withColumn("_there", F.lit(True)).alias("t"), on, "left")
    changed = differs(payload, "s", "t")
    action = F.when(~matched, "insert").when(changed, "update").otherwise("same")
    pick = lambda c: F.when(matched, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")) if c in kept else F.when(matched & ~changed, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
    merged = both.select(*[pick(c).alias(c) for c in target.columns], action.alias("action"))
    return merged.unionByName(outside.select(*target.columns, F.lit("untouched").alias("action")))
