"""Interval, band, theta and as-of joins, each with an equi-key so that none is a cross product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an order."""
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_place = 1").drop("_place")


# Widths in days of the time ranges by which intervals meet points, and how many ranges of one width an interval may touch.
RANGES = (28,)
MOST_RANGES = 52


def _day(at: Column) -> Column:
    return F.unix_date(at.cast("date"))


def _of_point(at: Column) -> Column:
    """(level, range) of a moment at each width, and one for all time."""
    each = [F.struct(F.lit(i).alias("level"), F.floor(_day(at) / w).alias("range")) for i, w in enumerate(RANGES)]
    return F.array(*each, F.struct(F.lit(len(RANGES)).alias("level"), F.lit(0).cast("long").alias("range")))


def _at_level(level: int):
    return lambda r: F.struct(F.lit(level).alias("level"), r.alias("range"))


def _of_interval(start: Column, end: Column) -> Column:
    """(level, range) an interval touches, at the least width that keeps them few; open and very long ones are of all time."""
    out = F.array(F.struct(F.lit(len(RANGES)).alias("level"), F.lit(0).cast("long").alias("range")))
    for i, w in reversed(list(enumerate(RANGES))):
        low, high = F.floor(_day(start) / w), F.floor(_day(end) / w)
        touched = F.transform(F.sequence(low, high), _at_level(i))
        out = F.when((high - low).between(0, MOST_RANGES - 1), touched).otherwise(out)
    return out


def _meeting(points: DataFrame, intervals: DataFrame, key: str, at: Column, start: Column, end: Column, inside) -> DataFrame:
    """Pairs of a key for which `inside(at, start, end)` holds, which must imply that the point's day is none outside the interval's.

    Both meet by key and time range, so a key with many rows is split by time
    and, where intervals overlap little, a point sees few of them.
    """
    p = points.where(F.col(key).isNotNull() & at.isNotNull()).select(F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_p"), F.col(key).alias("_key"), at.alias("_at"), F.explode(_of_point(at)).alias("_r"))
    good = F.col(key).isNotNull() & start.isNotNull() & (end.isNull() | (end >= start))
    i = intervals.where(good).select(F.struct(*[F.col(f"`{c}`") for c in intervals.columns if c != key], start.alias("_start"), end.alias("_end")).alias("_i"), F.col(key).alias("_key"), F.explode(_of_interval(start, end)).alias("_r"))
    flat = lambda d: d.withColumn("_level", F.col("_r.level")).withColumn("_range", F.col("_r.range")).drop("_r")
    found = flat(p).join(flat(i), ["_key", "_level", "_range"]).where(inside(F.col("_at"), F.col("_i._start"), F.col("_i._end")))
    return found.select("_p.*", *[F.col(f"_i.`{c}`") for c in intervals.columns if c != key])


def point_in_interval(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, closed: bool = True, row_id: str | None = None) -> DataFrame:
    """Inner join of points with the intervals they lie in; a null end is open.

    closed: whether the end itself belongs to the interval. With `row_id`, the
    interval that starts last wins for each point. An interval that ends before
    it starts, and null keys, moments and starts meet nothing.
    """
    inside = lambda t, a, b: (t >= a) & (b.isNull() | ((t <= b) if closed else (t < b)))
    found = _meeting(points, intervals, key, F.col(at), F.col(start), F.col(end), inside)
    return best_of(found, [row_id], [F.col(start).desc_nulls_last()]) if row_id else found


def active_at(intervals: DataFrame, references: DataFrame, key: str, at: str, start: str, end: str) -> DataFrame:
    """For each reference the interval active on its date, both ends included; the latest start wins."""
    inside = lambda t, a, b: (t >= a) & (b.isNull() | (t <= b))
    found = _meeting(references, intervals, key, F.to_date(at), F.to_date(start), F.to_date(end), inside)
    return best_of(found, [key, at], [F.col(start).desc_nulls_last(), F.col(end).desc_nulls_first()])


def scope_events(scope: DataFrame, events: DataFrame, key: str, at: str, reference: str, start: str, days: int) -> DataFrame:
    """Left join of entities with their events in (latest of start and reference - days, reference]."""
    s, e = scope.alias("s"), events.alias("e")
    low = F.greatest(F.col(f"s.{start}"), F.col(f"s.{reference}") - F.expr(f"INTERVAL {int(days)} DAYS"))
    inside = (F.col(f"e.{at}") > low) & (F.col(f"e.{at}") <= F.col(f"s.{reference}"))
    return s.join(e, (F.col(f"s.{key}") == F.col(f"e.{key}")) & inside, "left").select("s.*", *[F.col(f"e.{c}") for c in events.columns if c != key])


def nearest_in_band(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, left_id: str, right_id: str, days: float) -> DataFrame:
    """For each left row the nearest right row of its key within `days` on either side; ties to the smaller right id.

    The last right row before and the first after are carried along by two
    windows over a key's stretch of time, so rows aren't paired within a key;
    right rows stand in their own stretch of `days` and both neighbours.
    """
    width = int(days * 86_400_000_000)
    us = lambda c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(`{c}` AS TIMESTAMP_NTZ))")
    row = lambda d: F.struct(*[F.col(f"`{c}`") for c in d.columns])
    ones = right.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"), us(right_at).alias("_us")).agg(F.min_by(row(right), F.col(right_id)).alias("_right")).where("_us IS NOT NULL")
    here = F.floor(F.col("_us") / max(width, 1))
    ones = ones.withColumn("_stretch", F.explode(F.array(here - 1, here, here + 1)))
    rows = left.select(F.col(key).alias("_key"), us(left_at).alias("_us"), row(left).alias("_left")).where("_key IS NOT NULL AND _us IS NOT NULL").withColumn("_stretch", here)
    both = rows.unionByName(ones, allowMissingColumns=True).withColumn("_seen", F.when(F.col("_right").isNotNull(), F.struct(F.col("_us").alias("us"), F.col("_right").alias("row"))))
    part = Window.partitionBy("_key", "_stretch")
    upto = lambda order: F.last("_seen", ignorenulls=True).over(part.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    near = both.withColumn("_before", upto(F.col("_us"))).withColumn("_after", upto(F.col("_us").desc())).where("_left IS NOT NULL")
    each = lambda s: F.when(F.col(s).isNotNull(), F.struct(F.abs(F.col(f"{s}.us") - F.col("_us")).alias("gap"), F.col(f"{s}.row.{right_id}").alias("id"), F.col(f"{s}.row").alias("row")))
    best = near.withColumn("_best", F.array_min(F.array_compact(F.array(each("_before"), each("_after"))))).where(F.col("_best.gap") <= width)
    return best.select("_left.*", *[F.col(f"_best.row.`{c}`") for c in right.columns if c != key], F.col("_best.gap").alias("gap_us"))


def later_exists(df: DataFrame, keys: Sequence[str], at: str, counts: Column) -> Column:
    """Whether a strictly later row of the keys fulfils a condition: one window, no self join."""
    last = F.max(F.when(counts, F.col(at))).over(Window.partitionBy(*keys))
    return F.coalesce(last > F.col(at), F.lit(False))


def none_before(df: DataFrame, others: DataFrame, key: str, at: str, other_at: str, differs: tuple[str, str]) -> DataFrame:
    """Rows without an earlier row of the same key in `others` whose second column differs; nulls differ from nothing.

    A key's two values that come first decide: the first for rows with another
    value, the second for rows with that value.
    """
    first = others.select(F.col(key).alias("_key"), F.col(differs[1]).alias("_value"), F.col(other_at).alias("_at")).na.drop().groupBy("_key", "_value").agg(F.min("_at").alias("_at"))
    placed = first.withColumn("_place", F.row_number().over(Window.partitionBy("_key").orderBy("_at", "_value"))).where("_place <= 2")
    two = placed.groupBy("_key").agg(*[F.max(F.when(F.col("_place") == n, F.col(c))).alias(f"{c}{n}") for n, c in ((1, "_value"), (1, "_at"), (2, "_at"))])
    value, moment = F.col(differs[0]), F.col(at)
    earlier = ((value != F.col("_value1")) & (F.col("_at1") < moment)) | ((value == F.col("_value1")) & (F.col("_at2") < moment))
    return df.join(two, F.col(key) == F.col("_key"), "left").where(~F.coalesce(earlier, F.lit(False))).select(*[F.col(f"`{c}`") for c in df.columns])


def next_of_other(df: DataFrame, key: str, other: str, at: str, row_id: str) -> DataFrame:
    """For each row the next row of its key, in the order (at, row_id), with another value in `other`: (row_id, next_id, next_at).

    Blocks of equal values are found by windows; that row is the first of the
    next block, so rows aren't paired with each other.
    """
    order = Window.partitionBy(key).orderBy(at, row_id)
    changed = F.coalesce((F.col(other) != F.lag(other).over(order)).cast("int"), F.lit(0))
    blocks = df.withColumn("_block", F.sum(changed).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    heads = blocks.groupBy(key, "_block").agg(F.min(F.struct(F.col(at).alias("at"), F.col(row_id).alias("id"))).alias("_head"))
    ahead = heads.select(key, (F.col("_block") - 1).alias("_block"), F.col("_head.id").alias("next_id"), F.col("_head.at").alias("next_at"))
    return blocks.join(ahead, [key, "_block"]).select(row_id, "next_id", "next_at")


def enriched(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """Left join with a reference table, whose keys must be unique."""
    if not lookup.groupBy(lookup_key).count().where("count > 1").isEmpty():
        raise ValueError(f"{lookup_key} is not unique")
    return df.join(lookup, df[key] == lookup[lookup_key], "left").drop(lookup[lookup_key])


def assembled(base: DataFrame, frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left joins of feature frames onto a base; only new columns come in, and a fan-out can't happen unnoticed."""
    out = base
    for f in frames:
        new = [c for c in f.columns if c not in out.columns]
        out = out.join(f.select(*keys, *new), list(keys), "left")
    return out
