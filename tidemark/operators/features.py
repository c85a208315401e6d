"""Point-in-time features of entities from their scoped events.

A frame of scoped events has the entity's keys, `reference_ts`, `event_ts`,
`event_type`, `event_id` and, where used, `event_weight` and dimensions. All
features of a family come from one or two aggregations over the keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import assembled

# Lookback days; those in HOURLY count hours back, others calendar days.
LOOKBACKS = (1, 3, 7, 30, 90)
HOURLY = (1, 3)
RATIOS = ((1, 3), (7, 30), (30, 90))
HALF_LIFE_DAYS = 7.0


def day(c: str) -> Column:
    return F.to_date(F.col(c))


def ratio(a: Column, b: Column) -> Column:
    """Null where the divisor is null or 0."""
    return F.when(b != 0, a / b)


def within(days: int) -> Column:
    """Whether an event lies in the lookback before its reference."""
    if days in HOURLY:
        return (F.col("event_ts") <= F.col("reference_ts")) & (F.col("event_ts") > F.col("reference_ts") - F.expr(f"INTERVAL {24 * days} HOURS"))
    return F.datediff(F.col("reference_ts"), F.col("event_ts")).between(0, days - 1)


def frequency(base: DataFrame, events: DataFrame, keys: Sequence[str], stub: str, lookbacks: Sequence[int] = LOOKBACKS) -> DataFrame:
    """Counts, weighted counts and any-flags a lookback; null for an entity without events."""
    weight = F.coalesce(F.col("event_weight").cast("double"), F.lit(1.0)) if "event_weight" in events.columns else F.lit(1.0)
    out = []
    for d in lookbacks:
        c = within(d)
        out += [
            F.sum(F.when(c, 1).otherwise(0)).alias(f"{stub}_cnt_{d}d"),
            F.sum(F.when(c, weight).otherwise(0.0)).alias(f"{stub}_weighted_cnt_{d}d"),
            F.max(F.when(c, 1).otherwise(0)).alias(f"{stub}_any_{d}d"),
        ]
    return assembled(base, [events.groupBy(*keys).agg(*out)], keys)


def recency(base: DataFrame, events: DataFrame, keys: Sequence[str], stub: str) -> DataFrame:
    found = events.groupBy(*keys).agg(
        F.count("event_ts").alias(f"{stub}_total_cnt"),
        F.datediff(F.max("reference_ts"), F.max("event_ts")).alias(f"{stub}_days_since_last"),
        F.datediff(F.max("reference_ts"), F.min("event_ts")).alias(f"{stub}_days_since_first"),
    )
    return assembled(base, [found], keys)


def diversity(base: DataFrame, events: DataFrame, keys: Sequence[str], stub: str, dimensions: Sequence[str]) -> DataFrame:
    there = [d for d in dimensions if d in events.columns]
    out = [e for d in there for e in (F.countDistinct(d).alias(f"{stub}_{d}_distinct_cnt"), F.count(d).alias(f"{stub}_{d}_non_null_cnt"))]
    return assembled(base, [events.groupBy(*keys).agg(*out)] if out else [], keys)


def periodicity(events: DataFrame, keys: Sequence[str], stub: str) -> DataFrame:
    """Days between events: only entities with two or more."""
    gap = F.datediff(F.col("event_ts"), F.lag("event_ts").over(Window.partitionBy(*keys).orderBy("event_ts")))
    found = events.withColumn("gap", gap).where("gap IS NOT NULL").groupBy(*keys).agg(
        F.avg("gap").alias(f"{stub}_interval_mean"),
        F.percentile_approx("gap", 0.5).alias(f"{stub}_interval_median"),
        F.min("gap").alias(f"{stub}_interval_min"),
        F.max("gap").alias(f"{stub}_interval_max"),
        F.stddev_samp("gap").alias(f"{stub}_interval_stddev"),
    )
    mean = F.col(f"{stub}_interval_mean")
    return found.withColumns({f"{stub}_interval_cv": ratio(F.col(f"{stub}_interval_stddev"), mean), f"{stub}_interarrival_velocity": ratio(F.lit(1.0), mean)})


def burstiness(events: DataFrame, keys: Sequence[str], stub: str, unit: str = "month", ratios: Sequence[tuple[int, int]] = RATIOS) -> DataFrame:
    """How unevenly events fall over months, and ratios of lookback counts."""
    lookbacks = sorted({d for r in ratios for d in r})
    monthly = events.groupBy(*keys, F.date_trunc(unit, "event_ts").alias("m")).agg(F.count("*").alias("n"), *[F.count_if(within(d)).alias(f"c{d}") for d in lookbacks])
    found = monthly.groupBy(*keys).agg(
        F.max("n").alias(f"{stub}_max_{unit}ly_cnt"),
        F.avg("n").alias(f"{stub}_avg_{unit}ly_cnt"),
        F.stddev_samp("n").alias(f"{stub}_{unit}ly_cnt_std"),
        F.count("*").alias(f"{stub}_active_{unit}s"),
        *[F.sum(f"c{d}").alias(f"c{d}") for d in lookbacks],
    )
    found = found.withColumn(f"{stub}_{unit}ly_peak_to_avg", ratio(F.col(f"{stub}_max_{unit}ly_cnt"), F.col(f"{stub}_avg_{unit}ly_cnt")))
    return found.withColumns({f"{stub}_cnt_{a}d_over_{b}d": ratio(F.col(f"c{a}"), F.col(f"c{b}")) for a, b in ratios}).drop(*[f"c{d}" for d in lookbacks])


def entropy(events: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Shannon entropy of a value in bits: log2 n - sum(c log2 c) / n over the counts c."""
    counts = events.groupBy(*keys, value.alias("v")).agg(F.count("*").alias("c"))
    return counts.groupBy(*keys).agg((F.log2(F.sum("c")) - F.sum(F.col("c") * F.log2("c")) / F.sum("c")).alias(name))


def temporal_entropy(events: DataFrame, keys: Sequence[str], stub: str) -> DataFrame:
    parts = {"hour": F.hour("event_ts"), "day_of_week": F.dayofweek("event_ts"), "month": F.month("event_ts")}
    return assembled(events.select(*keys).distinct(), [entropy(events, keys, v, f"{stub}_{k}_entropy") for k, v in parts.items()], keys)


def time_to_k(events: DataFrame, keys: Sequence[str], stub: str, k: int) -> DataFrame:
    """Days that the last k events span; null with fewer."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("event_ts"), F.desc("event_id")))
    last = events.withColumn("place", place).where(F.col("place") <= k)
    span = F.when(F.count("*") >= k, F.datediff(F.max("event_ts"), F.min("event_ts")))
    found = last.groupBy(*keys).agg(span.alias(f"{stub}_days_for_last_{k}_events"))
    return found.withColumn(f"{stub}_k_event_velocity_{k}", ratio(F.lit(float(k)), F.col(f"{stub}_days_for_last_{k}_events")))


def recency_intensity(events: DataFrame, keys: Sequence[str], stub: str, half_life: float = HALF_LIFE_DAYS) -> DataFrame:
    """Every event once, halved for each half-life of its age."""
    if half_life <= 0:
        raise ValueError("a half-life is positive")
    age = F.abs(F.datediff("reference_ts", "event_ts"))
    return events.groupBy(*keys).agg(F.sum(F.pow(F.lit(0.5), age / F.lit(float(half_life)))).alias(f"{stub}_recency_weighted_intensity"))


def cumulative_slope(events: DataFrame, keys: Sequence[str], stub: str) -> DataFrame:
    """Slope of the running count over elapsed days."""
    w = Window.partitionBy(*keys)
    shaped = events.withColumn("elapsed", F.datediff("event_ts", F.min("event_ts").over(w))).withColumn("nth", F.row_number().over(w.orderBy("event_ts", "event_id")).cast("double"))
    return shaped.groupBy(*keys).agg(F.regr_slope("nth", "elapsed").alias(f"{stub}_cumulative_event_slope"))


def token(name: str) -> str:
    return "".join(c if c.isalnum() else "_" for c in name).strip("_").lower()


def state_transitions(events: DataFrame, keys: Sequence[str], stub: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Days from an event to the next one of another type, which may come at the same moment: mean, least and velocity for each pair."""
    kinds = sorted({k for p in pairs for k in p})
    shaped = events.where(F.col("event_type").isin(*kinds))
    # a range frame holds all rows at the same moment and after, so ties need no order of their own
    ahead = Window.partitionBy(*keys).orderBy(F.desc("event_ts")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    for k in kinds:
        shaped = shaped.withColumn(f"next_{token(k)}", F.min(F.when(F.col("event_type") == k, F.col("event_ts"))).over(ahead))
    out, names = [], []
    for a, b in pairs:
        days = F.when(F.col("event_type") == a, F.datediff(F.col(f"next_{token(b)}"), F.col("event_ts")))
        name = f"{stub}_{token(a)}_to_{token(b)}"
        names.append(name)
        out += [F.avg(days).alias(f"{name}_avg_transition_days"), F.min(days).alias(f"{name}_min_transition_days")]
    return shaped.groupBy(*keys).agg(*out).withColumns({f"{n}_transition_velocity": ratio(F.lit(1.0), F.col(f"{n}_avg_transition_days")) for n in names})


def novelty(events: DataFrame, keys: Sequence[str], stub: str, dimension: str) -> DataFrame:
    """When values of a dimension were first seen, and how many events were such."""
    first = F.min("event_ts").over(Window.partitionBy(*keys, dimension))
    found = events.where(F.col(dimension).isNotNull()).withColumn("first", first).groupBy(*keys).agg(
        F.datediff(F.max("first"), F.min("first")).alias(f"{stub}_new_{dimension}_spread_days"),
        F.datediff(F.max("reference_ts"), F.max("first")).alias(f"{stub}_days_since_last_new_{dimension}"),
        F.countDistinct(dimension).alias(f"{stub}_{dimension}_distinct_cnt"),
        F.count_if(F.col("event_ts") == F.col("first")).alias(f"{stub}_new_{dimension}_event_cnt"),
        F.count("*").alias(f"{stub}_{dimension}_event_cnt"),
    )
    return found.withColumn(f"{stub}_new_{dimension}_event_frac", ratio(F.col(f"{stub}_new_{dimension}_event_cnt"), F.col(f"{stub}_{dimension}_event_cnt")))


def partner_weights(events: DataFrame, keys: Sequence[str], partner: str, days: int, low: float = 0.25, high: float = 4.0) -> DataFrame:
    """(keys, partner, volume, weight): a partner's weight is the root of the mean volume over its own, within bounds.

    At the partner's grain, so joining it back can't multiply events.
    """
    volumes = events.groupBy(*keys, partner).agg(F.count_if(within(days)).alias("volume"))
    mean = F.avg("volume").over(Window.partitionBy(*keys))
    return volumes.withColumn("weight", F.least(F.lit(high), F.greatest(F.lit(low), F.sqrt(mean / F.greatest(F.col("volume"), F.lit(1))))))


def scope_snapshots(base: DataFrame, scopes: dict[str, Sequence[str]], start: str, end: str) -> dict[str, DataFrame]:
    """For each scope, one row an entity with its first start and last end; a null end stays open."""
    last = F.when(F.count_if(F.col(end).isNull()) == 0, F.max(end)).alias(end)
    return {name: base.groupBy(*keys).agg(F.min(start).alias(start), last) for name, keys in scopes.items()}


def stability(base: DataFrame, keys: Sequence[str], stub: str, start: str, reference: str, members: Sequence[str]) -> DataFrame:
    """Tenure, the age of the current assignment, and how many of each member an entity holds, all from ungrouped intervals."""
    return base.groupBy(*keys).agg(
        F.datediff(F.max(reference), F.min(start)).alias(f"{stub}_days_since_first_seen"),
        F.datediff(F.max(reference), F.max(start)).alias(f"{stub}_days_since_current_start"),
        *[F.countDistinct(m).alias(f"{stub}_distinct_{m}_cnt") for m in members],
    )


def all_features(base: DataFrame, events: DataFrame, keys: Sequence[str], scope: str, families: dict[str, Sequence[str]], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One wide row an entity: every family's features and the transitions."""
    frames = []
    for name, kinds in families.items():
        own, stub = events.where(F.col("event_type").isin(*kinds)), f"{scope}_{name}"
        frames += [
            frequency(base, own, keys, stub),
            recency(base, own, keys, stub),
            periodicity(own, keys, stub),
            burstiness(own, keys, stub),
            temporal_entropy(own, keys, stub),
            time_to_k(own, keys, stub, 3),
            time_to_k(own, keys, stub, 5),
            recency_intensity(own, keys, stub),
            cumulative_slope(own, keys, stub),
        ]
    return assembled(base, [*frames, state_transitions(events, keys, scope, pairs)], keys)


def biweekly(start: str, n: int) -> list[tuple[str, str]]:
    """Contiguous half-open windows of two weeks."""
    import datetime as dt

    first = dt.date.fromisoformat(start)
    days = [first + dt.timedelta(days=14 * i) for i in range(n + 1)]
    return [(a.isoformat(), b.isoformat()) for a, b in zip(days, days[1:], strict=False)]


def any_of(conditions: Sequence[Column]) -> Column:
    """False for none."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
