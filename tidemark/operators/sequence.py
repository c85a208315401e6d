"""Ordered event histories: segments, gaps, pairs, lifecycles and interval arithmetic."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import surrogate_key
from tidemark.operators.joins import point_in_interval


def micros(a: str, b: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {a}, {b})")


def segments(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Add `segment`, the number (from 1) of the run of equal values a row is in."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_new", new).withColumn("segment", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def segment_bounds(df: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    return df.groupBy(*keys, "segment", value).agg(F.min(at).alias("seg_from"), F.max(at).alias("seg_to"), F.count("*").alias("n_events"))


def handovers(bounds: DataFrame, keys: Sequence[str], value: str, days: float) -> DataFrame:
    """Each segment after another: (keys, segment, from_value, to_value, gap_us, within)."""
    w = Window.partitionBy(*keys).orderBy("segment")
    moved = bounds.withColumn("from_value", F.lag(value).over(w)).withColumn("_before", F.lag("seg_to").over(w)).where(F.col("_before").isNotNull())
    return moved.withColumn("gap_us", micros("_before", "seg_from")).select(*keys, "segment", "from_value", F.col(value).alias("to_value"), "gap_us", (F.col("gap_us") <= int(days * 86_400_000_000)).alias("within"))


def collapse_pairs(df: DataFrame, keys: Sequence[str], kind: str, first: str, second: str, at: str, row_id: str, hours: float, becomes: str) -> DataFrame:
    """Replace a `first` that a `second` follows next within `hours` by one event of kind `becomes` at the second's moment; all else stays."""
    w = Window.partitionBy(*keys).orderBy(at, row_id)
    limit = int(hours * 3_600_000_000)
    d = df.withColumn("_next", F.lead(kind).over(w)).withColumn("_next_at", F.lead(at).over(w)).withColumn("_last", F.lag(kind).over(w)).withColumn("_last_at", F.lag(at).over(w))
    goes = F.coalesce((F.col(kind) == first) & (F.col("_next") == second) & (micros(at, "_next_at") <= limit), F.lit(False))
    turns = F.coalesce((F.col(kind) == second) & (F.col("_last") == first) & (micros("_last_at", at) <= limit), F.lit(False))
    return d.where(~goes).withColumns({"collapsed": turns, kind: F.when(turns, F.lit(becomes)).otherwise(F.col(kind))}).drop("_next", "_next_at", "_last", "_last_at")


def long_gaps(df: DataFrame, keys: Sequence[str], at: str, row_id: str, days: float) -> DataFrame:
    """Add `restarts`: whether the gap since the last row is `days` or more."""
    w = Window.partitionBy(*keys).orderBy(at, row_id)
    return df.withColumn("_last", F.lag(at).over(w)).withColumn("restarts", F.coalesce(micros("_last", at) >= int(days * 86_400_000_000), F.lit(False))).drop("_last")


def overlapping(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str]) -> DataFrame:
    """Intervals that begin before the latest end of those before them; a null end never comes."""
    w = Window.partitionBy(*keys).orderBy(start, *order).rowsBetween(Window.unboundedPreceding, -1)
    forever = F.to_timestamp_ntz(F.lit("9999-12-31 23:59:59"))
    return df.withColumn("_reached", F.max(F.coalesce(F.col(end).cast("timestamp_ntz"), forever)).over(w)).where(F.col(start).cast("timestamp_ntz") < F.col("_reached")).drop("_reached")


# How a boundary that no event names came about, and the grades of confidence.
FROM_FLOOR = "inferred_start_from_floor"
FROM_PREVIOUS = "inferred_start_from_previous_lifecycle_end"
FROM_PLAN = "inferred_start_from_plan_change_only"
TO_NEXT = "_to_inferred_end_from_next_start"
TO_OPEN = "_open_no_cancellation"
HIGH, LOW = "HIGH", "LOW"


@dataclass(frozen=True)
class Vocabulary:
    """Which event kinds start a life, force a new one, resume one or end it; any other is neutral.

    plans: neutral kinds that are counted as changes of plan. start_reasons and
    end_reasons name a boundary by its event's kind; low_carriers never have
    boundaries of high confidence.
    """

    starts: frozenset[str]
    forces: frozenset[str]
    resumes: frozenset[str]
    ends: frozenset[str]
    duplicate_end_hours: float = 24.0
    floor: str = "1970-01-01 00:00:00"
    plans: frozenset[str] = frozenset()
    low_carriers: frozenset[str] = frozenset()
    start_reasons: Mapping[str, str] = field(default_factory=dict)
    end_reasons: Mapping[str, str] = field(default_factory=dict)
    other_start: str = "inferred_start"

    def start_reason(self, kind: str) -> str:
        return FROM_PLAN if kind in self.plans else self.start_reasons.get(kind, f"explicit_{kind}" if kind in self.starts | self.forces | self.resumes else self.other_start)

    def confidence(self, carrier, inferred: bool) -> str:
        return LOW if inferred or carrier in self.low_carriers else HIGH

    def rank(self, kind: str) -> int:
        """At one moment ends come first, then starts, then what is neutral."""
        return 0 if kind in self.ends else 1 if kind in self.starts | self.forces | self.resumes else 2


@dataclass
class _Walk:
    words: Vocabulary
    rows: list[dict] = field(default_factory=list)
    live: dict | None = None
    carrier: object = None
    segment: int = 0
    closed: pd.Timestamp | None = None

    ignored: int = 0

    def begin(self, e, inferred: bool, at: pd.Timestamp | None = None, reason: str | None = None) -> None:
        self.live = {
            "carrier": e.carrier,
            "segment": self.segment,
            "anchor_id": e.event_id,
            "start_ts": e.ts if at is None else at,
            "start_inferred": inferred,
            "start_id": e.event_id,
            "start_kind": e.kind,
            "start_reason": reason or self.words.start_reason(e.kind),
            "start_confidence": self.words.confidence(e.carrier, inferred),
            "plan_changes": int(e.kind in self.words.plans),
            **{"end_ts": None, "end_inferred": True, "is_open": True, "end_id": None, "end_kind": None, "end_reason": TO_OPEN, "end_confidence": HIGH},
        }

    def finish(self, at: pd.Timestamp, by=None) -> None:
        """Close what is on, by an event that says so or, without one, by inference."""
        if self.live is not None:
            end = {"end_ts": at, "end_inferred": by is None, "is_open": False, "end_reason": TO_NEXT, "end_confidence": self.words.confidence(self.live["carrier"], by is None)}
            if by is not None:
                end |= {"end_id": by.event_id, "end_kind": by.kind, "end_reason": self.words.end_reasons.get(by.kind, f"_to_explicit_{by.kind}")}
            self.rows.append({**self.live, **end})
            self.live, self.closed = None, at

    def end(self, e) -> None:
        if self.live is not None:
            self.finish(e.ts, e)
        elif self.closed is None or e.ts - self.closed > pd.Timedelta(hours=self.words.duplicate_end_hours):
            # the last life's end is the latest moment at which something else is known
            if self.rows:
                self.begin(e, True, self.rows[-1]["end_ts"], FROM_PREVIOUS)
            else:
                self.begin(e, True, pd.Timestamp(self.words.floor), FROM_FLOOR)
            self.finish(e.ts, e)
        else:
            self.ignored += 1

    def step(self, e) -> None:
        if self.segment == 0 or e.carrier != self.carrier:
            self.finish(e.ts)
            self.carrier, self.segment, self.closed = e.carrier, self.segment + 1, None
        if e.kind in self.words.forces | self.words.starts:
            self.finish(e.ts)
            self.begin(e, False)
        elif e.kind in self.words.ends:
            self.end(e)
        elif self.live is None:
            self.begin(e, e.kind not in self.words.resumes)
        elif e.kind in self.words.plans:
            self.live["plan_changes"] += 1
        elif self.live["start_reason"] == FROM_PLAN:
            self.live["start_reason"] = self.words.other_start  # more than a change of plan is known of it

    def result(self) -> list[dict]:
        return sorted(self.rows + ([self.live] if self.live else []), key=lambda r: (r["start_ts"], r["end_ts"] is None, r["end_ts"] or r["start_ts"], r["segment"], r["anchor_id"]))


LIFECYCLE = "subscriber string, lifecycle_no int, carrier string, segment int, anchor_id string, start_ts timestamp, end_ts timestamp, is_open boolean, start_inferred boolean, end_inferred boolean, start_id string, start_kind string, start_reason string, start_confidence string, end_id string, end_kind string, end_reason string, end_confidence string, confidence string, plan_changes int, ignored_ends int"


def walk(events: Iterable, words: Vocabulary) -> list[dict]:
    """One subscriber's lifecycles from rows with carrier, kind, ts and event_id, in any order."""
    state = _Walk(words)
    for e in sorted(events, key=lambda e: (e.ts, words.rank(e.kind), e.event_id)):
        state.step(e)
    weaker = lambda r: HIGH if r["start_confidence"] == r["end_confidence"] == HIGH else LOW
    return [{**r, "lifecycle_no": i + 1, "confidence": weaker(r), "ignored_ends": state.ignored} for i, r in enumerate(state.result())]


def lifecycles(events: DataFrame, words: Vocabulary) -> DataFrame:
    """Non-overlapping lifecycle intervals of (subscriber, carrier, kind, ts, event_id), with surrogate ids.

    The walk carries state from event to event, which no window expresses; it
    runs once a subscriber over that subscriber's events, each key in its task.
    """

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(walk(rows.itertuples(index=False), words))
        found.insert(0, "subscriber", rows["subscriber"].iloc[0])
        columns = [c.split()[0] for c in LIFECYCLE.split(", ")]
        found["end_ts"] = pd.to_datetime(found["end_ts"])
        return found[columns]

    shaped = events.select(F.col("subscriber").cast("string").alias("subscriber"), F.col("carrier").cast("string").alias("carrier"), "kind", F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("string").alias("event_id"))
    return shaped.groupBy("subscriber").applyInPandas(of, LIFECYCLE).withColumn("lifecycle_uid", surrogate_key(F.lit("lifecycle"), F.lit(1), F.col("subscriber"), F.col("carrier"), F.col("anchor_id")))


def minus(start, end, taken: Iterable[tuple]) -> list[tuple]:
    """What is left of one interval [start, end) without the taken ones; a null end is open."""
    left, at = [], start
    for a, b in sorted(taken, key=lambda t: t[0]):
        if end is not None and a >= end:
            break
        if a > at:
            left.append((at, a))
        if b is None:
            return left
        at = max(at, b)
    if end is None or at < end:
        left.append((at, end))
    return left


def covers(taken: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, start, end): overlapping and touching intervals of a key as one; a null end is open, empty ones are left out."""
    forever = F.lit("9999-12-31 23:59:59").cast("timestamp")
    each = taken.select(F.col(key).alias("k"), F.col(start).alias("s"), F.coalesce(F.col(end), forever).alias("e")).where("k IS NOT NULL AND e > s")
    order = Window.partitionBy("k").orderBy("s", "e")
    reached = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = each.withColumn("_new", F.coalesce((F.col("s") > reached).cast("int"), F.lit(1))).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy("k", "_run").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return out.select(F.col("k").alias(key), F.col("s").alias(start), F.when(F.col("e") < forever, F.col("e")).alias(end))


def subtract_intervals(free: DataFrame, taken: DataFrame, key: str, start: str, end: str, keep: Sequence[str] = ()) -> DataFrame:
    """Parts of `free` intervals that no `taken` interval of the key covers: (key, start, end), half-open, with `keep` of their rows; a null end is open.

    What lies between a key's covers is met twice: by the start of a free
    interval, and with its own start inside a free interval. Empty intervals
    take nothing and leave nothing; null keys are left out.
    """
    shape = lambda d, *more: d.select(F.col(key).cast("string").alias("k"), F.col(start).cast("timestamp").alias("s"), F.col(end).cast("timestamp").alias("e"), *more)
    wanted = shape(free, F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("kept")).where("k IS NOT NULL AND s IS NOT NULL AND (e IS NULL OR e > s)")
    used = covers(shape(taken), "k", "s", "e")
    order = Window.partitionBy("k").orderBy("s")
    gaps = used.select("k", F.coalesce(F.lag("e").over(order), F.lit("0001-01-01 00:00:00").cast("timestamp")).alias("gs"), F.col("s").alias("ge"))
    gaps = gaps.unionByName(used.groupBy("k").agg(F.max_by("e", "s").alias("gs")).where("gs IS NOT NULL").withColumn("ge", F.lit(None).cast("timestamp")))
    until = F.when(F.col("e").isNull() | (F.col("ge") < F.col("e")), F.coalesce("ge", "e")).otherwise(F.col("e"))
    at_start = point_in_interval(wanted, gaps, "k", "s", "gs", "ge", False).select("k", "s", until.alias("e"), "kept")
    later = point_in_interval(gaps, wanted, "k", "gs", "s", "e", False).where("gs > s").select("k", F.col("gs").alias("s"), until.alias("e"), "kept")
    whole = wanted.join(used.select("k"), "k", "left_anti")
    found = at_start.unionByName(later).unionByName(whole)
    return found.select(F.col("k").alias(key), F.col("s").alias(start), F.col("e").alias(end), *[F.col(f"kept.`{c}`") for c in keep])
