"""Declarative rules, one-scan metrics, checks, quarantine and schema comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.clean import raw_payload, surrogate_key


@dataclass(frozen=True)
class Rule:
    """One rule on one column; `kind` is a key of RULE_KINDS, `options` what it needs."""

    rule_id: str
    kind: str
    column: str
    severity: str = "error"
    options: Mapping = field(default_factory=dict)


def _by_group(r: Rule) -> Column:
    """A value must be in its group's list; a group without a list is not judged."""
    group = F.col(r.options["group"])
    judged = [(group == g) & ~F.col(r.column).isin(*vs) for g, vs in sorted(r.options["allowed"].items())]
    return reduce(lambda a, b: a | b, judged, F.lit(False))


#: What is wrong under each kind; a null value is wrong only under `required`.
RULE_KINDS = {
    "required": lambda r: F.col(r.column).isNull(),
    "flag": lambda r: F.col(r.column),
    "allowed": lambda r: ~F.col(r.column).isin(*r.options["values"]),
    "by_group": _by_group,
    "regex": lambda r: ~F.col(r.column).rlike(r.options["pattern"]),
    "positive": lambda r: F.col(r.column) <= 0,
    "nonnegative": lambda r: F.col(r.column) < 0,
    "date_equal": lambda r: F.to_date(F.col(r.column)) != F.to_date(F.col(r.options["other"])),
    "required_when": lambda r: F.col(r.column).isNull() & F.expr(r.options["when"]),
    "long_numeric_id": lambda r: F.col(r.column).rlike(rf"^\d{{{int(r.options.get('longer_than', 10)) + 1},}}$"),
    "future": lambda r: F.col(r.column) > F.lit(r.options["now"]).cast("timestamp_ntz"),
}


def violation(rule: Rule) -> Column:
    if rule.kind not in RULE_KINDS:
        raise ValueError(f"unknown rule kind {rule.kind}")
    return F.coalesce(RULE_KINDS[rule.kind](rule), F.lit(False))


def annotate(df: DataFrame, rules: Sequence[Rule], unique: str | None = None) -> DataFrame:
    """Add `issues` (array of rule_id, severity) and `has_errors`; with `unique`, repeats of that column are an error."""
    if len({r.rule_id for r in rules}) < len(rules):
        raise ValueError("rule ids repeat")
    found = [F.when(violation(r), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"))) for r in rules]
    if unique:
        repeats = F.count("*").over(Window.partitionBy(unique)) > 1
        found.append(F.when(repeats, F.struct(F.lit(f"unique_{unique}").alias("rule_id"), F.lit("error").alias("severity"))))
    out = df.withColumn("issues", F.array_compact(F.array(*found)))
    return out.withColumn("has_errors", F.exists("issues", lambda i: i["severity"] == "error"))


def issue_rows(annotated: DataFrame, keys: Sequence[str]) -> DataFrame:
    return annotated.select(*keys, F.explode("issues").alias("i")).select(*keys, "i.rule_id", "i.severity")


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)."""
    return annotated.where(~F.col("has_errors")).drop("issues", "has_errors"), annotated.where("has_errors")


def quarantine(rejected: DataFrame, dataset: str, identity: Sequence[str]) -> DataFrame:
    """Evidence of rejected rows: an id from their identity and rules, the rules, and the row as JSON."""
    data = rejected.select(*[c for c in rejected.columns if c not in ("issues", "has_errors")])
    rules = F.concat_ws(",", F.array_sort(F.transform("issues", lambda i: i["rule_id"])))
    return rejected.select(surrogate_key(F.lit(dataset), *[F.col(c) for c in identity], rules).alias("quarantine_id"), F.lit(dataset).alias("dataset"), *identity, rules.alias("rules"), raw_payload(data).alias("payload"))


@dataclass(frozen=True)
class Check:
    """Rows that fail `bad`, or a count by `frame` over the whole table; `severity`: abort, warn or info."""

    name: str
    dimension: str
    severity: str = "warn"
    bad: Column | None = None
    frame: object = None


def not_null(column: str, severity: str = "abort") -> Check:
    return Check(f"completeness_{column}", "completeness", severity, F.col(column).isNull())


def in_domain(column: str, values: Sequence[str], when_present: bool = False, severity: str = "abort") -> Check:
    bad = ~F.col(column).isin(*values)
    return Check(f"consistency_{column}_domain", "consistency", severity, F.coalesce(bad, F.lit(not when_present)))


def matches_when_present(column: str, pattern: str, severity: str = "warn") -> Check:
    return Check(f"validity_{column}_format", "validity", severity, ~F.col(column).rlike(pattern))


def counter(name: str, condition: Column) -> Check:
    return Check(name, "info", "info", condition)


def unique_by(columns: Sequence[str], severity: str = "abort") -> Check:
    """Surplus rows of a composite key: rows less distinct keys."""

    def surplus(df: DataFrame) -> DataFrame:
        return df.groupBy(*columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("failed"))

    return Check(f"uniqueness_{'_'.join(columns)}", "uniqueness", severity, frame=surplus)


def references(column: str, other: DataFrame, other_column: str, severity: str = "abort") -> Check:
    def missing(df: DataFrame) -> DataFrame:
        there = other.select(F.col(other_column).alias(column)).distinct()
        return df.where(F.col(column).isNotNull()).join(there, column, "left_anti").agg(F.count("*").alias("failed"))

    return Check(f"referential_{column}", "consistency", severity, frame=missing)


def interval_ordered(start: str, end: str) -> Check:
    return Check("consistency_interval_ordered", "consistency", "abort", F.col(end) < F.col(start))


def at_most_one_open(keys: Sequence[str], end: str) -> Check:
    def several(df: DataFrame) -> DataFrame:
        return df.where(F.col(end).isNull()).groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("failed"))

    return Check("consistency_one_open", "consistency", "abort", frame=several)


def fan_out(key: str, partner: str) -> Check:
    def several(df: DataFrame) -> DataFrame:
        return df.groupBy(key).agg(F.countDistinct(partner).alias("n")).where("n > 1").agg(F.count("*").alias("failed"))

    return Check(f"consistency_{key}_one_{partner}", "consistency", "warn", frame=several)


def run_checks(df: DataFrame, checks: Sequence[Check], group: str | None = None) -> DataFrame:
    """(name, dimension, severity, total, failed), with `group` one row a value: all row conditions in a single scan."""
    plain = [c for c in checks if c.bad is not None]
    keys = [F.col(group).cast("string").alias("grp")] if group else [F.lit("all").alias("grp")]
    sums = [F.count_if(F.coalesce(c.bad, F.lit(False))).alias(f"c{i}") for i, c in enumerate(plain)]
    one = df.groupBy(*keys).agg(F.count("*").alias("total"), *sums)
    rows = F.array(*[F.struct(F.lit(c.name).alias("name"), F.lit(c.dimension).alias("dimension"), F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("failed")) for i, c in enumerate(plain)])
    out = one.select("grp", "total", F.explode(rows).alias("r")).select("grp", "r.name", "r.dimension", "r.severity", "total", "r.failed") if plain else None
    for c in checks:
        if c.frame is not None and not group:
            total = df.agg(F.count("*").alias("total"))
            f = c.frame(df).join(F.broadcast(total)).select(F.lit("all").alias("grp"), F.lit(c.name).alias("name"), F.lit(c.dimension).alias("dimension"), F.lit(c.severity).alias("severity"), "total", "failed")  # one row each
            out = f if out is None else out.unionByName(f)
    return out


def verdict(metrics: DataFrame, overrides: Mapping[str, str] | None = None) -> str:
    """pass, warn or abort; an empty table aborts. The metrics are a row a check."""
    rows = metrics.collect()
    if not rows or all(r["total"] == 0 for r in rows):
        return "abort"
    failed = {(overrides or {}).get(r["name"], r["severity"]) for r in rows if r["failed"]}
    return "abort" if "abort" in failed else "warn" if "warn" in failed else "pass"


def modal_hour(df: DataFrame, at: str) -> DataFrame:
    """The most frequent hour, ties to the lowest."""
    return df.groupBy(F.hour(at).alias("hour")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "hour").limit(1)


def hour_drift(a: int, b: int) -> int:
    """The shorter way round the clock."""
    return min((a - b) % 24, (b - a) % 24)


def schema_compat(expected: StructType, actual: StructType, sample: DataFrame | None = None, most: int = 50) -> tuple[str, list[str]]:
    """PASS, WARN or FAIL with reasons: a removed or incompatible column fails, an added one or text that can be cast warns."""
    have, found, level = {f.name.lower(): f for f in actual.fields}, [], 0
    for f in expected.fields:
        got = have.pop(f.name.lower(), None)
        if got is None:
            level, found = 2, [*found, f"removed: {f.name}"]
        elif got.dataType != f.dataType:
            castable = got.dataType.simpleString() == "string"
            if castable and sample is not None:
                some = sample.select(got.name).where(F.col(got.name).isNotNull()).limit(most)
                castable = some.where(F.col(got.name).try_cast(f.dataType).isNull()).isEmpty()
            level, found = max(level, 1 if castable else 2), [*found, f"{'castable' if castable else 'incompatible'}: {f.name}"]
    if have:
        level, found = max(level, 1), [*found, *[f"added: {f.name}" for f in have.values()]]
    return ("PASS", "WARN", "FAIL")[level], found
